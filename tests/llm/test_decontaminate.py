import random
import re

import numpy as np

from ledgerline.llm import decontaminate as DC

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window=10):
    out = []
    for doc_id, text in docs:
        w = words(text)
        hit, ids = set(), set()
        for item_id, item in items:
            x = words(item)
            for i in range(max(1, len(x) - window + 1)) if x else []:
                part = x[i:i + window]
                for j in range(len(w) - len(part) + 1):
                    if w[j:j + len(part)] == part:
                        hit.update(range(j, j + len(part)))
                        ids.add(item_id)
        out.append((doc_id, len(w), len(hit), sorted(str(i) for i in ids if i is not None)))
    return out


def make(seed):
    rng = random.Random(seed)
    vocab = ["ab", "Ber", "é", "c3", "d", "ße", "x", "YY", "zu"]
    items = [(i, " ".join(rng.choices(vocab, k=rng.randint(1, 30)))) for i in range(12)]
    items += [(12, ""), (13, None), (14, items[3][1]), (None, "only here once"), (3, items[3][1])]
    docs = []
    for i in range(60):
        w = rng.choices(vocab + ["qq", "rr"], k=rng.randint(0, 80))
        src = (items[rng.randrange(12)][1]).split()
        if i % 3:
            at = rng.randint(0, len(w))
            w[at:at] = src[rng.randint(0, 3):]
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(w)))
    return docs + [(60, None), (61, ""), (61, ""), (None, items[5][1]), (62, "only-HERE once!")], items


def test_matches_brute_force(spark):
    for seed in (1, 2):
        docs, items = make(seed)
        got = DC.scan(spark.createDataFrame(docs, "doc_id long, text string"),
                      spark.createDataFrame(items, "item_id long, text string")).collect()
        have = sorted((str(r.doc_id), r.found.n_words, r.found.n_hit, r.found["items"]) for r in got)
        assert have == sorted((str(d), n, h, i) for d, n, h, i in brute(docs, items))


def test_blocks_of_the_benchmark_add_up(spark, monkeypatch):
    docs, items = make(3)
    monkeypatch.setattr(DC, "BLOCK_BYTES", 60)
    got = DC.scan(spark.createDataFrame(docs, "doc_id long, text string"),
                  spark.createDataFrame(items, "item_id long, text string")).collect()
    have = sorted((str(r.doc_id), r.found.n_words, r.found.n_hit, r.found["items"]) for r in got)
    assert have == sorted((str(d), n, h, i) for d, n, h, i in brute(docs, items))


def test_spans_are_the_longest_verbatim_matches(spark):
    item = " ".join(f"w{i}" for i in range(30))
    docs = [(1, "before " + item + " after"), (2, " ".join(item.split()[5:20]) + " end")]
    got = {r.doc_id: r.found.spans for r in DC.scan(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame([(9, item)], "item_id long, text string")).collect()}
    assert [tuple(s) for s in got[1]] == [("9", 0, 1, 30)]
    assert [tuple(s) for s in got[2]] == [("9", 5, 0, 15)]


def test_suffix_array_orders_suffixes():
    rng = np.random.default_rng(1)
    tokens = rng.integers(0, 4, size=400)
    order, run = DC.suffix_array(tokens, 16)
    cut = [tuple(tokens[i:i + min(run[i], 16)]) for i in order]
    assert cut == sorted(cut)
    assert sorted(order) == np.flatnonzero(tokens).tolist()


def test_empty_tables_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b", "x", "y")], "doc_id long, text string, found string, item_id string")
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "b")], "item_id long, text string")
    assert DC.decontaminate(docs, none).collect() == docs.collect()
    left = DC.decontaminate(docs, some)
    assert left.columns == docs.columns and left.count() == 0
    assert DC.decontaminate(docs.limit(0), some).count() == 0
