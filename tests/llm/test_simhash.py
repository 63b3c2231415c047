import random

import numpy as np
import xxhash

from ledgerline.llm import simhash as SH
from ledgerline.llm.components import connected_components


def brute(texts, shingle=4):
    out = []
    for t in texts:
        w = (t or "").encode().lower().split()
        if not w:
            out.append(0)
            continue
        grams = [w] if len(w) < shingle else [w[i:i + shingle] for i in range(len(w) - shingle + 1)]
        h = [xxhash.xxh64_intdigest(b" ".join(g), 42) for g in grams]
        out.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    return out


def groups_of(prints, ids, max_bits):
    label = list(range(len(prints)))
    for i, a in enumerate(prints):
        for j in range(i):
            if bin(a ^ prints[j]).count("1") <= max_bits:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    least = {}
    for x, i in zip(label, ids):
        if i is not None:
            least[x] = min(i, least.get(x, i))
    return [least.get(x) for x in label]


def test_matches_brute_force(spark):
    rng = random.Random(1)
    words = ["Wort%d" % i for i in range(300)]
    texts = [" ".join(rng.choices(words, k=rng.randint(1, 60))) for _ in range(150)]
    for t in list(texts[:80]):
        w = t.split()
        w[rng.randrange(len(w))] = "other"
        texts.append(" ".join(w))
    texts += [texts[3]] * 5 + ["", None, " \n\t", "É é", "x" * 5000, "a b " * 4000]
    ids = list(range(len(texts)))
    got = {r.doc_id: r for r in SH.near_duplicates(
        spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string"), max_bits=6).collect()}
    want = brute(texts)
    assert [got[i].fp & (2**64 - 1) for i in ids] == want
    assert [got[i].component_id for i in ids] == groups_of(want, ids, 6)


def test_tree_reaches_every_neighbour_in_its_band():
    rng = np.random.default_rng(7)
    prints = rng.integers(0, 2**64, size=3000, dtype=np.uint64)
    flipped = prints ^ (np.uint64(1) << rng.integers(0, 22, size=3000, dtype=np.uint64))
    tree = SH.fit_tree(prints[:1000], 0, 22, 16)
    assert tree.leaves > 20
    rows, leaves = tree.visits(prints, 0)
    assert sorted(rows) == list(range(3000))
    home = dict(zip(rows.tolist(), leaves.tolist()))
    rows, leaves = tree.visits(flipped, 1)
    seen = set(zip(rows.tolist(), leaves.tolist()))
    assert all((i, home[i]) in seen for i in range(3000))


def test_hot_leaf_is_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(SH, "BLOCK", 8)
    base = 0x0123456789ABCDEF
    near = [base ^ (1 << i) for i in range(40)] + [base ^ 3 ^ (1 << i) for i in range(20, 60)]
    signed = [x if x < 2**63 else x - 2**64 for x in sorted(set(near))]
    edges = SH.link_fingerprints(spark.createDataFrame([(x,) for x in signed], "fp long"), 4)
    found = connected_components(edges).collect()
    assert len(found) == len(signed) and len({r.component for r in found}) == 1


def test_empty_null_and_repeated_rows(spark):
    schema = "doc_id long, text string, fp string, component_id string"
    empty = spark.createDataFrame([], schema)
    assert SH.near_duplicates(empty).count() == 0
    assert SH.keep_one_per_group(empty).columns == empty.columns
    rows = [(5, "a b c d e", "x", "y"), (5, "a b c d e", "x", "y"), (7, "A B C D E", None, None),
            (None, "a b c d e", None, None), (None, "alone here now ok", None, None),
            (None, "alone here now ok", None, None), (9, None, None, None), (8, "", None, None)]
    df = spark.createDataFrame(rows, schema)
    got = SH.near_duplicates(df).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.component_id) for r in got} == {(5, 5), (7, 5), (None, 5), (None, None),
                                                         (9, 8), (8, 8)}
    kept = SH.keep_one_per_group(df)
    assert kept.columns == df.columns
    assert sorted(map(str, [r.doc_id for r in kept.collect()])) == ["5", "8", "None"]


def test_an_id_on_two_texts(spark):
    a, b, c = "a b c d e f", "one two three four five six", "some other text of its own here"
    rows = [(5, a, "a"), (7, a, "a"), (5, b, "b"), (3, b, "b"), (8, a, "a"), (8, c, "c"), (9, c, "c"),
            (5, a, "a")]
    kept = SH.keep_one_per_group(spark.createDataFrame(rows, "doc_id long, text string, name string"))
    assert sorted((r.doc_id, r.name) for r in kept.collect()) == [(3, "b"), (5, "a"), (8, "c")]


def test_columns_named_like_its_own_pass_through(spark):
    rows = [(5, "a b c d e", "x", "y"), (5, "one two three four five", "z", "w"), (None, "some other text here", "u", "v")]
    kept = SH.keep_one_per_group(spark.createDataFrame(rows, "doc_id long, text string, __fp string, fp string"))
    assert sorted(kept.collect(), key=str) == sorted(rows, key=str)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in connected_components(
        spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, **{i: 100 for i in range(100, 140)}}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0
