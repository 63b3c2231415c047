import hashlib
import random
import re
import zlib
from fractions import Fraction

from pyspark.sql import functions as F

from ledgerline.llm import mixing as MX

WEIGHTS = [{"d0": 4, "d1": 3, "d2": 2, "d3": 1}, {"en": 5, "fr": 2, "xx": 0}, {"s1": 3}]


def fill(children, budget):
    """Water-filling with exact fractions: children [(name, weight, capacity)]."""
    full = set()
    while True:
        rest = budget - sum(c for n, _, c in children if n in full)
        weight = sum(w for n, w, _ in children if n not in full)
        more = {n for n, w, c in children if n not in full and w > 0 and weight
                and Fraction(rest * w, weight) >= c}
        if not more:
            return {n: Fraction(c) if n in full else Fraction(max(rest, 0) * w, weight) if weight else Fraction(0)
                    for n, w, c in children}
        full |= more


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, lang string, source string, text string, copies string")


def make(seed=1, n=600):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["en", "en", "de", "fr", "xx", None]), rng.choice(["s1", "s1", "s2", "s3", None]),
             " ".join(["w"] * rng.randint(0, 40)), "c") for i in range(n)]
    return rows + [(n, "en", "s1", None, None), (3, *rows[3][1:]), (None, "en", "s9", "a b c", None)]


def leaves_of(rows):
    out = {}
    for i, lang, source, text, _ in rows:
        domain = None if source is None else f"d{zlib.crc32(source.encode()) % 4}"
        n = len([w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w])
        out.setdefault((domain, lang, source), []).append((i, n))
    return out


def weight(level, value):
    return WEIGHTS[level].get(value, 1)


def test_selection_matches_brute_force(spark):
    for seed, share in ((1, (1, 2)), (2, (3, 1)), (3, (1, 7))):
        rows = make(seed)
        leaves = leaves_of(rows)
        tokens = {k: sum(n for _, n in v) for k, v in leaves.items()}
        total = sum(tokens.values()) * share[0] // share[1]
        table = spark.createDataFrame([(*k, v) for k, v in tokens.items()],
                                      "domain string, lang string, source string, tokens long")
        budgets = {(r.domain, r.lang, r.source): r.budget
                   for r in MX.leaf_budgets(table, WEIGHTS, share=share, epochs=4).collect()}
        assert budgets.keys() == tokens.keys()

        def under(prefix):
            return 4 * sum(t for k, t in tokens.items() if k[:len(prefix)] == prefix)

        def walk(prefix, budget):
            depth = len(prefix)
            names = {k[depth] for k in tokens if k[:depth] == prefix}
            given = fill([(n, weight(depth, n), under((*prefix, n))) for n in names], budget)
            for n, b in given.items():
                if depth == 2:
                    assert abs(budgets[(*prefix, n)] - b) <= 3, (prefix, n, budgets[(*prefix, n)], float(b))
                    assert budgets[(*prefix, n)] <= under((*prefix, n))
                else:
                    walk((*prefix, n), b)
        walk((), total)
        assert total - 60 <= sum(budgets.values()) <= total or share[0] > share[1]

        want = {}
        for leaf, members in leaves.items():
            if not tokens[leaf]:
                continue
            whole, rest = divmod(budgets[leaf], tokens[leaf])
            key = {i: hashlib.md5(f"{MX.SEED}:{whole}:{'' if i is None else i}".encode()).hexdigest()
                   for i, _ in members}
            so_far, chosen = 0, set()
            for k in sorted(set(key.values())):
                so_far += sum(n for i, n in members if key[i] == k)
                if so_far > rest or not rest:
                    break
                chosen.add(k)
            for i, _ in members:
                c = whole + (key[i] in chosen)
                if c:
                    want.setdefault((str(leaf), str(i)), []).append(c)
        got = {}
        for r in MX.mix(docs_of(spark, rows), WEIGHTS, share=share).collect():
            got.setdefault((str((r.domain, r.lang, r.source)), str(r.doc_id)), []).append(r.copies)
        assert got == want


def test_shortage_goes_to_siblings_before_ancestors(spark):
    table = spark.createDataFrame([("d0", "en", "a", 10), ("d0", "en", "b", 1000), ("d0", "fr", "c", 1000),
                                   ("d1", "en", "e", 1000)],
                                  "domain string, lang string, source string, tokens long")
    got = {r.source: r.budget for r in MX.leaf_budgets(table, [{}, {}, {}], budget=800, epochs=1).collect()}
    assert got == {"a": 10, "b": 190, "c": 200, "e": 400}
    got = {r.source: r.budget for r in MX.leaf_budgets(table, [{"d1": 0}, {}, {}], budget=3000, epochs=1).collect()}
    assert got == {"a": 10, "b": 1000, "c": 1000, "e": 0}


def test_empty_table_and_zero_budget(spark):
    docs = docs_of(spark, make(1, 20))
    assert MX.mix(docs.limit(0)).count() == 0
    assert MX.mix(docs, budget=0).count() == 0
    out = MX.mix(docs.withColumn("whole", F.lit(9)).withColumn("cut", F.lit("f")), budget=10**9).drop("whole", "cut")
    assert set(out.columns) == {*docs.columns, "domain", "n_tokens"}
    assert {r.copies for r in out.where("n_tokens > 0").collect()} == {4}
