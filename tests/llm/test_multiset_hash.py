"""Multiset hash against a plain re-computation, its algebra, and the defined cases."""
import hashlib
import re

import xxhash
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from ledgerline.llm import multiset_hash as MH

SMOKE = "/root/testdata/sf0.001"
BLANK = r"[\x20\x09-\x0D]"


def chain(*parts, seed=42):
    for p in parts:
        data = p.encode() if isinstance(p, str) else p
        seed = xxhash.xxh64(data, seed=seed).intdigest()
    return seed


def lanes_of(text):
    """Count and packed sums, from the definition."""
    found = []
    for line in (text or "").split("\n"):
        words = [w for w in re.split(BLANK + "+", line) if w]
        if not words:
            continue
        found.append(("paragraph", line))
        found += [tuple(words[i:i + MH.SHINGLE]) for i in range(max(1, len(words) - MH.SHINGLE + 1))]
    sums = [0] * MH.LANES
    for x in found:
        one = (1).to_bytes(4, "little")
        a, b = chain(*x).to_bytes(8, "little"), chain(*x, one).to_bytes(8, "little")
        for j in range(MH.LANES // 4):
            wide = chain(a, b, j.to_bytes(4, "little"))
            for k in range(4):
                sums[4 * j + k] += (wide >> 16 * k & 255) + ((wide >> 16 * k + 8 & 255) << 24)
    return [len(found) % 2 ** 32, *[s % 2 ** 48 for s in sums]]


def hex_of(lanes):
    return f"{lanes[0]:08x}" + "".join(f"{x:012x}" for x in lanes[1:])


def compared(spark, rows, schema="doc_id long, text string"):
    got = MH.compare(spark.createDataFrame(rows, schema)).select(
        "id", "n_chars", "edited_sha256", MH.as_text(F.col("lanes")).alias("fp"),
        MH.as_text(F.col("edited_lanes")).alias("edited_fp"), "near_edited", "near_next")
    return got.collect()


def edited(text, following):
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def test_whole_table_against_plain_computation(spark):
    from ledgerline.llm import queries as Q
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SMOKE}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in Q.op11_multiset_hash(spark, SMOKE).collect()}
    ids = sorted(docs, reverse=True)
    assert set(got) == set(ids)
    for at, i in enumerate(ids):
        new = edited(docs[i], docs[ids[(at + 1) % len(ids)]])
        r = got[i]
        assert r["n_chars"] == len(docs[i])
        assert r["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        assert r["fingerprint"] == hex_of(lanes_of(docs[i]))
        assert r["edited_fingerprint"] == hex_of(lanes_of(new))
    far = [r["near_next"] for r in got.values()]
    near = [r["near_edited"] for r in got.values()]
    assert sum(near) / len(near) > 0.25 > 0.1 > sum(far) / len(far)


def shingles(text):
    return {tuple(w[i:i + 5]) for line in text.split("\n") for w in [line.split()] if w
            for i in range(max(1, len(w) - 4))}


def test_likeness_follows_the_share_of_common_shingles(spark):
    base = [" ".join(f"w{i}x{j}" for j in range(12)) for i in range(40)]
    rows, truth = [], {}
    for k in range(0, 41, 8):                       # k of 40 paragraphs replaced
        other = [" ".join(f"v{k}y{i}z{j}" for j in range(12)) for i in range(k)] + base[k:]
        rows.append((k, "\n".join(base), "\n".join(other)))
        x, y = shingles(rows[-1][1]), shingles(rows[-1][2])
        truth[k] = len(x & y) / len(x | y)
    df = spark.createDataFrame(rows, "id long, x string, y string")
    fx = MH.fingerprints(df, ["id"], "x").withColumnRenamed("lanes", "lx")
    fy = MH.fingerprints(df, ["id"], "y").withColumnRenamed("lanes", "ly")
    for r in fx.join(fy, "id").select("id", MH.likeness(F.col("lx"), F.col("ly")).alias("s")).collect():
        assert abs(r["s"] - truth[r["id"]]) < 0.2
        assert r["s"] == 1.0 if r["id"] == 0 else r["s"] < 1.0


paragraphs = st.lists(st.text("ab \t\n", max_size=14), max_size=6)


@settings(max_examples=8, deadline=None)
@given(paragraphs, paragraphs)
def test_order_free_and_incremental(spark, xs, ys):
    rows = [("x", "\n".join(xs)), ("y", "\n".join(ys)), ("xy", "\n".join(xs + ys)),
            ("yx", "\n".join(reversed(xs + ys))) if not any("\n" in p for p in xs + ys) else ("yx", "\n".join(ys + xs))]
    fp = MH.fingerprints(spark.createDataFrame(rows, "name string, text string"), ["name"], "text")
    wide = fp.groupBy().pivot("name", ["x", "y", "xy", "yx"]).agg(F.first("lanes"))
    r = wide.select("x", "xy", "yx", MH.add(F.col("x"), F.col("y")).alias("sum"),
                    MH.subtract(F.col("xy"), F.col("y")).alias("less")).first()
    assert r["xy"] == r["yx"] == r["sum"] and r["less"] == r["x"]


def test_defined_cases(spark):
    long_text = "word " * 30_000
    rows = [(1, "a b c"), (1, "a b c"), (2, None), (3, ""), (None, "tail one"), (4, long_text),
            (5, "x y\nz"), (6, "z\nx y"), (1, "other text of one")]
    got = compared(spark, rows)
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r["id"], []).append(r)
    same = [r for r in by[1] if r["n_chars"] == 5]
    assert len(same) == 2 and same[0] == same[1]                     # rows equal in id and text
    assert by[2][0]["fp"] == by[3][0]["fp"] == "0" * 776 and by[2][0]["n_chars"] == 0
    assert by[3][0]["near_edited"] == 1.0                             # empty stays empty
    assert by[5][0]["fp"] == by[6][0]["fp"] and by[6][0]["near_next"] == 1.0   # 6 comes before 5
    assert by[4][0]["edited_sha256"] == hashlib.sha256((long_text[:len(long_text) // 2]).encode()).hexdigest()
    # the row without an id is last; after it the first (6) comes
    assert by[None][0]["edited_sha256"] == hashlib.sha256(edited("tail one", "z\nx y").encode()).hexdigest()


def test_single_row_empty_table_and_clashing_columns(spark):
    one = compared(spark, [(7, "abcd")])
    assert one[0]["edited_sha256"] == hashlib.sha256(b"abab").hexdigest() and one[0]["near_next"] == 1.0
    assert compared(spark, []) == []
    names = "doc_id long, text string, id string, k1 string, k2 long, lanes string, part int, n_chars int, copies int"
    assert len(compared(spark, [(1, "a b", "x", "y", 3, "z", 4, 5, 6)], names)) == 1
