"""Recall of the signatures, measured: `python tests/llm/test_line_recall.py` prints the table."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import line_dedup as LD


def pairs(shingles, similarity, count, seed=5):
    """Pairs of random lines with that many different shingles, of that similarity."""
    rng = random.Random(seed)
    letters = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n))      # noqa: E731
    common = round(similarity * shingles)
    own = (shingles - common) // 2
    starts = [letters(common + LD.SHINGLE - 1) for _ in range(count)]
    return ([x + letters(own) for x in starts], [x + letters(shingles - common - own) for x in starts])


def found(spark, left, right, threshold=0.8):
    """The share of pairs that share a band and whose signatures leave a chance."""
    rows = spark.createDataFrame(list(zip(range(len(left)), left, right)), "id long, left string, right string")
    sides = {}
    for x, name in (("a", "left"), ("b", "right")):
        lines = rows.select("id", F.col(name).alias("line"), F.xxhash64(name).alias("k"))
        signed = (LD.signatures(lines).drop("k2").join(LD.odd_sketches(lines.select("k", "line").distinct()), "k")
                  .join(lines.select("id", "k"), "k"))
        sides[x] = LD._side(signed, x, "id")
    shared = " OR ".join("(" + (" AND ".join(f"m{i}_a = m{i}_b" for i in band) or "true") + ")" for band in LD.BANDS)
    got = sides["a"].join(sides["b"], "id").agg(
        F.avg((F.expr(shared) & LD._near(threshold)).cast("double"))).first()[0]
    return got


@pytest.mark.parametrize("shingles", [10, 20, 40, 80, 200])
def test_recall(spark, shingles):
    assert found(spark, *pairs(shingles, 0.8, 2000)) >= 0.95
    assert found(spark, *pairs(shingles, 0.9, 2000)) >= 0.99


def test_unlike_pairs_are_given_up(spark):
    assert found(spark, *pairs(100, 0.6, 1000)) <= 0.1


def test_sketches_give_up_no_similar_pair(spark, monkeypatch):
    """The odd sketch's bound alone, on pairs at the threshold, repeated shingles included."""
    monkeypatch.setattr(LD, "AGREE", 0)
    monkeypatch.setattr(LD, "BANDS", [()])
    rng = random.Random(8)
    for shingles in (5, 50, 400, 3000):
        left, right = pairs(shingles, 0.81, 300)
        assert found(spark, left, right) == 1.0
        again = [x * rng.randint(2, 3) for x in left]
        assert found(spark, again, [x + x[:9] for x in again]) == 1.0


if __name__ == "__main__":
    from ledgerline.session import local_session
    session = local_session()
    for n in (10, 20, 40, 80, 200, 500):
        print(n, {s: round(found(session, *pairs(n, s, 5000)), 3) for s in (0.6, 0.7, 0.8, 0.85, 0.9)})
