"""Exact sums against fractions: any size, any order, any partitioning."""
import math
import random
from fractions import Fraction

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from ledgerline.functions import exact as E


def nearest(xs):
    known = [Fraction(x) for x in xs if x is not None]
    if not known:
        return None
    try:
        return float(sum(known))
    except OverflowError:
        return math.inf if sum(known) > 0 else -math.inf


def summed(spark, groups, slices=5):
    rows = [(k, x) for k, xs in groups.items() for x in xs]
    df = spark.createDataFrame(rows, "k string, x double").repartition(slices)
    return {r["k"]: (r["v"], r["n"]) for r in E.totals_by(df, ["k"], {"v": "x"}, {"n": F.lit(1)}).collect()}


CASES = {
    "cents": [0.1, 0.2, 0.3] * 1000,
    "cancels": [1e300, 4e-7, -1e300, 1e22, -1e22, 3.3],
    "smallest": [5e-324] * 7 + [2.2e-308] * 3,
    "negative smallest": [-5e-324] * 7,
    "no numbers": [None, None],
    "zeros": [0.0, -0.0],
    "nothing left": [1.5, -1.5],
    "largest": [1.7976931348623157e308, -1e292, 4e-7],
    "too large": [1.7976931348623157e308] * 2,
    "tie to even": [2.0 ** 53, 1.0],
    "just above the tie": [2.0 ** 53, 1.0, 2.0 ** -1000],
    "just below the tie": [2.0 ** 53, 1.0, -2.0 ** -1000],
    "below powers of two": [2.0 ** k * (1 - 2 ** -53) for k in range(-1000, 1000, 7)],
    "four millionths of a tenth": [4e-7] * 10,
}


def test_named_cases(spark):
    assert summed(spark, CASES) == {k: (nearest(xs), len(xs)) for k, xs in CASES.items()}


@settings(max_examples=10, deadline=None)
@given(st.lists(st.lists(st.floats(allow_nan=False, allow_infinity=False) | st.none(), max_size=12),
                min_size=1, max_size=12), st.integers(1, 9))
def test_any_doubles(spark, lists, slices):
    groups = {str(i): xs for i, xs in enumerate(lists) if xs} | {"one": [1.0]}
    assert summed(spark, groups, slices) == {k: (nearest(xs), len(xs)) for k, xs in groups.items()}


def test_many_numbers_in_any_order(spark):
    rng = random.Random(4)
    xs = [rng.choice([1, -1]) * rng.random() * 10.0 ** rng.randint(-7, 22) for _ in range(20_000)]
    for n in (1, 3, 16):
        rng.shuffle(xs)
        assert summed(spark, {"all": xs}, n)["all"][0] == nearest(xs)


def test_roll_up_is_the_sum_itself(spark):
    rng = random.Random(5)
    rows = [(i % 7, i % 50, None if i % 11 == 0 else rng.uniform(-1, 1) * 10.0 ** rng.randint(-300, 300))
            for i in range(2000)] + [(9, 1, None)]
    df = spark.createDataFrame(rows, "a int, b int, x double")
    grain = E.exact_totals(df, ["a", "b"], {"v": "x"}, {"n": F.lit(1), "known": E.known("x")})
    for by in (["a"], []):
        got = E.roll_up(grain, by, "v", ["n", "known"]).select(*by, E.value("v").alias("s"), "n", "known").collect()
        for r in got:
            mine = [x for a, _, x in rows if not by or a == r["a"]]
            assert r["s"] == nearest(mine) and r["n"] == len(mine)
            assert r["known"] == sum(x is not None for x in mine)
        assert len(got) == (8 if by else 1)


def test_two_sums_beside_each_other_and_no_rows(spark):
    df = spark.createDataFrame([("k", 1e300, 0.1), ("k", 1.0, 1e22), ("k", -1e300, None)], "k string, x double, y double")
    assert tuple(E.totals_by(df, ["k"], {"sx": "x", "sy": "y"}).first()) == ("k", 1.0, nearest([0.1, 1e22]))
    assert tuple(E.totals_by(df.limit(0), [], {"s": "x"}, {"n": F.lit(1)}).first()) == (None, 0)
    assert E.totals_by(df.limit(0), ["k"], {"s": "x"}).collect() == []


@pytest.mark.parametrize("by", [["k"], []])
def test_parts_are_added_map_side_and_nothing_is_python(spark, by):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").cast("double").alias("x"))
    plan = E.totals_by(df, by, {"s": "x"})._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "Python" not in plan and "Window" not in plan
