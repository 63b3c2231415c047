"""Column expressions: hand-written expectations."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import exprs as X


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


@pytest.mark.parametrize("text,expected", [
    ("2024-05-06", dt.date(2024, 5, 6)), ("06-05-2024", dt.date(2024, 5, 6)),
    ("05/06/2024", dt.date(2024, 5, 6)), ("2024/05/06", dt.date(2024, 5, 6)),
    # the generator's bad values
    ("31/13/2025", None), ("2025-02-30", None), ("", None), ("NaT", None),
    ("not_a_date", None), ("00/00/0000", None),
    # zero-padded only
    ("5/6/2024", None), ("13/05/2024", None), ("2024-5-6", None), (None, None),
    ("2024-02-29", dt.date(2024, 2, 29)), ("2023-02-29", None),
])
def test_parse_date(spark, text, expected):
    assert one(spark, X.parse_date("v"), text) == expected


def test_to_int_goes_through_double(spark):
    assert one(spark, X.to_int("v"), "682.0") == 682          # T3
    assert one(spark, X.to_int("v"), "garbage") is None       # T2: no ANSI failure
    assert one(spark, X.to_int("v"), "1e20") is None          # overflow -> NULL


def test_to_double_tolerates_garbage(spark):
    assert one(spark, X.to_double("v"), "12.5") == 12.5
    assert one(spark, X.to_double("v"), "abc") is None


def test_ok_turns_null_into_false(spark):
    df = spark.createDataFrame([(None,), ("Deposit",), ("Bogus",)], "t string")
    got = [r["r"] for r in df.select(X.ok(F.col("t").isin("Deposit")).alias("r")).collect()]
    assert got == [False, True, False]


@pytest.mark.parametrize("x,expected", [(2.675, 2.68), (1.005, 1.01), (-1.005, -1.01),
                                        (0.125, 0.13), (10.0, 10.0), (1 / 3, 0.33)])
def test_round2_rounds_half_away_from_zero_on_decimal_value(spark, x, expected):
    assert one(spark, X.round2(F.col("v")), x, "v double") == expected


@pytest.mark.parametrize("income,bracket", [(299_999.99, "Low"), (300_000.0, "Medium"),
                                            (999_999.0, "Medium"), (1_000_000.0, "High"),
                                            (None, "High")])
def test_income_bracket(spark, income, bracket):                  # T9
    assert one(spark, X.income_bracket("v"), income, "v double") == bracket


def risk(spark, cs, rate, d, o):
    df = spark.createDataFrame([(cs, rate, d, o)], "cs int, rate double, d long, o long")
    return df.select(X.risk_score("cs", "rate", "d", "o").alias("s")).first()["s"]


def test_risk_score_components_and_cap(spark):
    assert risk(spark, 900, 0.0, 0, 0) == 0.0
    assert risk(spark, 300, 0.0, 0, 0) == 28.0
    assert risk(spark, 900, 1.0, 0, 0) == 12.0
    assert risk(spark, 900, 0.0, 1, 0) == 32.0                    # a default alone -> Medium
    assert risk(spark, 300, 1.0, 3, 2) == 100.0                   # capped
    assert risk(spark, None, 0.0, 0, 0) == 100.0                  # least() skips NULL (T9)
    assert risk(spark, 950, 0.0, 0, 0) < 0                        # no lower clamp


@pytest.mark.parametrize("score,tier", [(29.99, "Low"), (30.0, "Medium"), (59.99, "Medium"),
                                        (60.0, "High")])
def test_risk_tier_boundaries(spark, score, tier):
    assert one(spark, X.risk_tier("v"), score, "v double") == tier


@pytest.mark.parametrize("score,band", [(499, "< 500"), (500, "500-599"), (699, "600-699"),
                                        (799, "700-799"), (800, "800+"), (None, "800+")])
def test_credit_band(spark, score, band):
    assert one(spark, X.credit_band("v"), score, "v int") == band


def test_high_value_is_strict(spark):
    from ledgerline.operators.enrich import add_calculated_columns
    df = spark.createDataFrame([(dt.date(2024, 1, 5), 100000.0, "Failed", None),
                                (dt.date(2024, 1, 6), 100000.01, None, 500000.0)],
                               "transaction_date date, transaction_amount double, "
                               "payment_status string, customer_income double")
    rows = add_calculated_columns(df).orderBy("transaction_date").collect()
    assert [r.is_high_value for r in rows] == [0, 1]
    assert [r.is_failed for r in rows] == [1, None]               # NULL stays NULL
    assert [r.income_bracket for r in rows] == ["High", "Medium"]
    assert rows[0].txn_year_month == "2024-01"


def test_only_usable_numbers_pass(spark):
    rows = [("1.5",), ("NaN",), ("Infinity",), ("-Infinity",), ("1e999",), ("1e22",), ("-1e300",), ("x",), (None,)]
    got = [r.x for r in spark.createDataFrame(rows, "t string").select(X.to_double("t").alias("x")).collect()]
    assert got == [1.5, None, None, None, None, 1e22, -1e300, None, None]


def test_rounding_at_any_size(spark):
    for x, rounded in ((1e13 / 3, 3333333333333.33), (1e15 + 0.375, 1e15 + 0.375), (-1e300, -1e300), (4e-7, 0.0)):
        assert one(spark, X.round2(F.col("v")), x, "v double") == rounded


def test_rate_of_nothing_is_null(spark):
    assert spark.range(0).agg(X.pct(F.count_if(F.col("id") > 0), F.count("id")).alias("p")).first()["p"] is None
