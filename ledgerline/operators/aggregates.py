"""Clean-zone roll-ups of the enriched fact.

The fact is scanned once per *grain*, not once per output: a day grain
(date, branch, account type) feeds the daily and monthly tables, and a
customer grain (branch, customer) feeds branch performance here and the
customer totals of the risk mart. Both grains are far smaller than the fact,
and every count and exact sum composes exactly when rolled up. All are hash
aggregates with a partial (map-side) phase, so a hot group is combined before
the shuffle. The sorts are the reference's output order, on small results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import exact as E
from ledgerline.functions import exprs as X


COUNTED = ["n", "n_amount", "failed", "high"]


def _grain(enriched: DataFrame, by: list[str]) -> DataFrame:
    return E.exact_totals(enriched, by, {"value": "transaction_amount"}, {
        "n": E.known("transaction_id"), "n_amount": E.known("transaction_amount"),
        "failed": F.col("is_failed"), "high": F.col("is_high_value")})


def day_grain(enriched: DataFrame) -> DataFrame:
    """(transaction_date, branch_id, account_type) -> counts and exact sums."""
    return _grain(enriched, ["transaction_date", "branch_id", "account_type"])


def customer_grain(enriched: DataFrame) -> DataFrame:
    """(branch_id, customer_id) -> counts and exact sums."""
    return _grain(enriched, ["branch_id", "customer_id"])


def daily_from_grain(grain: DataFrame) -> DataFrame:
    days = E.roll_up(grain, ["transaction_date", "branch_id"], "value", COUNTED)
    return (days.select("transaction_date", "branch_id", F.col("n").alias("txn_count"),
                        E.value("value").alias("total_amount"), "n_amount",
                        F.col("failed").alias("failed_count"))
            .withColumn("avg_amount", F.col("total_amount") / F.col("n_amount")).drop("n_amount")
            .orderBy("transaction_date", "branch_id"))


def monthly_from_grain(grain: DataFrame) -> DataFrame:
    # The reference's sort omits account_type; it is added so the order is total.
    by = ["txn_year_month", "branch_id", "account_type"]
    months = E.roll_up(grain.withColumn("txn_year_month", F.date_format("transaction_date", "yyyy-MM")), by,
                       "value", COUNTED)
    return (months.select(*by, F.col("n").alias("txn_count"), E.value("value").alias("total_amount"), "n_amount",
                          F.col("high").alias("high_value_count"), F.col("failed").alias("failed_count"))
            .withColumn("avg_amount", F.col("total_amount") / F.col("n_amount")).drop("n_amount")
            .orderBy(*by))


def branch_performance_from_grain(grain: DataFrame, branches: DataFrame) -> DataFrame:
    """Per branch: count, exact value, failures, distinct customers, failure %.

    Distinct customers are the customer-grain rows with a customer, so no
    second distinct aggregation is needed. Branches without transactions are
    absent; a NULL-branch group is kept.
    """
    known = grain.withColumn("active", E.known("customer_id"))
    perf = E.roll_up(known, ["branch_id"], "value", [*COUNTED, "active"]).select(
        "branch_id", F.col("n").alias("total_transactions"), E.value("value").alias("total_value"),
        F.col("failed").alias("failed_transactions"), F.col("active").alias("active_customers"))
    perf = perf.withColumn(
        "failure_rate_pct",
        X.round2(F.col("failed_transactions") / F.col("total_transactions") * 100))
    return perf.join(branches, "branch_id", "left").orderBy(F.col("total_value").desc())


def build_daily_aggregations(enriched: DataFrame) -> DataFrame:
    return daily_from_grain(day_grain(enriched))


def build_monthly_aggregations(enriched: DataFrame) -> DataFrame:
    return monthly_from_grain(day_grain(enriched))


def build_branch_performance(enriched: DataFrame, branches: DataFrame) -> DataFrame:
    return branch_performance_from_grain(customer_grain(enriched), branches)
