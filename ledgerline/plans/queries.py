"""The warehouse's fixed analytical questions (Q1-Q10) as DataFrame plans.

Result types are pinned on purpose (T7): counts are BIGINT, money is an exact
sum (``functions/exact.py``) returned as DOUBLE, rates and averages go through ``round2``.
Top-k queries break ties on the id so the cut-off row is deterministic.
The calendar dimension is broadcast explicitly: its size is fixed by the
calendar years (4,748 rows), not by the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import exact as E
from ledgerline.functions import exprs as X
from ledgerline.plans.warehouse import Warehouse


def _n() -> F.Column:
    return F.count(F.lit(1))


# Q1 ---------------------------------------------------------------------------
def _one() -> F.Column:
    return F.lit(1)


def _mean(total: str, n: str) -> F.Column:
    return F.try_divide(F.col(total), F.col(n))


AMOUNT = "transaction_amount"


def total_txn_value(wh: Warehouse) -> DataFrame:
    t = E.totals_by(wh.fact_transaction, [], {"total_transaction_value": AMOUNT}, {"total_transactions": _one()})
    return t.select("total_transactions", "total_transaction_value")


def txn_value_by_month(wh: Warehouse) -> DataFrame:
    t = E.totals_by(wh.fact_transaction, ["txn_year_month"], {"total_value": AMOUNT}, {"transaction_count": _one()})
    return t.select("txn_year_month", "transaction_count", "total_value").orderBy("txn_year_month")


# Q2 ---------------------------------------------------------------------------
def avg_txn_amount(wh: Warehouse) -> DataFrame:
    t = E.totals_by(wh.fact_transaction, [], {"value": AMOUNT}, {"n": E.known(AMOUNT)})
    return t.select(X.round2(_mean("value", "n")).alias("avg_transaction_amount"))


def avg_txn_by_type(wh: Warehouse) -> DataFrame:
    t = E.totals_by(wh.fact_transaction, ["transaction_type"], {"value": AMOUNT},
                    {"txn_count": _one(), "n": E.known(AMOUNT)})
    return (t.select("transaction_type", "txn_count", X.round2(_mean("value", "n")).alias("avg_amount"))
            .orderBy(F.col("avg_amount").desc(), "transaction_type"))


# Q3 ---------------------------------------------------------------------------
def high_value_detail(wh: Warehouse, k: int = 100) -> DataFrame:
    return (wh.fact_transaction.where(F.col("is_high_value") == 1)
            .select("transaction_id", "customer_id", "branch_id", "transaction_date",
                    "transaction_amount", "transaction_type", "payment_status")
            .orderBy(F.col("transaction_amount").desc(), "transaction_id")
            .limit(k))


def high_value_summary(wh: Warehouse) -> DataFrame:
    high = wh.fact_transaction.where(F.col("is_high_value") == 1)
    t = E.totals_by(high, [], {"high_value_txn_total": AMOUNT}, {"high_value_txn_count": _one()})
    return t.select("high_value_txn_count", "high_value_txn_total")


# Q4 ---------------------------------------------------------------------------
def _failure_aggs() -> list[F.Column]:
    return [_n().alias("total_txns"),
            F.sum("is_failed").cast("long").alias("failed_txns"),
            X.pct(F.sum("is_failed"), _n()).alias("failed_rate_pct")]


def failed_rate(wh: Warehouse) -> DataFrame:
    return wh.fact_transaction.agg(*_failure_aggs())


def failed_rate_by_channel(wh: Warehouse) -> DataFrame:
    return (wh.fact_transaction.groupBy("channel").agg(*_failure_aggs())
            .orderBy(F.col("failed_rate_pct").desc(), "channel"))


# Q5 ---------------------------------------------------------------------------
def top_risk_customers(wh: Warehouse, k: int = 20) -> DataFrame:
    return (wh.customer_risk_metrics
            .select("customer_id", "credit_score", "risk_score", "risk_tier",
                    "total_transactions", "failed_transactions", "defaulted_loans",
                    "overdue_loans")
            .orderBy(F.col("risk_score").desc(), "customer_id")
            .limit(k))


def risk_tier_distribution(wh: Warehouse) -> DataFrame:
    """Flagship: customers, average score and credit, and value per risk tier."""
    t = E.totals_by(wh.customer_risk_metrics, ["risk_tier"],
                    {"score": "risk_score", "total_txn_value": "total_transaction_value"},
                    {"customer_count": _one(), "n": E.known("risk_score"), "credit": F.col("credit_score"),
                     "n_credit": E.known("credit_score")})
    return (t.select("risk_tier", "customer_count", X.round2(_mean("score", "n")).alias("avg_risk_score"),
                     X.round0(_mean("credit", "n_credit")).alias("avg_credit_score"), "total_txn_value")
            .orderBy(F.col("avg_risk_score").desc()))


# Q6 ---------------------------------------------------------------------------
def monthly_trend(wh: Warehouse) -> DataFrame:
    """By date first (combined map-side): only one row a day meets the calendar."""
    by_day = E.exact_totals(wh.fact_transaction, ["transaction_date"], {"value": AMOUNT},
                            {"n": E.known("transaction_id"), "high": F.col("is_high_value")})
    d = F.broadcast(wh.dim_date)
    months = E.roll_up(by_day.join(d, by_day.transaction_date == d.date_key), ["year", "month", "month_name"],
                       "value", ["n", "high"])
    return (months.select("year", "month", "month_name", F.col("n").alias("txn_count"),
                          E.value("value").alias("total_value"),
                          X.pct(F.col("high"), F.col("n")).alias("high_value_pct"))
            .orderBy("year", "month"))


# Q7 ---------------------------------------------------------------------------
def branch_performance_sql(wh: Warehouse) -> DataFrame:
    # by branch and customer first (combined map-side), the branch names last:
    # the fact is never shuffled by branch
    by_customer = E.exact_totals(wh.fact_transaction, ["branch_id", "customer_id"], {"value": AMOUNT},
                                 {"n": E.known("transaction_id"), "failed": F.col("is_failed")})
    by_branch = E.roll_up(by_customer.withColumn("active_customers", E.known("customer_id")), ["branch_id"], "value",
                          ["n", "failed", "active_customers"])
    return (by_branch.join(wh.dim_branch, "branch_id")
            .select("branch_name", "city", F.col("n").alias("total_transactions"),
                    E.value("value").alias("total_value"),
                    X.pct(F.col("failed"), F.col("n")).alias("failure_rate_pct"), "active_customers")
            .orderBy(F.col("total_value").desc()))


def _account_branch_risk(wh: Warehouse) -> DataFrame:
    a = wh.dim_account.select("account_id", "customer_id", "branch_id")
    b = wh.dim_branch.select("branch_id", "branch_name")
    r = wh.customer_risk_metrics.select("customer_id", "risk_score", "risk_tier")
    return a.join(b, "branch_id").join(r, "customer_id")


def branch_risk(wh: Warehouse) -> DataFrame:
    """Q7b as written: one row per *account*, so the average is account-weighted
    and ``high_risk_customers`` counts accounts of High customers (T8)."""
    # by branch and customer first: its rows are the distinct customers, and its counts the weights
    per_customer = E.exact_totals(_account_branch_risk(wh), ["branch_name", "customer_id"], {"score": "risk_score"},
                                  {"n": E.known("risk_score"), "high": X.flag(F.col("risk_tier") == "High")})
    return _branch_risk(per_customer)


def _branch_risk(per_customer: DataFrame) -> DataFrame:
    t = E.roll_up(per_customer.withColumn("customers_served", E.known("customer_id")), ["branch_name"], "score",
                  ["n", "high", "customers_served"])
    return (t.select("branch_name", "customers_served",
                     X.round2(F.try_divide(E.value("score"), F.col("n"))).alias("avg_customer_risk_score"),
                     F.coalesce("high", F.lit(0).cast("long")).alias("high_risk_customers"))
            .orderBy(F.col("avg_customer_risk_score").desc(), "branch_name"))


def branch_risk_distinct(wh: Warehouse) -> DataFrame:
    """Q7b per distinct customer of each branch (the reading the name suggests)."""
    per_customer = (_account_branch_risk(wh)
                    .select("branch_name", "customer_id", "risk_score", "risk_tier")
                    .dropDuplicates(["branch_name", "customer_id"]))
    return _branch_risk(E.exact_totals(
        per_customer, ["branch_name", "customer_id"], {"score": "risk_score"},
        {"n": E.known("risk_score"), "high": X.flag(F.col("risk_tier") == "High")}))


# Q8 ---------------------------------------------------------------------------
def _default_aggs(count_col: F.Column) -> list[F.Column]:
    defaulted = F.count_if(F.col("loan_status") == "Defaulted")
    return [count_col.alias("total_loans"), defaulted.alias("defaulted_loans"),
            X.pct(defaulted, count_col).alias("default_rate_pct")]


def loan_default_rate(wh: Warehouse) -> DataFrame:
    return wh.fact_loan.agg(*_default_aggs(_n()))


def loan_default_by_type(wh: Warehouse) -> DataFrame:
    t = E.totals_by(wh.fact_loan, ["loan_type"], {"rate": "interest_rate", "total_loan_book": "loan_amount"},
                    {"total_loans": _one(), "n_rate": E.known("interest_rate"),
                     "defaulted_loans": F.when(F.col("loan_status") == "Defaulted", 1).otherwise(0)})
    return (t.select("loan_type", "total_loans", "defaulted_loans",
                     X.pct(F.col("defaulted_loans"), F.col("total_loans")).alias("default_rate_pct"),
                     X.round2(_mean("rate", "n_rate")).alias("avg_interest_rate"), "total_loan_book")
            .orderBy(F.col("default_rate_pct").desc(), "loan_type"))


def loan_default_by_tier(wh: Warehouse) -> DataFrame:
    """Q8c. Read with care: a defaulted loan alone puts a customer at >= Medium
    (32 points against a cut of 30), so Low has no defaults by construction (T10)."""
    loans = wh.fact_loan.select("loan_id", "customer_id", "loan_status")
    risk = wh.customer_risk_metrics.select("customer_id", "risk_tier")
    return (loans.join(risk, "customer_id").groupBy("risk_tier")
            .agg(*_default_aggs(F.count("loan_id")))
            .orderBy(F.col("default_rate_pct").desc(), "risk_tier"))


# Q9 ---------------------------------------------------------------------------
def dq_log_trend(wh: Warehouse, k: int = 10) -> DataFrame:
    return (wh.data_quality_log
            .select("run_at", "total_records", "valid_records", "rejected_records",
                    "data_quality_score_pct", "passed_quality_gate")
            .orderBy(F.col("run_at").desc())
            .limit(k))


# Q10 --------------------------------------------------------------------------
def credit_band_distribution(wh: Warehouse) -> DataFrame:
    return (wh.dim_customer.groupBy(X.credit_band("credit_score").alias("credit_score_band"))
            .agg(_n().alias("customer_count"), F.min("credit_score").alias("_lowest"))
            .orderBy("_lowest")
            .drop("_lowest"))
