"""BI measures and visual extracts (B1-B17, V1-V10, F9 slicers).

Measures come back in long form, one ``(measure, value)`` row each: every
source table is scanned by one aggregate and the rows are stacked, so no join
is needed to put single-row results side by side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import exact as E
from ledgerline.functions import exprs as X
from ledgerline.plans.warehouse import Warehouse


def sliced_fact(wh: Warehouse, year: int | None = None, branch_name: str | None = None,
                channel: str | None = None) -> DataFrame:
    """Fact rows under the report slicers (F9); the filters reach the scan."""
    f = wh.fact_transaction
    if year is not None:
        # the prefix test on the partition column lets the scan skip other years
        f = f.where(F.col("txn_year_month").startswith(f"{year:04d}-")
                    & (F.col("txn_year") == year))
    if channel is not None:
        f = f.where(F.col("channel") == channel)
    if branch_name is not None:
        ids = wh.dim_branch.where(F.col("branch_name") == branch_name).select("branch_id")
        f = f.join(ids, "branch_id", "left_semi")
    return f


def _stack(agg: DataFrame, names: dict[str, str]) -> DataFrame:
    rows = [F.struct(F.lit(label).alias("measure"), F.col(c).cast("double").alias("value"))
            for c, label in names.items()]
    return agg.select(F.explode(F.array(*rows)).alias("m")).select("m.*")


def _counted(totals: DataFrame, acc: str) -> DataFrame:
    """Accumulator as a double, 0 where nothing was counted."""
    return totals.select(*[E.value(c).alias(c) if c == acc else F.coalesce(c, F.lit(0)).alias(c)
                           for c in totals.columns])


def _ratio_pct(part: Column, whole: Column) -> Column:
    """DIVIDE(part, whole, 0) * 100: zero when the whole is zero or blank."""
    return F.coalesce(F.try_divide(part.cast("double"), whole), F.lit(0.0)) * 100


def bi_measures(wh: Warehouse, year: int | None = None, branch_name: str | None = None,
                channel: str | None = None) -> DataFrame:
    """B1-B15 as rows; the transaction measures honour the slicers."""
    f = sliced_fact(wh, year, branch_name, channel)
    is_ = lambda c, v: F.when(F.col(c) == v, 1).otherwise(0)
    # by customer first: its rows with a customer are the active ones
    by_customer = E.exact_totals(f, ["customer_id"], {"b2": "transaction_amount"}, {
        "b1": F.lit(1), "n_amount": E.known("transaction_amount"), "b5": is_("payment_status", "Failed"),
        "b7": is_("is_high_value", 1)}).withColumn("b4", E.known("customer_id"))
    txn = _counted(E.roll_up(by_customer, [], "b2", ["b1", "n_amount", "b4", "b5", "b7"]), "b2").select(
        "*", F.try_divide("b2", "n_amount").alias("b3"), _ratio_pct(F.col("b5"), F.col("b1")).alias("b6"))
    risk = E.totals_by(wh.customer_risk_metrics, [], {"score": "risk_score"}, {
        # the mart has one row per customer
        "b8": is_("risk_tier", "High"), "b9": is_("risk_tier", "Medium"), "b10": is_("risk_tier", "Low"),
        "n": E.known("risk_score")}).select("*", F.try_divide("score", "n").alias("b11"))
    loans = E.totals_by(wh.fact_loan, [], {"b15": "loan_amount"}, {
        "b12": F.lit(1), "b13": is_("loan_status", "Defaulted")}).select(
        "*", _ratio_pct(F.col("b13"), F.col("b12")).alias("b14"))
    return (_stack(txn, {"b1": "Total Transactions", "b2": "Total Transaction Value",
                         "b3": "Avg Transaction Value", "b4": "Active Customers",
                         "b5": "Failed Transactions", "b6": "Failed Transaction Rate %",
                         "b7": "High Value Transactions"})
            .unionByName(_stack(risk, {"b8": "High Risk Customers",
                                       "b9": "Medium Risk Customers",
                                       "b10": "Low Risk Customers", "b11": "Avg Risk Score"}))
            .unionByName(_stack(loans, {"b12": "Total Loans", "b13": "Defaulted Loans",
                                        "b14": "Loan Default Rate %",
                                        "b15": "Total Loan Book"})))


def data_quality_kpi(wh: Warehouse) -> DataFrame:
    """Best score over all runs as '0.0%' text (the dashboard's rule), and
    the latest run's score beside it."""
    log = wh.data_quality_log
    text = lambda c: F.concat(
        F.round(c.cast("decimal(18,6)"), 1).cast("decimal(18,1)").cast("string"), F.lit("%"))
    return log.agg(text(F.max("data_quality_score_pct")).alias("data_quality_score_max"),
                   text(F.max_by("data_quality_score_pct", "run_at"))
                   .alias("data_quality_score_latest"))


def _monthly_value(wh: Warehouse) -> DataFrame:
    """By date first: only one row a day meets the calendar."""
    by_day = E.exact_totals(wh.fact_transaction, ["transaction_date"], {"value": "transaction_amount"})
    d = F.broadcast(wh.dim_date)
    months = E.roll_up(by_day.join(d, by_day.transaction_date == d.date_key), ["year_month"], "value", [])
    return months.select("year_month", E.value("value").alias("total_value"))


def txn_value_mom(wh: Warehouse) -> DataFrame:
    """Month-over-month value change by calendar month.

    The prior month is found by a join on ``month - 1``, not ``lag``: with a
    gap in the months, ``lag`` would compare against an older month. An absent
    or zero prior month gives 0, like DIVIDE(x, 0, 0).
    """
    cur = _monthly_value(wh)
    prior_key = F.date_format(F.add_months(F.to_date(F.concat("year_month", F.lit("-01"))), -1),
                              "yyyy-MM")
    prior = cur.select(F.col("year_month").alias("prior_month"),
                       F.col("total_value").alias("prior_value"))
    joined = cur.withColumn("prior_month", prior_key).join(prior, "prior_month", "left")
    mom = F.when(F.col("prior_value").isNull() | (F.col("prior_value") == 0), F.lit(0.0)) \
        .otherwise((F.col("total_value") - F.col("prior_value")) / F.col("prior_value") * 100)
    return joined.select("year_month", "total_value", "prior_value",
                         X.round2(mom).alias("value_mom_pct")).orderBy("year_month")


def txn_by_status(wh: Warehouse) -> DataFrame:
    """V2: transactions per payment status."""
    return (wh.fact_transaction.groupBy("payment_status")
            .agg(F.count(F.lit(1)).alias("txn_count")).orderBy("payment_status"))


def fact_profile(wh: Warehouse) -> DataFrame:
    """Bounds, distinct and NULL counts of the fact, one row."""
    f = wh.fact_transaction
    nulls = [F.count_if(F.col(c).isNull()).alias(f"null_{c}")
             for c in ("account_id", "customer_id", "branch_id", "transaction_amount", "is_failed")]
    ids = f.groupBy("transaction_id").agg(F.count(F.lit(1)).alias("n")).agg(
        F.count("transaction_id").alias("distinct_ids"))
    bounds = f.agg(F.count(F.lit(1)).alias("n_rows"), F.min("transaction_amount").alias("min_amount"),
                   F.max("transaction_amount").alias("max_amount"),
                   F.min("transaction_date").alias("first_date"),
                   F.max("transaction_date").alias("last_date"), *nulls)
    return bounds.join(F.broadcast(ids))          # one row each


def calendar_daily_series(wh: Warehouse) -> DataFrame:
    """Every calendar day from the first to the last transaction, with its calendar
    columns, count and value (0 on days without any)."""
    by_day = E.totals_by(wh.fact_transaction, ["transaction_date"], {"value": "transaction_amount"},
                         {"n": F.lit(1)})
    span = by_day.agg(F.min("transaction_date").alias("first"), F.max("transaction_date").alias("last"))
    d = wh.dim_date
    days = d.join(F.broadcast(span), d.date_key.between(F.col("first"), F.col("last")))   # one row
    return (days.join(by_day, d.date_key == by_day.transaction_date, "left")
            .select("date_key", "day", "month", "month_name", "quarter", "year", "year_month",
                    "day_of_week", "is_weekend", F.coalesce("n", F.lit(0)).alias("txn_count"),
                    F.coalesce("value", F.lit(0.0)).alias("total_value"))
            .orderBy("date_key"))


def txn_by_month_name(wh: Warehouse) -> DataFrame:
    """V3: transactions per calendar month name, in month order."""
    by_day = wh.fact_transaction.groupBy("transaction_date").agg(F.count(F.lit(1)).alias("n"))
    d = F.broadcast(wh.dim_date)
    return (by_day.join(d, by_day.transaction_date == d.date_key).groupBy("month", "month_name")
            .agg(F.sum("n").alias("txn_count")).orderBy("month"))


def txn_value_by_type(wh: Warehouse) -> DataFrame:
    """Value per transaction type."""
    return (E.totals_by(wh.fact_transaction, ["transaction_type"], {"total_value": "transaction_amount"})
            .orderBy(F.col("total_value").desc()))


def txn_value_by_branch(wh: Warehouse) -> DataFrame:
    """Value per branch name."""
    by_branch = E.exact_totals(wh.fact_transaction, ["branch_id"], {"value": "transaction_amount"})
    named = E.roll_up(by_branch.join(wh.dim_branch, "branch_id"), ["branch_name"], "value", [])
    return named.select("branch_name", E.value("value").alias("total_value")).orderBy(F.col("total_value").desc())


def high_value_by_branch(wh: Warehouse) -> DataFrame:
    """V7: high-value transactions per branch name."""
    by_branch = wh.fact_transaction.groupBy("branch_id").agg(
        F.count_if(F.col("is_high_value") == 1).alias("n"))
    return (by_branch.join(wh.dim_branch, "branch_id").groupBy("branch_name")
            .agg(F.sum("n").alias("high_value_transactions"))
            .orderBy(F.col("high_value_transactions").desc(), "branch_name"))


def credit_histogram(wh: Warehouse, width: int = 100) -> DataFrame:
    """V9: credit scores in bins of ``width`` points."""
    start = (F.floor(F.col("credit_score") / width) * width).cast("int")
    return (wh.dim_customer.groupBy(start.alias("bin_start"))
            .agg(F.count(F.lit(1)).alias("customer_count")).orderBy("bin_start"))


def risk_scatter(wh: Warehouse) -> DataFrame:
    """One point per customer."""
    return wh.customer_risk_metrics.select("customer_id", "credit_score", "risk_score",
                                           "total_loan_amount", "risk_tier")
