"""Derive the five raw banking sources from the driver's TPC-H-ish test tables.

Every value is a deterministic expression of the input rows (no randomness),
so the same rows can be rebuilt in plain SQL for the oracle. Dirt is injected
by key arithmetic at roughly the rates the reference's generator uses: NULL
and orphan accounts, negative and missing amounts, NULL and unknown types,
bad date text, exact re-sent rows, and conflicting ids (lineitem repeats
``(l_orderkey, l_linenumber)`` with different payloads; a few customers are
re-sent with another city and income).

Dates are shifted by ``DATE_SHIFT_DAYS`` so the 1995-2001 test dates land in
2020-2026, inside the warehouse calendar.

All five frames are lazy: nothing is read until an action runs, and the
join of ``lineitem`` with ``part`` is left to the planner (broadcast when the
part table is under the broadcast threshold, a shuffle join otherwise).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.sources.ingest import RawTables

DATE_SHIFT_DAYS = 9131

# Fixed mapping of the test enumerations onto the banking vocabulary.
ACCOUNT_TYPE_BY_PRIORITY = {
    "1-URGENT": "Savings", "2-HIGH": "Current", "3-MEDIUM": "Salary",
    "4-NOT SPECIFIED": "NRI", "5-LOW": "Fixed Deposit",
}
LOAN_TYPE_BY_PRIORITY = {
    "1-URGENT": "Home Loan", "2-HIGH": "Personal Loan", "3-MEDIUM": "Auto Loan",
    "4-NOT SPECIFIED": "Education Loan", "5-LOW": "Business Loan",
}
# LARGE maps to a type outside the valid enumeration on purpose.
TXN_TYPE_BY_PART_TYPE = {
    "STANDARD": "Deposit", "ECONOMY": "Withdrawal", "MEDIUM": "Transfer",
    "PROMO": "Bill Payment", "SMALL": "POS Purchase", "LARGE": "Wire Transfer",
}
ACCOUNT_STATUS_BY_ORDER_STATUS = {"F": "Closed", "O": "Active", "P": "Dormant"}
CHANNEL_BY_SUPPKEY_MOD5 = ["Mobile App", "Internet Banking", "Branch", "ATM", "POS"]
EMI_STATUS_BY_MOD4 = ["Success", "Failed", "Pending", "Reversed"]

TEST_TABLES = ("region", "nation", "customer", "part", "orders", "lineitem")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _mapped(c: Column, mapping: dict[str, str]) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == k, v) if expr is None else expr.when(c == k, v)
    return expr


def _pick(index: Column, values: list[str]) -> Column:
    expr = None
    for i, v in enumerate(values):
        expr = F.when(index == i, v) if expr is None else expr.when(index == i, v)
    return expr


def shifted_iso(ts: Column) -> Column:
    """'yyyy-MM-dd' text of a test timestamp moved into the calendar range."""
    return F.date_add(ts.cast("date"), DATE_SHIFT_DAYS).cast("string")


def mixed_date_text(iso: Column, selector: Column) -> Column:
    """Render ISO text in one of the four accepted shapes, by ``selector % 4``."""
    y, m, d = F.substring(iso, 1, 4), F.substring(iso, 6, 2), F.substring(iso, 9, 2)
    sel = selector % 4
    return (F.when(sel == 0, iso)
            .when(sel == 1, F.concat_ws("-", d, m, y))
            .when(sel == 2, F.concat_ws("/", m, d, y))
            .otherwise(F.concat_ws("/", y, m, d)))


def _other_shape(df: DataFrame, date: str, key: str, every: int) -> DataFrame:
    """Rows sent again with ISO dates written day first: equal once parsed."""
    text = F.col(date)
    iso = text.rlike(r"^\d{4}-\d{2}-\d{2}$")
    turned = F.concat_ws("-", F.substring(text, 9, 2), F.substring(text, 6, 2), F.substring(text, 1, 4))
    return df.where(iso & (F.col(key) % every < 4)).withColumn(date, turned)


def bridge_customers(customer: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    base = customer.select(
        key.alias("customer_id"),
        F.col("c_name").alias("first_name"),
        F.col("c_mktsegment").alias("last_name"),
        F.date_add(F.lit("1950-01-01").cast("date"), ((key * 37) % 18000).cast("int"))
        .cast("string").alias("dob"),
        _pick(key % 3, ["Male", "Female", "Other"]).alias("gender"),
        F.concat(F.lit(" User"), key.cast("string"), F.lit("@Example.COM ")).alias("email"),
        F.lpad(key.cast("string"), 10, "0").alias("phone"),
        F.concat(F.lit(" "), F.lower("c_mktsegment"), F.lit(" ")).alias("city"),
        F.concat(F.lit("Nation "), F.col("c_nationkey").cast("string")).alias("country"),
        F.when(key % 101 == 3, F.lit(None).cast("double"))
        .otherwise(F.col("c_acctbal") * 150).alias("customer_income"),
        F.when(key % 100 == 7, F.lit(None).cast("int"))
        .otherwise((300 + (key * 37) % 601).cast("int")).alias("credit_score"),
        mixed_date_text(
            F.date_add(F.lit("2015-01-01").cast("date"), ((key * 13) % 4000).cast("int"))
            .cast("string"), key).alias("customer_since"),
    )
    # 0.5%-style exact re-sends, and a few same-id rows with another payload
    resent = base.where(F.col("customer_id") % 199 == 0)
    moved = (base.where(F.col("customer_id") % 211 == 5)
             .withColumn("city", F.lit(" relocated "))
             .withColumn("customer_income", F.col("customer_income") + 1000))
    # the same customer spelled in other ways: equal once standardised
    spelled = (base.where(F.col("customer_id") % 97 == 11)
               .withColumn("email", F.upper(F.trim("email"))).withColumn("city", F.trim(F.upper("city"))))
    return base.unionByName(resent).unionByName(moved).unionByName(spelled)


def bridge_branches(nation: DataFrame, region: DataFrame) -> DataFrame:
    return (nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
            .select(F.col("n_nationkey").cast("bigint").alias("branch_id"),
                    F.col("n_name").alias("branch_name"),
                    F.col("r_name").alias("city"),
                    F.col("r_name").alias("country")))


def bridge_accounts(orders: DataFrame, customer: DataFrame) -> DataFrame:
    key = F.col("o_orderkey")
    # days, not timestamps, go through the join
    dated = orders.withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    base = (dated.join(customer.select("c_custkey", "c_nationkey"),
                       F.col("o_custkey") == F.col("c_custkey"), "left")
            .select(key.alias("account_id"),
                    F.col("o_custkey").alias("customer_id"),
                    F.when(key % 307 == 5, F.lit(None).cast("string"))
                    .otherwise(_mapped(F.col("o_orderpriority"), ACCOUNT_TYPE_BY_PRIORITY))
                    .alias("account_type"),
                    F.col("c_nationkey").cast("bigint").alias("branch_id"),
                    mixed_date_text(shifted_iso(F.col("o_orderdate")), key)
                    .alias("account_opened_date"),
                    _mapped(F.col("o_orderstatus"), ACCOUNT_STATUS_BY_ORDER_STATUS)
                    .alias("account_status")))
    return base.unionByName(_other_shape(base, "account_opened_date", "account_id", 131))


def bridge_transactions(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    pk, ok_, sk = F.col("l_partkey"), F.col("l_orderkey"), F.col("l_suppkey")
    iso = shifted_iso(F.col("l_shipdate"))
    flags = F.concat(F.col("l_returnflag"), F.col("l_linestatus"))
    # the join may shuffle all lines: a day and one status go through it, not a timestamp and two flags
    lines = lineitem.withColumn("l_shipdate", F.col("l_shipdate").cast("date")).withColumn(
        "payment_status", F.when(flags == "RF", "Failed").when(flags == "NF", "Pending")
        .when(flags == "AF", "Reversed").otherwise("Success"))
    base = (lines.join(part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"), "left")
            .select(
                (ok_ * 10 + F.col("l_linenumber")).alias("transaction_id"),
                F.when(pk % 211 == 0, F.lit(None).cast("bigint"))
                .when(pk % 223 == 1, -ok_ - 1)
                .otherwise(ok_).alias("account_id"),
                F.when(pk % 50 == 1, "not_a_date")
                .when(pk % 50 == 2, "2025-02-30")
                .when(pk % 50 == 3, "")
                .otherwise(mixed_date_text(iso, pk)).alias("transaction_date"),
                F.when(pk % 97 == 0, -F.col("l_extendedprice"))
                .when(pk % 89 == 0, F.lit(None).cast("double"))
                .when(pk % 83 == 5, F.lit(float("nan")))
                .when(pk % 83 == 6, F.lit(float("inf")))
                .when(pk % 83 == 7, F.lit(4e-7))
                # very large amounts, in one type and year each: other groups stay readable
                .when((pk % 83 == 8) & (F.col("p_type") == "PROMO") & iso.startswith("2021"), F.lit(1e300))
                .when((pk % 83 == 9) & (F.col("p_type") == "SMALL") & iso.startswith("2022"), F.lit(1e22))
                .otherwise(F.col("l_extendedprice")).alias("transaction_amount"),
                F.when(sk == 13, F.lit(None).cast("string"))
                .otherwise(_mapped(F.col("p_type"), TXN_TYPE_BY_PART_TYPE))
                .alias("transaction_type"),
                "payment_status",
                _pick(sk % 5, CHANNEL_BY_SUPPKEY_MOD5).alias("channel"),
                ok_.alias("_order"),
            ))
    resent = base.where(F.col("_order") % 151 == 0)
    return base.unionByName(resent).drop("_order")


def bridge_loans(orders: DataFrame) -> DataFrame:
    key = F.col("o_orderkey")
    status_bucket = key % 500
    status = (F.when(status_bucket < 275, "Active").when(status_bucket < 400, "Closed")
              .when(status_bucket < 440, "Defaulted").otherwise("Overdue"))
    base = (orders
            .select(key.alias("loan_id"),
                    F.col("o_custkey").alias("customer_id"),
                    _mapped(F.col("o_orderpriority"), LOAN_TYPE_BY_PRIORITY).alias("loan_type"),
                    F.when(key % 997 == 0, F.lit(None).cast("double"))
                    .otherwise(F.col("o_totalprice")).alias("loan_amount"),
                    (F.lit(6.5) + (key % 1001) / 100.0).alias("interest_rate"),
                    (12 * (1 + key % 20)).cast("int").alias("tenure_months"),
                    mixed_date_text(shifted_iso(F.col("o_orderdate")), key)
                    .alias("loan_start_date"),
                    status.alias("loan_status"),
                    F.when(status == "Closed", "Success")
                    .otherwise(_pick(key % 4, EMI_STATUS_BY_MOD4)).alias("emi_payment_status")))
    # the same loan sent again with its start date in another shape
    return base.unionByName(_other_shape(base, "loan_start_date", "loan_id", 173))


def bridge_raw(spark: SparkSession, sf_dir: str) -> RawTables:
    t = {name: read_table(spark, sf_dir, name) for name in TEST_TABLES}
    return RawTables(
        customers=bridge_customers(t["customer"]),
        branches=bridge_branches(t["nation"], t["region"]),
        accounts=bridge_accounts(t["orders"], t["customer"]),
        transactions=bridge_transactions(t["lineitem"], t["part"]),
        loans=bridge_loans(t["orders"]),
    )
