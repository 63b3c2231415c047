"""Enriched transaction fact (A7: J1-J3 + P9-P13).

The reference joins the fact to accounts, then customers, then branches —
three passes over the biggest table. Every dimension here hangs off the
account, so the dimensions are joined to each other first (account-grain,
far smaller than the fact) and the fact is joined **once** on account_id.
For left joins this is the same result: the customer and branch lookups only
read account columns. All dimensions are key-unique after cleaning, so no
join fans out.

Strategy is left to the planner: a dimension below
``spark.sql.autoBroadcastJoinThreshold`` is broadcast (size checked by Spark
at plan time and again by AQE at run time); otherwise both sides shuffle on
account_id, and AQE splits a skewed account partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline import schemas as S
from ledgerline.functions import exprs as X

ENRICHED_COLUMNS = (
    "branch_id", "customer_id", "account_id", "transaction_id", "transaction_date",
    "transaction_amount", "transaction_type", "payment_status", "channel", "account_type",
    "account_status", "customer_income", "credit_score", "city", "customer_since",
    "branch_name", "branch_city", "txn_year", "txn_month", "txn_year_month",
    "is_high_value", "is_failed", "income_bracket",
)


def account_dimension(accounts: DataFrame, customers: DataFrame,
                      branches: DataFrame | None) -> DataFrame:
    """Account grain: account + its customer + its branch, where given (left joins)."""
    acc = accounts.select("account_id", "customer_id", "account_type", "branch_id",
                          "account_status")
    cust = customers.select("customer_id", "customer_income", "credit_score", "city",
                            "customer_since")
    dims = acc.join(cust, "customer_id", "left")
    return dims if branches is None else join_branches(dims, branches)


def join_branches(df: DataFrame, branches: DataFrame) -> DataFrame:
    return df.join(branches.select("branch_id", "branch_name", F.col("city").alias("branch_city")), "branch_id", "left")


def add_calculated_columns(df: DataFrame) -> DataFrame:
    d = F.col("transaction_date")
    return (df.withColumn("txn_year", F.year(d))
            .withColumn("txn_month", F.month(d))
            .withColumn("txn_year_month", F.date_format(d, "yyyy-MM"))
            .withColumn("is_high_value", X.flag(F.col("transaction_amount") > S.HIGH_VALUE_AMOUNT))
            .withColumn("is_failed", X.flag(F.col("payment_status") == "Failed"))
            .withColumn("income_bracket", X.income_bracket("customer_income")))


def join_dimensions(txns: DataFrame, accounts: DataFrame, customers: DataFrame,
                    branches: DataFrame | None, how: str = "left") -> DataFrame:
    """The enriched fact without its calculated columns and, where no branches are given, theirs.

    ``how="inner"`` also drops orphan transactions: the account dimension has
    exactly one row per clean account, so an inner join equals the orphan
    semi-join followed by the left join, with one join instead of two."""
    dims = account_dimension(accounts, customers, branches)
    fact = txns.select("account_id", "transaction_id", "transaction_date",
                       "transaction_amount", "transaction_type", "payment_status", "channel")
    return fact.join(dims, "account_id", how)


def build_enriched_transactions(txns: DataFrame, accounts: DataFrame, customers: DataFrame,
                                branches: DataFrame, how: str = "left") -> DataFrame:
    return add_calculated_columns(join_dimensions(txns, accounts, customers, branches, how)
                                  ).select(*ENRICHED_COLUMNS)


def conform(df: DataFrame, columns, types: dict[str, str] | None = None) -> DataFrame:
    """Project to a warehouse column list; absent columns become typed NULLs."""
    types = types or {}
    out = []
    for c in columns:
        if c in df.columns:
            e = F.col(c)
            if c in types:
                e = e.cast(types[c])
        else:
            e = F.lit(None).cast(types.get(c, "string"))
        out.append(e.alias(c))
    return df.select(*out)


def fact_transaction(enriched: DataFrame) -> DataFrame:
    return conform(enriched, S.FACT_TXN_COLUMNS, S.WAREHOUSE_TYPES["fact_transaction"])
