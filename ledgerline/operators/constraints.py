"""Warehouse constraints re-aimed as checks (§2.11, J12).

The DDL's PRIMARY KEY / NOT NULL / FOREIGN KEY clauses become one row per
constraint with its violation count, instead of a storage engine enforcing
them. Semantics:

* PK: rows whose key is NULL or shared with another row;
* NOT NULL: rows where the column is NULL;
* FK: rows with a non-NULL key that is absent from the parent (SQL semantics;
  the DQ consistency checks count NULL keys as failures instead).

A table is scanned once for its PK and NOT NULL rows (counts per key, combined
map-side). Each foreign key reads its own column and nothing else: values are counted
in their own type, again combined map-side, and only the distinct ones meet the
parent's keys, in an anti-join that AQE turns into a broadcast where the parent is small.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed constraint list of the star schema: (table, kind, column, parent table, parent column)
CONSTRAINTS = (
    ("dim_date", "PK", "date_key", None, None),
    ("dim_branch", "PK", "branch_id", None, None),
    ("dim_branch", "NOT NULL", "branch_name", None, None),
    ("dim_customer", "PK", "customer_id", None, None),
    ("dim_account", "PK", "account_id", None, None),
    ("dim_account", "NOT NULL", "customer_id", None, None),
    ("dim_account", "FK", "customer_id", "dim_customer", "customer_id"),
    ("dim_account", "FK", "branch_id", "dim_branch", "branch_id"),
    ("fact_transaction", "PK", "transaction_id", None, None),
    ("fact_transaction", "NOT NULL", "account_id", None, None),
    ("fact_transaction", "NOT NULL", "transaction_date", None, None),
    ("fact_transaction", "NOT NULL", "transaction_amount", None, None),
    ("fact_transaction", "FK", "account_id", "dim_account", "account_id"),
    ("fact_transaction", "FK", "customer_id", "dim_customer", "customer_id"),
    ("fact_transaction", "FK", "branch_id", "dim_branch", "branch_id"),
    ("fact_transaction", "FK", "transaction_date", "dim_date", "date_key"),
    ("fact_loan", "PK", "loan_id", None, None),
    ("fact_loan", "NOT NULL", "customer_id", None, None),
    ("fact_loan", "FK", "customer_id", "dim_customer", "customer_id"),
    ("fact_loan", "FK", "loan_start_date", "dim_date", "date_key"),
    ("customer_risk_metrics", "PK", "customer_id", None, None),
    ("customer_risk_metrics", "FK", "customer_id", "dim_customer", "customer_id"),
    ("data_quality_log", "PK", "run_id", None, None),
    ("data_quality_log", "NOT NULL", "run_at", None, None),
)


def _own(df: DataFrame, table: str) -> DataFrame:
    """PK and NOT NULL rows of one table from one aggregate per key."""
    mine = [c for c in CONSTRAINTS if c[0] == table and c[1] != "FK"]
    key = next(c[2] for c in mine if c[1] == "PK")
    nulls = [c[2] for c in mine if c[1] == "NOT NULL"]
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"),
                                  *[F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in nulls])
    bad = F.when(F.col(key).isNull() | (F.col("_n") > 1), F.col("_n"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    sums = per_key.agg(total(bad).alias("pk"), *[total(f"_null_{c}").alias(c) for c in nulls])
    rows = [F.struct(F.lit(kind).alias("constraint_kind"), F.lit(col).alias("column_name"),
                     F.col("pk" if kind == "PK" else col).alias("violations"))
            for _, kind, col, _, _ in mine]
    return sums.select(F.lit(table).alias("table_name"), F.explode(F.array(*rows)).alias("r")).select(
        "table_name", "r.*")


def _foreign(tables: dict[str, DataFrame], table: str, column: str, parent: str, parent_column: str) -> DataFrame:
    """The FK row of one column: its non-NULL values, counted, without those that the parent has."""
    counted = (tables[table].where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_key"))
               .agg(F.count(F.lit(1)).alias("n")))
    known = tables[parent].select(F.col(parent_column).alias("_key"))
    lost = counted.join(known, "_key", "left_anti")
    return lost.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("violations")).select(
        F.lit(table).alias("table_name"), F.lit("FK").alias("constraint_kind"), F.lit(column).alias("column_name"),
        "violations")


def check_constraints(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per constraint: table_name, constraint_kind, column_name, violations."""
    names = list(dict.fromkeys(c[0] for c in CONSTRAINTS))
    parts = [_own(tables[n], n) for n in names]
    parts += [_foreign(tables, t, col, parent, parent_col)
              for t, kind, col, parent, parent_col in CONSTRAINTS if kind == "FK"]
    return reduce(DataFrame.unionByName, parts)
