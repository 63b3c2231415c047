"""Data-quality checks over the *raw* sources, scorecard and gate.

Failure counts are over raw rows. Each table is scanned by one aggregate:
transactions for D1-D7, D9, D11 and the scorecard (after one join to the
distinct account ids); accounts for D8 and D12; customers for D10. Every
aggregate is a hash aggregate with a partial phase, so no hot key reaches one
task whole.

Deviations from the reference, on purpose:

* one date parser for cleaning and checking (P21), so the check agrees with
  what the cleaner keeps;
* "valid records" = distinct transaction ids with at least one fully valid
  row. "First occurrence" has no meaning without a file order (D13).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ledgerline import schemas as S
from ledgerline.functions import exprs as X
from ledgerline.operators.clean import marked_unknown
from ledgerline.sources.sinks import staged

# Fixed check names.
CHECK_NAMES = {
    "missing_txn_id": ("Completeness", "Missing Transaction ID"),
    "missing_account_id": ("Completeness", "Missing Account ID (proxy for Customer linkage)"),
    "missing_amount": ("Completeness", "Missing Transaction Amount"),
    "missing_type": ("Completeness", "Missing Transaction Type"),
    "invalid_amount": ("Validity", "Negative/Invalid/Zero Transaction Amount"),
    "invalid_date": ("Validity", "Invalid Transaction Date"),
    "invalid_txn_type": ("Validity", "Invalid Transaction Type"),
    "invalid_account_type": ("Validity", "Invalid Account Type"),
    "duplicate_txn_ids": ("Uniqueness", "Duplicate Transaction IDs"),
    "duplicate_customer_ids": ("Uniqueness", "Duplicate Customer IDs"),
    "orphan_txn_account": ("Consistency", "Transaction Account ID not found in Account master"),
    "orphan_account_customer": ("Consistency", "Account Customer ID not found in Customer master"),
}


class QualityGateError(RuntimeError):
    """Raised before the warehouse load when the score is under the gate."""


def pass_rate(total: Column, failed: Column) -> Column:
    return F.when(total == 0, F.lit(100.0)).otherwise(
        X.round2((total - failed).cast("double") / total * 100))


def _master(df: DataFrame, key: str) -> DataFrame:
    """The distinct non-NULL keys with ``_in_master``, written and read back: an
    aggregate between the shuffle and the join would keep AQE from splitting a
    hot key on the other side."""
    ids = df.select(key).where(F.col(key).isNotNull()).distinct()
    return staged(ids, f"master-{key}").withColumn("_in_master", F.lit(1))


#: Failed checks of a row, a bit each; the last two don't make a row unusable by themselves.
FLAGS = {"missing_txn_id": 1, "missing_account_id": 2, "invalid_amount": 4, "invalid_date": 8,
         "invalid_txn_type": 16, "orphan_txn_account": 32, "missing_amount": 64, "missing_type": 128}
UNUSABLE = 63


def own_flags(txn_types: Sequence[str] = S.TXN_TYPES) -> Column:
    """Bit field of the checks that a raw transaction fails by itself, whatever the other tables hold."""
    failed = {
        "missing_txn_id": F.col("transaction_id").isNull(),
        "missing_account_id": F.col("account_id").isNull(),
        "missing_amount": F.col("transaction_amount").isNull(),
        "missing_type": F.col("transaction_type").isNull(),
        "invalid_amount": ~X.ok(X.to_double("transaction_amount") > 0),
        "invalid_date": X.parse_date("transaction_date").isNull(),
        # no trim here, unlike the cleaner: the check sees the raw text
        "invalid_txn_type": ~X.ok(F.col("transaction_type").isin(*txn_types)),
    }
    return sum((F.when(f, FLAGS[name]).otherwise(0) for name, f in failed.items()), F.lit(0)).cast("short")


#: Column of a raw transaction with its ``own_flags``, taken before the row is standardised.
OWN_FLAGS = "_own_flags"


def with_own_flags(raw_txns: DataFrame, txn_types: Sequence[str] = S.TXN_TYPES) -> DataFrame:
    return raw_txns.withColumn(OWN_FLAGS, own_flags(txn_types))


def _month(date: Column) -> Column:
    """202403 for a day of March 2024."""
    return F.date_format(date, "yyyyMM").cast("int")


def _flagged(raw_txns: DataFrame, raw_accounts: DataFrame, txn_types: Sequence[str]) -> DataFrame:
    """Per raw transaction its id, month and ``mask``, the bit field of its failed checks.

    All that a row says of itself is in its mask before it meets the master ids, so
    only ids, month and mask are shuffled. A NULL account id never matches, so it counts as
    "not in master" (J11); the master ids are distinct, so nothing fans out.
    """
    rows = raw_txns.select("transaction_id", "account_id", _month(X.parse_date("transaction_date")).alias("month"),
                           own_flags(txn_types).alias("mask"))
    orphan = F.when(F.col("_in_master").isNull(), FLAGS["orphan_txn_account"]).otherwise(0)
    return rows.join(_master(raw_accounts, "account_id"), "account_id", "left").select(
        "transaction_id", "month", (F.col("mask") + orphan).cast("short").alias("mask"))


def _has(name_or_bits: str | int) -> Column:
    bits = FLAGS[name_or_bits] if isinstance(name_or_bits, str) else name_or_bits
    return F.col("mask").cast("int").bitwiseAND(F.lit(bits)) != 0


def flagged_transactions(raw_txns: DataFrame, raw_accounts: DataFrame, txn_types: Sequence[str] = S.TXN_TYPES,
                         tagged: DataFrame | None = None) -> DataFrame:
    """Every raw transaction's id, month and failed checks. Written once, it serves the profile and the monthly log.
    ``tagged``: the standardised rows with ``OWN_FLAGS``, all of them, where they are already written. They
    can be read more than once, so their rows aren't shuffled to meet the master ids."""
    if tagged is None:
        return _flagged(raw_txns, raw_accounts, txn_types)
    rows = tagged.select("transaction_id", "account_id", _month(F.col("transaction_date")).alias("month"),
                         F.col(OWN_FLAGS).alias("mask"))
    marked = marked_unknown(rows, _master(raw_accounts, "account_id"), "account_id", "_orphan")
    orphan = F.when(F.col("_orphan"), FLAGS["orphan_txn_account"]).otherwise(0)
    return marked.select("transaction_id", "month", (F.col("mask") + orphan).cast("short").alias("mask"))


def transaction_profile(raw_txns: DataFrame, raw_accounts: DataFrame,
                        txn_types: Sequence[str] = S.TXN_TYPES, flagged: DataFrame | None = None) -> DataFrame:
    """One row: raw total, D1-D7, D9 and D11 failure counts, valid distinct ids.

    Rows meet the master ids in one join (its hot accounts can be split) and are
    flagged once (the date parse and amount cast feed several checks); the id and the
    bit field of each row are written. Failures are counted by bit field (256 groups at
    most), so only an id and two counts travel to where ids are grouped (combined map-side).
    Duplicate ids (all members, NULL ids as one group) and "ids with at least
    one fully valid row" both fall out of the per-id counts.
    ``flagged``: ``flagged_transactions`` where it is already written.
    """
    if flagged is None:
        flagged = staged(_flagged(raw_txns, raw_accounts, txn_types).drop("month"), "flagged")
    by_mask = flagged.groupBy("mask").agg(F.count(F.lit(1)).alias("n"))
    count = lambda which: F.coalesce(F.sum(F.when(which, F.col("n"))), F.lit(0)).cast("long")
    totals = by_mask.agg(count(F.lit(True)).alias("total"), *[count(_has(name)).alias(name) for name in FLAGS])
    per_id = flagged.groupBy("transaction_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~_has(UNUSABLE)).alias("n_valid"))
    ids = per_id.agg(
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).cast("long").alias("duplicate_txn_ids"),
        F.count_if(F.col("n_valid") > 0).alias("valid_ids"))
    return totals.join(F.broadcast(ids))                        # one row each


def account_profile(raw_accounts: DataFrame, raw_customers: DataFrame,
                    account_types: Sequence[str] = S.ACCOUNT_TYPES) -> DataFrame:
    return raw_accounts.join(_master(raw_customers, "customer_id"), "customer_id", "left").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(~X.ok(F.col("account_type").isin(*account_types)))
        .alias("invalid_account_type"),
        F.count_if(F.col("_in_master").isNull()).alias("orphan_account_customer"))


def _checks_from(profile: DataFrame, total_col: str, names: Sequence[str]) -> DataFrame:
    rows = [F.struct(F.lit(CHECK_NAMES[n][0]).alias("category"),
                     F.lit(CHECK_NAMES[n][1]).alias("check_name"),
                     F.col(total_col).cast("long").alias("total_records"),
                     F.col(n).cast("long").alias("failed_records"))
            for n in names]
    out = profile.select(F.explode(F.array(*rows)).alias("c")).select("c.*")
    return out.withColumn("pass_rate_pct", pass_rate(F.col("total_records"),
                                                     F.col("failed_records")))


def dq_checks(raw_txns: DataFrame, raw_accounts: DataFrame, raw_customers: DataFrame,
              txn_types: Sequence[str] = S.TXN_TYPES,
              account_types: Sequence[str] = S.ACCOUNT_TYPES,
              txn_profile: DataFrame | None = None) -> DataFrame:
    """The 12 checks: category, check_name, total_records, failed_records, pass_rate_pct."""
    txn = (txn_profile if txn_profile is not None
           else transaction_profile(raw_txns, raw_accounts, txn_types))
    acc = account_profile(raw_accounts, raw_customers, account_types)
    parts = [
        _checks_from(txn, "total", ["missing_txn_id", "missing_account_id", "missing_amount",
                                    "missing_type", "invalid_amount", "invalid_date",
                                    "invalid_txn_type", "duplicate_txn_ids",
                                    "orphan_txn_account"]),
        _checks_from(acc, "total", ["invalid_account_type", "orphan_account_customer"]),
        _checks_from(_dup_with_total(raw_customers, "customer_id", "duplicate_customer_ids"),
                     "total", ["duplicate_customer_ids"]),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _dup_with_total(df: DataFrame, key: str, name: str) -> DataFrame:
    """Rows whose key occurs more than once, all members counted, and the table's
    row count, from one aggregation (D9, D10). NULL keys form one group."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total"),
                       F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0))
                       .cast("long").alias(name))


def dq_scorecard(raw_txns: DataFrame, raw_accounts: DataFrame,
                 txn_types: Sequence[str] = S.TXN_TYPES,
                 threshold: float = S.QUALITY_GATE_THRESHOLD,
                 txn_profile: DataFrame | None = None) -> DataFrame:
    """One row: total, valid, rejected, score % (0 when empty) and the gate."""
    p = (txn_profile if txn_profile is not None
         else transaction_profile(raw_txns, raw_accounts, txn_types))
    score = F.when(F.col("total") > 0,
                   X.round2(F.col("valid_ids").cast("double") / F.col("total") * 100)
                   ).otherwise(F.lit(0.0))
    return p.select(
        F.col("total").cast("long").alias("total_records"),
        F.col("valid_ids").cast("long").alias("valid_records"),
        (F.col("total") - F.col("valid_ids")).cast("long").alias("rejected_records"),
        score.alias("data_quality_score_pct"),
        F.lit(float(threshold)).alias("quality_gate_threshold_pct"),
        (score >= F.lit(float(threshold))).alias("passed_quality_gate"),
    )


def dq_log_rows(scorecard: DataFrame, run_at: str, run_id: int) -> DataFrame:
    """Scorecard -> ``data_quality_log`` rows."""
    return scorecard.select(
        F.lit(run_id).cast("long").alias("run_id"),
        F.lit(run_at).alias("run_at"),
        "total_records", "valid_records", "rejected_records", "data_quality_score_pct",
        F.col("passed_quality_gate").cast("int").alias("passed_quality_gate"))


def monthly_log(raw_txns: DataFrame, raw_accounts: DataFrame,
                txn_types: Sequence[str] = S.TXN_TYPES,
                threshold: float = S.QUALITY_GATE_THRESHOLD, flagged: DataFrame | None = None) -> DataFrame:
    """``data_quality_log`` rows as if a run had scored each month's transactions
    on their own: a log of many runs. Rows without a readable date belong to no
    month. Counts per id and month are combined map-side.
    ``flagged``: ``flagged_transactions`` where it is already written."""
    if flagged is None:
        flagged = _flagged(raw_txns, raw_accounts, txn_types)
    # asked of the finished mask, not of the month: a filter on the month would go below the
    # join with the masters and parse each date again, many times over
    dated = flagged.where(~_has("invalid_date"))
    per_id = (dated.groupBy("month", "transaction_id")
              .agg(F.count(F.lit(1)).alias("n"), F.max(~_has(UNUSABLE)).alias("valid")))
    by_month = per_id.groupBy("month").agg(F.sum("n").alias("total"), F.count_if("valid").alias("good"))
    score = X.round2(F.col("good").cast("double") / F.col("total") * 100)
    digits = F.lpad(F.col("month").cast("string"), 6, "0")
    return by_month.select(
        F.col("month").cast("long").alias("run_id"),
        F.concat(F.left(digits, F.lit(4)), F.lit("-"), F.right(digits, F.lit(2)), F.lit("-01T00:00:00")).alias("run_at"),
        F.col("total").alias("total_records"), F.col("good").alias("valid_records"),
        (F.col("total") - F.col("good")).alias("rejected_records"),
        score.alias("data_quality_score_pct"),
        (score >= F.lit(float(threshold))).cast("int").alias("passed_quality_gate"))


def evaluate_gate(scorecard: DataFrame, enforce: bool = True) -> Row:
    """Collect the one scorecard row; raise when the gate fails and ``enforce``."""
    row = scorecard.first()
    if enforce and not row["passed_quality_gate"]:
        raise QualityGateError(
            f"data quality score {row['data_quality_score_pct']}% is below the gate "
            f"{row['quality_gate_threshold_pct']}%")
    return row


def format_scorecard(score: Row, checks: list[Row]) -> str:
    """The scorecard for people, in Markdown, from the collected 1 + 12 rows."""
    verdict = "passed" if score["passed_quality_gate"] else "not passed"
    head = (f"# Data quality {score['data_quality_score_pct']} %\n\n"
            f"{score['valid_records']} of {score['total_records']} transactions are usable, "
            f"{score['rejected_records']} are not. The gate at "
            f"{score['quality_gate_threshold_pct']} % is {verdict}.\n")
    worst = sorted(checks, key=lambda c: (-c["failed_records"], c["check_name"]))
    table = [f"| {c['failed_records']} | {c['pass_rate_pct']} | {c['category']} | {c['check_name']} |"
             for c in worst]
    return "\n".join([head, "| failed | passed % | category | check |", "| --: | --: | :-- | :-- |", *table])
