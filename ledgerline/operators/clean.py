"""Entity cleaners: standardise, de-duplicate, validate and split.

Every cleaner returns ``(valid, rejected)`` and performs no action itself.
Two rules hold everywhere:

* The valid/reject split is on ``ok(p)`` = ``coalesce(p, false)``, so a row
  whose predicate is NULL is rejected instead of vanishing (T1). Conservation:
  ``rows_in = exact_duplicates + valid + rejected``.
* "One row per key" is a total order (T5): the caller's ranking, then every
  other column ascending with NULLs last, so reruns and repartitions pick the
  same row. Rows that lose the ranking go to ``rejected`` with a reason.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline import schemas as S
from ledgerline.functions import exprs as X
from ledgerline.operators.median import exact_medians
from ledgerline.sources.sinks import staged

REASON = "reject_reason"
WON = "_won"


@dataclass(frozen=True)
class Split:
    valid: DataFrame
    rejected: DataFrame
    # For a staged write: rows that passed the checks before the one-per-key
    # ranking, the rows that failed them, and the reason given to ranking losers.
    candidates: DataFrame | None = None
    invalid: DataFrame | None = None
    key: str | None = None
    loser_reason: str | None = None
    # where the candidates still hold exact re-sends: those of given keys without them
    distinct: Callable[[DataFrame], DataFrame] | None = None
    ranking: Sequence[tuple[str, str]] = ()

    def repeated(self) -> DataFrame:
        """The keys that more than one candidate has (candidates have a key)."""
        return repeated_keys(self.candidates, self.key)

    def valid_given(self, repeated: DataFrame) -> DataFrame:
        """``valid`` where the repeated keys are *written*: rows of other keys have no rival. As far
        as a hash class tells them apart they pass as they are, and only the rest is shuffled and ranked."""
        rivals = _of_classes(self.candidates, repeated, self.key)
        return self.alone(repeated).unionByName(_winners(rivals, self.key, self.ranking))

    def alone(self, repeated: DataFrame) -> DataFrame:
        return _of_classes(self.candidates, repeated, self.key, how="left_anti")

    def rivals(self, repeated: DataFrame) -> DataFrame:
        """The candidates that aren't ``alone``, one of each equal ones, with true in ``_won`` for the
        best of its key: winners and losers from one shuffle, where exact re-sends don't count."""
        rows = _of_classes(self.candidates, repeated, self.key)
        w = Window.partitionBy(self.key).orderBy(*total_order(rows, self.key, self.ranking))
        # the order is total, so only equal rows share a rank
        return (rows.withColumn("_rn", F.row_number().over(w)).withColumn("_rank", F.rank().over(w))
                .where("_rn = _rank").withColumn(WON, F.col("_rn") == 1).drop("_rn", "_rank"))

    def valid_of(self, repeated: DataFrame, rivals: DataFrame) -> DataFrame:
        """``valid`` where the repeated keys and the rivals are written."""
        return self.alone(repeated).unionByName(rivals.where(F.col(WON)).drop(WON))

    def rejects_of(self, rivals: DataFrame) -> DataFrame:
        """``rejected`` where the rivals are written."""
        lost = rivals.where(~F.col(WON)).drop(WON).withColumn(REASON, F.lit(self.loser_reason))
        return self.invalid.unionByName(lost, allowMissingColumns=True)

    def rejects_given(self, written_valid: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
        """Rejected rows computed against the *written* winners, so the ranking
        window is not evaluated a second time."""
        lost = losers(self.candidates, written_valid, self.key, self.loser_reason, self.distinct, repeated)
        return self.invalid.unionByName(lost, allowMissingColumns=True)


def first_failure(checks: Sequence[tuple[Column, str]]) -> Column:
    """Reason of the first failing check (a NULL check counts as failing)."""
    expr = None
    for predicate, reason in checks:
        failing = ~X.ok(predicate)
        expr = F.when(failing, reason) if expr is None else expr.when(failing, reason)
    return expr


def split_on(df: DataFrame, checks: Sequence[tuple[Column, str]]) -> Split:
    """valid = all checks true; rejected = the rest, tagged with the first failure."""
    tagged = df.withColumn(REASON, first_failure(checks))
    return Split(tagged.where(F.col(REASON).isNull()).drop(REASON),
                 tagged.where(F.col(REASON).isNotNull()))


def total_order(df: DataFrame, key: str, ranking: Sequence[tuple[str, str]] = ()) -> list[Column]:
    """``ranking`` = [(column, "asc"|"desc"), ...]; then all other columns asc, NULLs last."""
    order = [F.col(c).desc_nulls_last() if d == "desc" else F.col(c).asc_nulls_last()
             for c, d in ranking]
    ranked = {c for c, _ in ranking}
    return order + [F.col(c).asc_nulls_last() for c in df.columns
                    if c != key and c not in ranked]


def keep_best(df: DataFrame, key: str, ranking: Sequence[tuple[str, str]],
              reason: str, distinct: Callable[[DataFrame], DataFrame] | None = None) -> Split:
    """One row per ``key`` (W1, U4); the others are rejected with ``reason``.
    ``distinct``: as in ``losers``.

    The winner is ``row_number() == 1``: the planner adds a partial
    WindowGroupLimit before the shuffle, so even a key holding a third of all
    rows sends at most one row per map task across the network. Rows that are
    equal (raw rows can become equal when they are standardised) are rejected
    too, all copies but the winner.
    """
    winners = _winners(df, key, ranking)
    return Split(winners, losers(df, winners, key, reason, distinct))


def _winners(df: DataFrame, key: str, ranking: Sequence[tuple[str, str]]) -> DataFrame:
    w = Window.partitionBy(key).orderBy(*total_order(df, key, ranking))
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys of more than one row, counted map-side. NULL keys match nothing and are left out."""
    return (df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
            .where("_n > 1").select(key))


def losers(df: DataFrame, kept: DataFrame, key: str, reason: str,
           distinct: Callable[[DataFrame], DataFrame] | None = None,
           repeated: DataFrame | None = None) -> DataFrame:
    """Every row of ``df`` but one copy of each row in ``kept`` (one row a key), tagged.

    Only keys that occur more than once can have losers. They are found by a count
    that is combined map-side. Rows and winners of other keys leave before they are shuffled,
    as far as a hash class tells them apart, and else in a join on the key alone. What is left
    is compared by a fingerprint of the whole row (128 bits): copies are counted, and the row
    with its key's winning fingerprint counts one less. Of a winner only key and fingerprint
    are shuffled, and all joins and groups go by the key, so a row is shuffled once.

    ``distinct``: gives the rows of the keys it gets, where ``df`` holds exact re-sends too.
    So only rows of repeated keys are compared with each other, not the whole table.
    ``repeated``: ``repeated_keys(df, key)`` where it is already written.
    """
    columns = df.columns
    if repeated is None:
        repeated = repeated_keys(df, key)       # all uses of this count are one exchange
    counted = ((distinct(repeated).select(columns) if distinct else _of_keys(df, repeated, key))
               .groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
               .withColumns(_fingerprint(columns)))
    won = (_of_classes(kept.select(columns), repeated, key)
           .withColumns(_fingerprint(columns)).select(key, F.col("_f1").alias("_w1"), F.col("_f2").alias("_w2")))
    same = (F.col("_f1") == F.col("_w1")) & (F.col("_f2") == F.col("_w2"))
    left = F.col("_copies") - F.when(same, 1).otherwise(0)
    return (counted.join(won, key, "left").withColumn("_left", left).where("_left > 0")
            .select(*columns, F.explode(F.sequence(F.lit(1).cast("long"), "_left")).alias("_copy"))
            .drop("_copy").withColumn(REASON, F.lit(reason)))


KEY_WORDS = 1 << 20


def _of_classes(df: DataFrame, keys: DataFrame, key: str, how: str = "left_semi") -> DataFrame:
    """Rows whose key's hash is in a class with one of ``keys`` (``left_anti``: the others). There are
    64 * ``KEY_WORDS`` classes, a bit each, so what is broadcast has at most ``KEY_WORDS`` rows."""
    h = F.xxhash64(key)
    # masks, not pmod: they can't be NULL, so no filter on them keeps ``keys`` from being reused
    word = F.shiftright(h, 6).bitwiseAND(F.lit(KEY_WORDS - 1)).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(F.lit(63)).cast("int"))
    words = keys.select(word.alias("_word"), bit.alias("_bit")).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    # a semi join: through an inner one, the semi join on the key would be pushed below it
    return df.join(F.broadcast(words), (word == F.col("_word")) & (F.col("_bits").bitwiseAND(bit) != 0), how)


def _of_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is among ``keys``. Their classes let most other rows go before the shuffle."""
    return _of_classes(df, keys, key).join(keys, key, "left_semi").select(df.columns)


def distinct_rows(df: DataFrame) -> DataFrame:
    """``df.dropDuplicates()`` where few rows come again: a row whose hash no other row has is
    unique, so only hashes and the rows of repeated ones are shuffled."""
    hashed = df.withColumn("_row", F.xxhash64(*df.columns))
    repeated = repeated_keys(hashed, "_row")
    rivals = _of_classes(hashed, repeated, "_row").dropDuplicates()
    return _of_classes(hashed, repeated, "_row", how="left_anti").unionByName(rivals).drop("_row")


def marked_unknown(df: DataFrame, known: DataFrame, key: str, name: str) -> DataFrame:
    """Every row of ``df``, with true in column ``name`` where its key isn't among ``known`` (a NULL
    key never is). The distinct keys meet the known ones, and of the rows only those in a hash class
    with an unknown key are shuffled."""
    ids = df.select(key).where(F.col(key).isNotNull()).distinct()
    unknown = staged(ids.join(known.select(key), key, "left_anti"), f"unknown-{key}")
    near = (_of_classes(df, unknown, key).join(unknown.withColumn(name, F.lit(True)), key, "left")
            .withColumn(name, F.col(key).isNull() | F.col(name).isNotNull()))
    far = _of_classes(df, unknown, key, how="left_anti").withColumn(name, F.col(key).isNull())
    return far.unionByName(near)


def _one_per_key(raw: DataFrame, check: Callable[[DataFrame], Split], key: str, reason: str) -> Split:
    """The checked rows of ``raw`` without exact re-sends, one per ``key``. A re-send can't win
    over its like, so the ranking takes the rows as they are; re-sends are looked for
    among the rejects only."""
    checked = check(raw)
    invalid = check(raw.dropDuplicates()).rejected      # the check goes below: few rows are shuffled

    def distinct(keys: DataFrame) -> DataFrame:
        return check(_of_keys(raw, keys, key).dropDuplicates()).valid

    best = keep_best(checked.valid, key, [], reason, distinct)
    return Split(best.valid, _union_rejects(invalid, best.rejected), checked.valid, invalid, key,
                 reason, distinct)


def _fingerprint(columns: list[str]) -> dict[str, Column]:
    """Two hashes of a row. Which columns are NULL is part of them: the hash skips NULLs."""
    nulls = F.concat(*[F.when(F.col(c).isNull(), "0").otherwise("1") for c in columns])
    return {"_f1": F.xxhash64(nulls, *columns), "_f2": F.xxhash64(F.lit(1), *columns, nulls)}


def _union_rejects(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


# ---------------------------------------------------------------------------
# customers (F1)
# ---------------------------------------------------------------------------
def standardise_customers(df: DataFrame) -> DataFrame:
    return (df.withColumn("customer_income", X.to_double("customer_income"))
            .withColumn("credit_score", X.to_int("credit_score"))
            .withColumn("dob", X.parse_iso_date("dob"))
            .withColumn("customer_since", X.parse_date("customer_since"))
            .withColumn("email", F.lower(F.trim(F.col("email").cast("string"))))
            .withColumn("city", F.initcap(F.trim(F.col("city").cast("string")))))


def customer_medians(std: DataFrame) -> tuple[float | None, int]:
    """Population medians used for imputation (exact, P8).

    Income with no known value stays NULL; credit score falls back to 650.
    The credit median is truncated to an integer.
    """
    med = exact_medians(std, ["customer_income", "credit_score"])
    income, credit = med["customer_income"], med["credit_score"]
    return income, (int(credit) if credit is not None else S.DEFAULT_CREDIT_SCORE)


def clean_customers(raw: DataFrame, medians: tuple[float | None, int] | None = None,
                    standardised: DataFrame | None = None) -> Split:
    """Exact de-dup *before* standardising, impute, reject NULL ids, one row per id.
    ``standardised``: the first two steps' result where it is already written."""
    std = standardised if standardised is not None else standardise_customers(raw.dropDuplicates())
    income_median, credit_median = medians if medians is not None else customer_medians(std)
    imputed = (std.withColumn("customer_income",
                              F.coalesce("customer_income",
                                         F.lit(income_median).cast("double")))
               .withColumn("credit_score",
                           F.coalesce("credit_score", F.lit(credit_median).cast("int"))))
    checked = split_on(imputed, [(F.col("customer_id").isNotNull(), "missing_customer_id")])
    best = keep_best(checked.valid, "customer_id", [], "duplicate_customer_id")
    return Split(best.valid, _union_rejects(checked.rejected, best.rejected),
                 checked.valid, checked.rejected, "customer_id", "duplicate_customer_id")


# ---------------------------------------------------------------------------
# branches (F2)
# ---------------------------------------------------------------------------
def clean_branches(raw: DataFrame) -> DataFrame:
    """One row per branch_id; a NULL id is kept as one row, like the source."""
    return keep_best(raw.dropDuplicates(), "branch_id", [], "duplicate_branch_id").valid


# ---------------------------------------------------------------------------
# accounts (F3)
# ---------------------------------------------------------------------------
def clean_accounts(raw: DataFrame, account_types: Sequence[str] = S.ACCOUNT_TYPES) -> Split:
    def check(rows: DataFrame) -> Split:
        return split_on(rows.withColumn("account_opened_date", X.parse_date("account_opened_date")), [
            (F.col("account_id").isNotNull(), "missing_account_id"),
            (F.col("customer_id").isNotNull(), "missing_customer_id"),
            (F.col("account_type").isin(*account_types), "invalid_account_type"),
        ])
    return _one_per_key(raw, check, "account_id", "duplicate_account_id")


# ---------------------------------------------------------------------------
# transactions
# ---------------------------------------------------------------------------
def standardise_transactions(df: DataFrame) -> DataFrame:
    return (df.withColumn("transaction_amount", X.to_double("transaction_amount"))
            .withColumn("transaction_date", X.parse_date("transaction_date"))
            .withColumn("transaction_type", F.trim(F.col("transaction_type").cast("string")))
            .withColumn("channel", F.trim(F.col("channel").cast("string"))))


def transaction_checks(txn_types: Sequence[str] = S.TXN_TYPES) -> list[tuple[Column, str]]:
    amount = F.col("transaction_amount")
    return [
        # completeness
        (F.col("transaction_id").isNotNull(), "missing_transaction_id"),
        (F.col("account_id").isNotNull(), "missing_account_id"),
        (amount.isNotNull(), "missing_amount"),
        # validity (F7)
        (amount > 0, "non_positive_amount"),
        (F.col("transaction_date").isNotNull(), "invalid_date"),
        (F.col("transaction_type").isin(*txn_types), "invalid_transaction_type"),
    ]


def tag_transactions(raw: DataFrame, txn_types: Sequence[str] = S.TXN_TYPES) -> DataFrame:
    """Standardised rows, exact re-sends and all, each with the reason of its
    first failed check (NULL when it passes them all). Nothing is shuffled."""
    return standardise_transactions(raw).withColumn(REASON, first_failure(transaction_checks(txn_types)))


def split_tagged(tagged: DataFrame, key: str, ranking: Sequence[tuple[str, str]],
                 loser_reason: str) -> Split:
    """The tagged rows without exact re-sends, one valid row per ``key`` (as in ``_one_per_key``)."""
    candidates = tagged.where(F.col(REASON).isNull()).drop(REASON)
    invalid = distinct_rows(tagged.where(F.col(REASON).isNotNull()))

    def distinct(keys: DataFrame) -> DataFrame:
        return _of_keys(candidates, keys, key).dropDuplicates()

    best = keep_best(candidates, key, ranking, loser_reason, distinct)
    return Split(best.valid, _union_rejects(invalid, best.rejected), candidates, invalid,
                 key, loser_reason, distinct, ranking)


def clean_transactions(raw: DataFrame, txn_types: Sequence[str] = S.TXN_TYPES) -> Split:
    """Standardise, drop exact re-sends, validate, keep the highest amount per id.

    The highest amount wins (the reference's code, not its docstring: T4);
    ties fall to the remaining columns. Losing rows of an id are rejected as
    ``duplicate_id_conflict``. The ranking happens before orphan removal
    (T11), as in the reference.
    """
    return split_tagged(tag_transactions(raw, txn_types), "transaction_id",
                        [("transaction_amount", "desc")], "duplicate_id_conflict")


def split_orphans(txns: DataFrame, accounts: DataFrame) -> Split:
    """Transactions whose account is not in the clean account dimension.

    Semi/anti joins need no distinct on the right side and never fan out.
    """
    ids = accounts.select("account_id")
    return Split(txns.join(ids, "account_id", "left_semi"),
                 txns.join(ids, "account_id", "left_anti")
                 .withColumn(REASON, F.lit("orphan_account")))


def orphans(txns: DataFrame, accounts: DataFrame) -> DataFrame:
    """``split_orphans(...).rejected`` for written transactions, which are read more than once
    here but not shuffled whole: their distinct account ids meet the dimension, and only rows
    of the few ids that aren't there are looked for (a NULL id is in no dimension)."""
    ids = txns.select("account_id").where(F.col("account_id").isNotNull()).distinct()
    unknown = ids.join(accounts.select("account_id"), "account_id", "left_anti")
    return (_of_keys(txns, unknown, "account_id").unionByName(txns.where(F.col("account_id").isNull()))
            .withColumn(REASON, F.lit("orphan_account")))


# ---------------------------------------------------------------------------
# loans (F5)
# ---------------------------------------------------------------------------
def clean_loans(raw: DataFrame) -> Split:
    def check(rows: DataFrame) -> Split:
        std = (rows.withColumn("loan_amount", X.to_double("loan_amount"))
               .withColumn("interest_rate", X.to_double("interest_rate"))
               .withColumn("tenure_months", X.to_int("tenure_months"))
               .withColumn("loan_start_date", X.parse_date("loan_start_date")))
        return split_on(std, [
            (F.col("loan_id").isNotNull(), "missing_loan_id"),
            (F.col("customer_id").isNotNull(), "missing_customer_id"),
            (F.col("loan_amount").isNotNull(), "missing_amount"),
            (F.col("loan_amount") > 0, "non_positive_amount"),
        ])
    return _one_per_key(raw, check, "loan_id", "duplicate_loan_id")
