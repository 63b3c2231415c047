"""Customer risk mart (A6 = A1 + A2 + J5 + P14-P17).

Transactions are aggregated to the **account** first (partial aggregation on
the map side, no join needed because account_id is on the clean fact), then
rolled up to the customer through the account->customer map. Only one row per
account crosses the join, instead of one per transaction. Sums are exact,
so the two-level roll-up equals a one-level sum. Loans are aggregated before
their join too, so neither join can fan out (J5).

Every customer is kept (left joins from the customer dimension); the
NULL-customer group is filtered before grouping, so it cannot become a hot
group, and it would drop out of the left join anyway.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline import schemas as S
from ledgerline.functions import exact as E
from ledgerline.functions import exprs as X

ZERO_FILLED = ("total_transactions", "total_transaction_value", "avg_transaction_value",
               "failed_transactions", "high_value_transactions", "total_loans",
               "total_loan_amount", "defaulted_loans", "overdue_loans")

COUNTED = ["n", "n_amount", "failed", "high"]


def transaction_totals_by_customer(clean_txns: DataFrame, accounts: DataFrame) -> DataFrame:
    """A1: count, exact value, avg, failed and high-value counts per customer."""
    per_account = E.exact_totals(clean_txns, ["account_id"], {"value": "transaction_amount"}, {
        "n": E.known("transaction_id"), "n_amount": E.known("transaction_amount"),
        "failed": X.flag(F.col("payment_status") == "Failed"),
        "high": X.flag(F.col("transaction_amount") > S.HIGH_VALUE_AMOUNT)})
    owners = accounts.select("account_id", "customer_id").where(F.col("customer_id").isNotNull())
    return _customer_totals(per_account.join(owners, "account_id"))


def _customer_totals(grain: DataFrame) -> DataFrame:
    """Totals of a finer grain rolled up to the customer."""
    per_customer = E.roll_up(grain, ["customer_id"], "value", COUNTED).withColumn("value", E.value("value"))
    return per_customer.select(
        "customer_id", F.col("n").alias("total_transactions"),
        F.col("value").alias("total_transaction_value"),
        (F.col("value") / F.col("n_amount")).alias("avg_transaction_value"),
        F.col("failed").alias("failed_transactions"), F.col("high").alias("high_value_transactions"))


def loan_totals_by_customer(loans: DataFrame) -> DataFrame:
    """A2: count, exact amount, defaulted and overdue counts per customer."""
    status = F.col("loan_status")
    is_ = lambda s: F.when(status == s, 1).otherwise(0)
    return E.totals_by(loans.where(F.col("customer_id").isNotNull()), ["customer_id"],
                       {"total_loan_amount": "loan_amount"},
                       {"total_loans": E.known("loan_id"), "defaulted_loans": is_("Defaulted"),
                        "overdue_loans": is_("Overdue")})


def build_customer_risk_metrics(clean_txns: DataFrame, accounts: DataFrame, loans: DataFrame,
                                customers: DataFrame) -> DataFrame:
    return customer_risk_from_totals(transaction_totals_by_customer(clean_txns, accounts),
                                     loans, customers)


def transaction_totals_from_grain(grain: DataFrame) -> DataFrame:
    """A1 from the (branch, customer) grain of the fact (``aggregates.customer_grain``):
    counts and exact sums add up exactly across a customer's branches."""
    return _customer_totals(grain.where(F.col("customer_id").isNotNull()))


def customer_risk_from_totals(txn_totals: DataFrame, loans: DataFrame,
                              customers: DataFrame) -> DataFrame:
    risk = (customers.select("customer_id", "customer_income", "credit_score")
            .join(txn_totals, "customer_id", "left")
            .join(loan_totals_by_customer(loans), "customer_id", "left")
            .fillna(0, subset=list(ZERO_FILLED)))
    risk = (risk.withColumn("failed_txn_rate",
                            X.failed_rate("failed_transactions", "total_transactions"))
            .withColumn("risk_score", X.risk_score("credit_score", "failed_txn_rate",
                                                   "defaulted_loans", "overdue_loans"))
            .withColumn("risk_tier", X.risk_tier("risk_score")))
    return risk.select(*S.RISK_COLUMNS)
