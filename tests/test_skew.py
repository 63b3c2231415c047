"""A key holding a third of all rows: results stay exact, work is pre-combined."""
from pyspark.sql import functions as F

from ledgerline.operators import clean as C
from ledgerline.operators.enrich import build_enriched_transactions
from ledgerline.operators.risk import build_customer_risk_metrics

TXN = ("transaction_id string, account_id string, transaction_date string, "
       "transaction_amount string, transaction_type string, payment_status string, "
       "channel string")


def test_hot_account_and_hot_id(spark):
    n = 3000
    rows = []
    for i in range(n):
        hot = i % 3 == 0                                    # a third on one account
        rows.append((f"T{i}", "HOT" if hot else f"A{i % 50}", "2024-03-05",
                     f"{10 + i % 7}.25", "Deposit", "Failed" if i % 10 == 0 else "Success",
                     "ATM"))
    # one id re-used by 400 conflicting rows
    rows += [("TX", "HOT", "2024-03-05", f"{i}.50", "Deposit", "Success", "POS")
             for i in range(1, 401)]
    raw = spark.createDataFrame(rows, TXN).repartition(8)
    split = C.clean_transactions(raw)
    assert split.valid.count() == n + 1
    tx = split.valid.where("transaction_id = 'TX'").first()
    assert tx.transaction_amount == 400.5
    assert split.rejected.where("reject_reason = 'duplicate_id_conflict'").count() == 399

    accounts = spark.createDataFrame([("HOT", "C1", "Savings", "B1", None, "Active")]
                                     + [(f"A{i}", f"C{i % 5 + 2}", "Current", "B1", None,
                                         "Active") for i in range(50)],
                                     "account_id string, customer_id string, account_type "
                                     "string, branch_id string, account_opened_date date, "
                                     "account_status string")
    customers = spark.createDataFrame([(f"C{i}", 500000.0, 700) for i in range(1, 8)],
                                      "customer_id string, customer_income double, "
                                      "credit_score int")
    customers = customers.withColumn("city", F.lit("X")).withColumn(
        "customer_since", F.lit(None).cast("date"))
    branches = spark.createDataFrame([("B1", "Main", "X")], "branch_id string, "
                                     "branch_name string, city string")
    loans = spark.createDataFrame([], "loan_id string, customer_id string, loan_amount double, "
                                  "loan_status string")
    fact = build_enriched_transactions(split.valid, accounts, customers, branches)
    assert fact.where("account_id = 'HOT'").count() == n // 3 + 1
    risk = {r.customer_id: r for r in
            build_customer_risk_metrics(split.valid, accounts, loans, customers).collect()}
    hot_rows = [r for r in rows[:n] if r[1] == "HOT"]
    assert risk["C1"].total_transactions == len(hot_rows) + 1
    expected_cents = sum(round(float(r[3]) * 100) for r in hot_rows) + 40050
    assert risk["C1"].total_transaction_value == expected_cents / 100
    assert risk["C7"].total_transactions == 0                # no accounts: zero-filled
