"""BI measures on a hand-built warehouse: MoM with a month gap (W3), slicers."""
import datetime as dt

import pytest

from ledgerline.operators.calendar import build_dim_date
from ledgerline.plans import measures as M
from ledgerline.plans.warehouse import Warehouse

FACT = ("transaction_id long, account_id long, customer_id long, branch_id long, "
        "transaction_date date, transaction_amount double, payment_status string, "
        "channel string, is_high_value int, txn_year int, txn_year_month string")


@pytest.fixture(scope="module")
def wh(spark):
    rows = [
        (1, 1, 1, 1, dt.date(2024, 1, 10), 100.0, "Success", "ATM", 0, 2024, "2024-01"),
        (2, 1, 1, 1, dt.date(2024, 2, 10), 150.0, "Failed", "ATM", 0, 2024, "2024-02"),
        (3, 2, 2, 2, dt.date(2024, 4, 10), 200.0, "Success", "POS", 0, 2024, "2024-04"),
        (4, 2, 2, 2, dt.date(2023, 12, 10), 50.0, "Success", "POS", 0, 2023, "2023-12"),
    ]
    fact = spark.createDataFrame(rows, FACT)
    branches = spark.createDataFrame([(1, "North", "X", "Y"), (2, "South", "X", "Y")],
                                     "branch_id long, branch_name string, city string, "
                                     "country string")
    risk = spark.createDataFrame([(1, "Low", 10.0), (2, "High", 70.5)],
                                 "customer_id long, risk_tier string, risk_score double")
    loans = spark.createDataFrame([(1, "Defaulted", 10.0), (2, "Active", 30.0)],
                                  "customer_id long, loan_status string, loan_amount double")
    return Warehouse(build_dim_date(spark), branches, None, None, fact, loans, risk, None)


def test_mom_uses_the_calendar_prior_month_not_the_previous_row(wh):
    got = {r.year_month: r.value_mom_pct for r in M.txn_value_mom(wh).collect()}
    assert got["2024-01"] == 100.0          # 50 -> 100 across the year boundary
    assert got["2024-02"] == 50.0           # 100 -> 150
    assert got["2024-04"] == 0.0            # 2024-03 is absent: DIVIDE(x, blank, 0)
    assert got["2023-12"] == 0.0


def test_measures_and_slicers(wh):
    def m(**kw):
        return {r.measure: r.value for r in M.bi_measures(wh, **kw).collect()}
    allm = m()
    assert allm["Total Transactions"] == 4 and allm["Total Transaction Value"] == 500.0
    assert allm["Failed Transaction Rate %"] == 25.0
    assert allm["High Risk Customers"] == 1 and allm["Avg Risk Score"] == 40.25
    assert allm["Loan Default Rate %"] == 50.0 and allm["Total Loan Book"] == 40.0
    assert m(year=2024)["Total Transactions"] == 3
    assert m(branch_name="South")["Total Transaction Value"] == 250.0
    assert m(channel="ATM", year=2024)["Active Customers"] == 1
    empty = m(channel="Branch")
    assert empty["Total Transactions"] == 0 and empty["Failed Transaction Rate %"] == 0.0
