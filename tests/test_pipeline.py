"""End-to-end run at sf0.001: the reference's output invariants, constraints, gate."""
import uuid

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.constraints import check_constraints
from ledgerline.operators.quality import QualityGateError
from ledgerline.plans import queries as Q
from ledgerline.plans.pipeline import run_pipeline
from ledgerline.sources.bridge import bridge_raw

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def result(spark):
    out = f"{spark.conf.get('spark.checkpoint.dir')}/pipeline-{uuid.uuid4().hex}"
    return run_pipeline(spark, bridge_raw(spark, SMOKE), out, run_at="2026-01-01T00:00:00",
                        enforce_gate=False, export_dir=f"{out}/extracts", read_back=True)


@pytest.mark.parametrize("table", ["dim_date", "dim_branch", "dim_customer", "dim_account",
                                   "fact_transaction", "fact_loan", "customer_risk_metrics",
                                   "data_quality_log"])
def test_tables_non_empty(result, table):
    assert result.warehouse.tables()[table].count() > 0


def test_fact_keys_present_unique_positive(result):
    f = result.warehouse.fact_transaction
    assert f.where(F.col("transaction_id").isNull() | F.col("account_id").isNull()).count() == 0
    assert f.count() == f.select("transaction_id").distinct().count()
    assert f.where(F.col("transaction_amount") <= 0).count() == 0


def test_referential_integrity_and_constraints(result):
    wh = result.warehouse
    assert wh.fact_transaction.join(wh.dim_account, "account_id", "left_anti").count() == 0
    assert wh.fact_loan.join(wh.dim_customer, "customer_id", "left_anti").count() == 0
    bad = [r for r in check_constraints(wh.tables()).collect() if r.violations]
    assert bad == []


def test_risk_mart(result):
    wh = result.warehouse
    r = wh.customer_risk_metrics
    lo, hi = r.agg(F.min("risk_score"), F.max("risk_score")).first()
    assert lo >= 0 and hi <= 100
    assert {x.risk_tier for x in r.select("risk_tier").distinct().collect()} <= {"Low", "Medium", "High"}
    assert r.count() == wh.dim_customer.count()


def test_default_rates(result):
    wh = result.warehouse
    rate = Q.loan_default_rate(wh).first().default_rate_pct
    assert 0 <= rate <= 100
    rates = {x.risk_tier: x.default_rate_pct for x in Q.loan_default_by_tier(wh).collect()}
    if "Low" in rates and "Medium" in rates:
        assert rates["Medium"] >= rates["Low"]
    assert rates.get("Low", 0.0) == 0.0                 # by construction (T10)


def test_conservation_of_transactions(result):
    from ledgerline.operators.clean import standardise_transactions
    c, raw = result.counts, bridge_raw(result.warehouse.dim_date.sparkSession, SMOKE)
    distinct = standardise_transactions(raw.transactions).dropDuplicates().count()
    assert c["fact_transaction"] + c["transactions_rejected"] == distinct


def test_conservation_of_customers_accounts_and_loans(result):
    c, raw = result.counts, bridge_raw(result.warehouse.dim_date.sparkSession, SMOKE)
    for source, valid, rejected in (("customers", "dim_customer", "customers_rejected"),
                                    ("accounts", "dim_account", "accounts_rejected"),
                                    ("loans", "fact_loan", "loans_rejected")):
        assert c[valid] + c[rejected] == getattr(raw, source).dropDuplicates().count(), source
        assert c[rejected] > 0


def test_written_tables_have_their_types(result):
    """The contract layer shows dates as text; what is written has real types."""
    from ledgerline.plans.pipeline import read_warehouse
    spark = result.warehouse.dim_date.sparkSession
    wh = read_warehouse(spark, result.out_root)
    types = {n: dict(df.dtypes) for n, df in wh.tables().items()}
    assert types["dim_date"]["date_key"] == "date"
    assert types["dim_customer"]["dob"] == types["dim_customer"]["customer_since"] == "date"
    assert types["dim_account"]["account_opened_date"] == types["fact_loan"]["loan_start_date"] == "date"
    fact = types["fact_transaction"]
    assert (fact["transaction_date"], fact["transaction_amount"], fact["is_failed"], fact["transaction_id"],
            fact["account_id"]) == ("date", "double", "int", "bigint", "bigint")
    assert types["fact_loan"]["interest_rate"] == "double" and types["dim_customer"]["credit_score"] == "int"


def test_quality_report_and_log(result):
    assert {r.category for r in result.checks} == {"Completeness", "Validity", "Uniqueness",
                                                  "Consistency"}
    log = result.warehouse.data_quality_log.collect()
    assert len(log) == 1 and log[0].passed_quality_gate == 0
    assert result.counts["export_fact_transaction"] == result.counts["fact_transaction"]


def test_gate_stops_the_load(spark):
    out = f"{spark.conf.get('spark.checkpoint.dir')}/gate-{uuid.uuid4().hex}"
    with pytest.raises(QualityGateError):
        run_pipeline(spark, bridge_raw(spark, SMOKE), out)


def test_quality_log_accumulates_runs(spark):
    """A second run appends; the trend is newest first."""
    from ledgerline.plans import measures as M
    out = f"{spark.conf.get('spark.checkpoint.dir')}/log-{uuid.uuid4().hex}"
    raw = bridge_raw(spark, SMOKE)
    run_pipeline(spark, raw, out, run_at="2026-01-01T00:00:00", enforce_gate=False)
    second = run_pipeline(spark, raw, out, run_at="2026-02-01T00:00:00", enforce_gate=False,
                          threshold=50.0)
    trend = Q.dq_log_trend(second.warehouse).collect()
    assert [r.run_at for r in trend] == ["2026-02-01T00:00:00", "2026-01-01T00:00:00"]
    assert [r.passed_quality_gate for r in trend] == [1, 0]
    kpi = M.data_quality_kpi(second.warehouse).first()
    assert kpi.data_quality_score_max == kpi.data_quality_score_latest
    assert kpi.data_quality_score_max.endswith("%")


def test_a_repeated_run_replaces_its_log_row_and_a_lost_one_changes_nothing(spark, monkeypatch):
    from ledgerline.plans import pipeline as P
    out = f"{spark.conf.get('spark.checkpoint.dir')}/rerun-{uuid.uuid4().hex}"
    raw = bridge_raw(spark, SMOKE)
    with pytest.raises(FileNotFoundError):
        P.read_warehouse(spark, out)
    first = run_pipeline(spark, raw, out, run_at="2026-01-01T00:00:00", enforce_gate=False)
    again = run_pipeline(spark, raw, out, run_at="2026-01-01T00:00:00", enforce_gate=False, threshold=50.0)
    log = P.read_warehouse(spark, out).data_quality_log.collect()
    assert len(log) == 1 and log[0].passed_quality_gate == 1
    # an open reader of the first run still has its tables
    assert same(first.warehouse.fact_transaction, again.warehouse.fact_transaction)

    def lost(*_):
        raise RuntimeError("driver lost before the commit")
    monkeypatch.setattr(P, "commit", lost)
    fewer = type(raw)(**{**raw.as_dict(), "transactions": raw.transactions.where("transaction_id % 2 = 0")})
    with pytest.raises(RuntimeError):
        run_pipeline(spark, fewer, out, run_at="2026-01-02T00:00:00", enforce_gate=False)
    assert P.read_warehouse(spark, out).fact_transaction.count() == again.counts["fact_transaction"]


def test_the_fact_is_written_once(result):
    import glob
    found = glob.glob(f"{result.out_root.removeprefix('file://')}/**/fact_transaction", recursive=True)
    assert len([f for f in found if "/extracts/" not in f]) == 1


def test_landing_read_uses_latest_transactions_partition(spark, scratch):
    from ledgerline.sources.ingest import ingest_all, read_latest_landing, write_raw_csv
    raw = bridge_raw(spark, SMOKE)
    for name, df in raw.as_dict().items():
        write_raw_csv(df, f"{scratch}/raw", name)
    assert ingest_all(spark, f"{scratch}/raw", f"{scratch}/landing", "2026-01-01").ok
    assert ingest_all(spark, f"{scratch}/raw", f"{scratch}/landing", "2026-01-02").ok
    landed = read_latest_landing(spark, f"{scratch}/landing")
    assert landed.transactions.count() == raw.transactions.count()   # one partition only
    assert "ingest_date" not in landed.customers.columns


@pytest.fixture(scope="module")
def lazy(spark):
    """The same warehouse as one lazy plan per table, from the plain builders."""
    from ledgerline.plans import warehouse as W
    raw = bridge_raw(spark, SMOKE)
    cz = W.build_clean_zone(raw)
    enriched = W.enriched_transactions(cz)
    return cz, W.build_warehouse(spark, cz, W.dq_log(raw)), enriched


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("table", ["dim_branch", "dim_customer", "dim_account",
                                   "fact_transaction", "fact_loan", "customer_risk_metrics"])
def test_pipeline_equals_the_lazy_warehouse(result, lazy, table):
    """The staged, concurrent pipeline and the lazy plans give the same tables."""
    assert same(lazy[1].tables()[table], result.warehouse.tables()[table])


def test_rejects_and_rollups_match_the_lazy_path(result, lazy):
    from ledgerline.plans import warehouse as W
    cz, _, enriched = lazy
    z = result.written
    assert same(cz.transactions_rejected, z["transactions_rejected"])
    assert same(cz.customers_rejected, z["customers_rejected"])
    assert same(cz.accounts_rejected, z["accounts_rejected"])
    assert same(cz.loans_rejected, z["loans_rejected"])
    assert same(enriched, z["fact_transaction"])
    assert same(W.daily_aggregation(enriched), z["daily_aggregation"])
    assert same(W.monthly_aggregation(enriched), z["monthly_aggregation"])
    assert same(W.branch_performance(enriched, cz), z["branch_performance"])


def test_year_slicer_prunes_fact_partitions(result):
    from ledgerline.plans import measures as M
    f = M.sliced_fact(result.warehouse, year=2024)
    plan = f._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(txn_year_month" in plan and "StartsWith" in plan
    assert f.where("txn_year <> 2024").count() == 0
    assert f.count() == result.warehouse.fact_transaction.where("txn_year = 2024").count()
