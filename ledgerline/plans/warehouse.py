"""Clean zone and star-schema warehouse as lazy DataFrames.

``build_clean_zone`` runs the cleaners and the orphan split;
``build_warehouse`` adds the enriched fact, risk mart, calendar and DQ log and
conforms every table to the warehouse column list. These builders neither
write nor collect (apart from the imputation medians, two scalars); the
pipeline in ``plans.pipeline`` decides what to materialise, and
``from_testdata`` runs that pipeline on the driver's test tables.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, fields
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from ledgerline import schemas as S
from ledgerline.operators import aggregates as A
from ledgerline.operators import clean as C
from ledgerline.operators import quality as Q
from ledgerline.operators.calendar import build_dim_date
from ledgerline.operators.enrich import build_enriched_transactions, conform, fact_transaction
from ledgerline.operators.risk import build_customer_risk_metrics
from ledgerline.sources.bridge import bridge_raw
from ledgerline.sources.ingest import RawTables

DEFAULT_RUN_AT = "2026-01-01T00:00:00"
DEFAULT_RUN_ID = 1


@dataclass(frozen=True)
class CleanZone:
    customers: DataFrame
    customers_rejected: DataFrame
    branches: DataFrame
    accounts: DataFrame
    accounts_rejected: DataFrame
    transactions: DataFrame           # valid, de-duplicated, orphans removed
    transactions_rejected: DataFrame  # invalid + id conflicts + orphans, with reason
    loans: DataFrame
    loans_rejected: DataFrame


@dataclass(frozen=True)
class Warehouse:
    dim_date: DataFrame
    dim_branch: DataFrame
    dim_customer: DataFrame
    dim_account: DataFrame
    fact_transaction: DataFrame
    fact_loan: DataFrame
    customer_risk_metrics: DataFrame
    data_quality_log: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self)}


def build_clean_zone(raw: RawTables, medians: tuple[float | None, int] | None = None
                     ) -> CleanZone:
    customers = C.clean_customers(raw.customers, medians)
    accounts = C.clean_accounts(raw.accounts)
    txns = C.clean_transactions(raw.transactions)
    orphans = C.split_orphans(txns.valid, accounts.valid)
    loans = C.clean_loans(raw.loans)
    return CleanZone(
        customers=customers.valid, customers_rejected=customers.rejected,
        branches=C.clean_branches(raw.branches),
        accounts=accounts.valid, accounts_rejected=accounts.rejected,
        transactions=orphans.valid,
        transactions_rejected=txns.rejected.unionByName(orphans.rejected,
                                                        allowMissingColumns=True),
        loans=loans.valid, loans_rejected=loans.rejected,
    )


def enriched_transactions(cz: CleanZone) -> DataFrame:
    return build_enriched_transactions(cz.transactions, cz.accounts, cz.customers, cz.branches)


def risk_metrics(cz: CleanZone) -> DataFrame:
    return build_customer_risk_metrics(cz.transactions, cz.accounts, cz.loans, cz.customers)


def daily_aggregation(enriched: DataFrame) -> DataFrame:
    return A.build_daily_aggregations(enriched)


def monthly_aggregation(enriched: DataFrame) -> DataFrame:
    return A.build_monthly_aggregations(enriched)


def branch_performance(enriched: DataFrame, cz: CleanZone) -> DataFrame:
    return A.build_branch_performance(enriched, cz.branches)


def dq_log(raw: RawTables, run_at: str = DEFAULT_RUN_AT, run_id: int = DEFAULT_RUN_ID,
           threshold: float = S.QUALITY_GATE_THRESHOLD) -> DataFrame:
    card = Q.dq_scorecard(raw.transactions, raw.accounts, threshold=threshold)
    return Q.dq_log_rows(card, run_at, run_id)


def build_warehouse(spark: SparkSession, cz: CleanZone, data_quality_log: DataFrame,
                    enriched: DataFrame | None = None, risk: DataFrame | None = None
                    ) -> Warehouse:
    enriched = enriched if enriched is not None else enriched_transactions(cz)
    risk = risk if risk is not None else risk_metrics(cz)
    T = S.WAREHOUSE_TYPES
    return Warehouse(
        dim_date=build_dim_date(spark),
        dim_branch=conform(cz.branches, S.DIM_BRANCH_COLUMNS),
        dim_customer=conform(cz.customers, S.DIM_CUSTOMER_COLUMNS, T["dim_customer"]),
        dim_account=conform(cz.accounts, S.DIM_ACCOUNT_COLUMNS, T["dim_account"]),
        fact_transaction=fact_transaction(enriched),
        fact_loan=conform(cz.loans, S.FACT_LOAN_COLUMNS, T["fact_loan"]),
        customer_risk_metrics=conform(risk, S.RISK_COLUMNS),
        data_quality_log=conform(data_quality_log, S.DQ_LOG_COLUMNS),
    )


# ---------------------------------------------------------------------------
# The driver's test tables through the production pipeline (used by
# __spark_entry__ and the tests): the bridge's raw sources go through
# ``plans.pipeline.run_pipeline`` into a fresh folder under
# ``spark.checkpoint.dir`` (set only when the session left it unset), so every
# registered query reads the tables the real run writes. Cached per
# (application, dir).
# ---------------------------------------------------------------------------
class TestData(NamedTuple):
    raw: RawTables
    cz: CleanZone
    wh: Warehouse
    zone: dict[str, DataFrame]     # every written table (clean, rejected, staged)
    run: object                    # the PipelineResult: counts, folders, checks


_CACHE: dict[tuple[str, str], TestData] = {}


def from_testdata(spark: SparkSession, sf_dir: str) -> TestData:
    key = (spark.sparkContext.applicationId, sf_dir)      # a new session never meets an old one's frames
    if key not in _CACHE:
        from ledgerline.plans.pipeline import run_pipeline
        from ledgerline.session import ensure_checkpoint_dir
        raw = bridge_raw(spark, sf_dir)
        out_root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/testdata-{uuid.uuid4().hex}"
        run = run_pipeline(spark, raw, out_root, run_at=DEFAULT_RUN_AT, enforce_gate=False,
                           register_views=False, read_back=True)
        z = run.written
        clean_txns = z["transactions_best"].join(z["dim_account"].select("account_id"),
                                                 "account_id", "left_semi")
        cz = CleanZone(customers=z["dim_customer"], customers_rejected=z["customers_rejected"],
                       branches=z["dim_branch"], accounts=z["dim_account"],
                       accounts_rejected=z["accounts_rejected"], transactions=clean_txns,
                       transactions_rejected=z["transactions_rejected"], loans=z["fact_loan"],
                       loans_rejected=z["loans_rejected"])
        _CACHE[key] = TestData(raw, cz, run.warehouse, z, run)
    return _CACHE[key]
