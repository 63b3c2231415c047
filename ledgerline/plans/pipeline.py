"""End-to-end run: clean zone -> quality gate -> warehouse.

Every stage writes its output and the next stage reads it back, so lineage
is cut at each table (an executor lost later never replays the cleaning), and
each expensive step runs once instead of once per consumer. Within a wave,
independent writes are submitted together from driver threads.

1. Wave 1: customers, accounts, loans and branches with their rejects, and
   the ranked transaction winners, written to a staging table (the ranking
   window runs once, over the rows that may have rivals). Standardised customers, the tagged
   transactions and the repeated keys are staged too: each is used several times. Exact re-sends
   are only looked for where they can show, among invalid rows and repeated keys.
2. Wave 2: the enriched fact (one inner join of the staged winners to the account
   dimension), written partitioned by ``txn_year_month``.
3. Wave 3: the transaction rejects (invalid rows, id conflicts, orphans) and two small
   grains of the fact (day x branch x account type; branch x customer), then the
   risk mart and the three roll-ups from them.
4. The quality checks read the raw sources, transactions with the checks that each failed as they
   were staged: they run in the background from then on and are joined before the gate, which
   stops the warehouse load when enforced.
5. The load adds the calendar, puts the run's row into the quality log and, last,
   commits a record that names the run's tables. ``read_warehouse`` follows the newest
   record in any session and conforms the tables to the star-schema columns, so
   nothing is written twice, and a reader during a run, or after one that was
   lost, has the warehouse of the run before.

Paths: ``out_root`` must be a shared folder on a cluster; each run has a folder of
its own in it. Counts come from ``Observation``s on the writes.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ledgerline import schemas as S
from ledgerline.operators import aggregates as A
from ledgerline.operators import clean as C
from ledgerline.operators import quality as DQ
from ledgerline.operators.calendar import build_dim_date
from ledgerline.operators.enrich import (ENRICHED_COLUMNS, add_calculated_columns, conform, join_branches,
                                         join_dimensions)
from ledgerline.operators.risk import customer_risk_from_totals, transaction_totals_from_grain
from ledgerline.plans.warehouse import Warehouse
from ledgerline.session import shuffles_freed
from ledgerline.sources import sinks
from ledgerline.sources.commits import commit, in_force
from ledgerline.sources.ingest import RawTables


CLEAN_TABLES = ("dim_customer", "dim_branch", "dim_account", "fact_loan", "fact_transaction",
                "customer_risk_metrics", "daily_aggregation", "monthly_aggregation",
                "branch_performance")
REJECT_TABLES = ("customers_rejected", "accounts_rejected", "loans_rejected",
                 "transactions_rejected")
STAGED_TABLES = ("transactions_best", "transactions_flagged")       # those that queries read after the run


@dataclass
class PipelineResult:
    warehouse: Warehouse
    out_root: str
    run_root: str
    counts: dict[str, int] = field(default_factory=dict)
    timings: dict[str, float] = field(default_factory=dict)
    scorecard: Row | None = None
    checks: list[Row] = field(default_factory=list)
    # every table the run wrote, read back: clean zone, rejects, staged winners
    written: dict[str, DataFrame] = field(default_factory=dict)


class _Clock:
    def __init__(self):
        self.timings: dict[str, float] = {}
        self._t = time.perf_counter()

    def lap(self, name: str) -> None:
        now = time.perf_counter()
        self.timings[name] = round(now - self._t, 3)
        self._t = now


def run_parallel(jobs: dict[str, Callable[[], object]], max_workers: int = 8) -> dict[str, object]:
    """Submit independent Spark jobs from driver threads; the scheduler runs
    their tasks side by side instead of leaving slots idle between small jobs."""
    if len(jobs) <= 1:
        return {name: fn() for name, fn in jobs.items()}
    with ThreadPoolExecutor(max_workers=min(max_workers, len(jobs))) as pool:
        futures = {name: pool.submit(fn) for name, fn in jobs.items()}
        return {name: f.result() for name, f in futures.items()}


SALTS = 16      # tasks that share a month's rows


def write_fact(joined: DataFrame, root: str, branches: DataFrame | None = None) -> int:
    """Enriched fact, partitioned by month on disk.

    Rows are dealt out by month and a salt of the id, so a task writes a few
    month folders instead of one file per month per task, and a month holding a
    third of all rows is still cut across SALTS tasks. Unlike a range layout
    this needs no sampling pass over the fact join. ``joined`` has no calculated columns
    yet: they follow from the others and would only make this shuffle wider. So do the names of
    the few ``branches``, which are joined after it where they are given.
    """
    month = F.date_format("transaction_date", "yyyy-MM")
    salt = F.pmod(F.xxhash64("transaction_id"), F.lit(SALTS))
    dealt = joined.repartition(month, salt)
    enriched = add_calculated_columns(dealt if branches is None else join_branches(dealt, branches))
    enriched = enriched.select(*ENRICHED_COLUMNS)
    return sinks.write_table(enriched, root, "fact_transaction", partition_by=["txn_year_month"])


def run_clean_zone(spark: SparkSession, raw: RawTables, clean_root: str,
                   reject_root: str, staging_root: str, counts: dict[str, int],
                   clock: _Clock, when_tagged: Callable[[DataFrame], object] = lambda _: None) -> None:
    """Clean, split, enrich and roll up; every table is written. ``when_tagged`` gets the
    tagged transactions as soon as they are written."""
    rd = lambda root, name: sinks.read_table(spark, root, name)
    w = sinks.write_table

    def entity(make_split, valid_name: str, reject_name: str):
        """valid -> written; rejects computed against the written winners."""
        def chain() -> dict[str, int]:
            split = make_split()        # customers: the medians are computed here
            repeated = stage(split.repeated(), f"{valid_name}_repeated")
            n_valid = w(split.valid_given(repeated), clean_root, valid_name)
            n_rej = w(split.rejects_given(rd(clean_root, valid_name), repeated), reject_root, reject_name)
            return {valid_name: n_valid, reject_name: n_rej}
        return chain

    def stage(df: DataFrame, name: str) -> DataFrame:
        w(df, staging_root, name)
        return rd(staging_root, name)

    def customers() -> C.Split:
        # the medians, the ranking and the rejects all start from the same rows
        std = stage(C.standardise_customers(raw.customers.dropDuplicates()), "customers_standardised")
        return C.clean_customers(raw.customers, standardised=std)

    def transactions() -> dict[str, int]:
        # written once: the ranking, the rejects (wave 2) and the quality checks all read it
        tagged = stage(C.tag_transactions(DQ.with_own_flags(raw.transactions)), "transactions_tagged")
        when_tagged(tagged)
        split = ranked(tagged)
        repeated = stage(split.repeated(), "transactions_repeated")
        rivals = stage(split.rivals(repeated), "transactions_rivals")
        return {"transactions_ranked": w(split.valid_of(repeated, rivals), staging_root, "transactions_best")}

    def ranked(tagged: DataFrame) -> C.Split:
        return C.split_tagged(tagged.drop(DQ.OWN_FLAGS), "transaction_id", [("transaction_amount", "desc")],
                              "duplicate_id_conflict")

    wave1 = {
        "customers": entity(customers, "dim_customer", "customers_rejected"),
        "accounts": entity(lambda: C.clean_accounts(raw.accounts), "dim_account",
                           "accounts_rejected"),
        "loans": entity(lambda: C.clean_loans(raw.loans), "fact_loan", "loans_rejected"),
        "branches": lambda: {"dim_branch": w(C.clean_branches(raw.branches), clean_root,
                                             "dim_branch")},
        "transactions": transactions,
    }
    for written in run_parallel(wave1).values():
        counts.update(written)
    clock.lap("clean_wave1")

    dims = {n: rd(clean_root, n) for n in ("dim_customer", "dim_branch", "dim_account",
                                           "fact_loan")}
    winners = rd(staging_root, "transactions_best")
    rejects = ranked(rd(staging_root, "transactions_tagged")).rejects_of(
        rd(staging_root, "transactions_rivals")).unionByName(
        C.orphans(winners, dims["dim_account"]), allowMissingColumns=True)
    joined = join_dimensions(winners, dims["dim_account"], dims["dim_customer"], None, how="inner")
    counts["fact_transaction"] = write_fact(joined, clean_root, dims["dim_branch"])
    fact = rd(clean_root, "fact_transaction")
    clock.lap("clean_wave2_fact")

    # two scans of the fact, one per grain; the four outputs roll the grains up. The rejects run beside
    # them, not beside the fact, whose shuffles are the largest
    counts.update(run_parallel({
        "transactions_rejected": lambda: w(rejects, reject_root, "transactions_rejected"),
        "grain_day": lambda: w(A.day_grain(fact), staging_root, "grain_day"),
        "grain_customer": lambda: w(A.customer_grain(fact), staging_root, "grain_customer"),
    }))
    by_day, by_customer = rd(staging_root, "grain_day"), rd(staging_root, "grain_customer")
    risk = customer_risk_from_totals(transaction_totals_from_grain(by_customer),
                                     dims["fact_loan"], dims["dim_customer"])
    counts.update(run_parallel({
        "customer_risk_metrics": lambda: w(risk, clean_root, "customer_risk_metrics"),
        "daily_aggregation": lambda: w(A.daily_from_grain(by_day), clean_root,
                                       "daily_aggregation"),
        "monthly_aggregation": lambda: w(A.monthly_from_grain(by_day), clean_root,
                                         "monthly_aggregation"),
        "branch_performance": lambda: w(A.branch_performance_from_grain(by_customer,
                                                                        dims["dim_branch"]),
                                        clean_root, "branch_performance"),
    }))
    clock.lap("clean_wave3_rollups")


def run_quality(raw: RawTables, tagged: DataFrame, threshold: float, report_root: str | None,
                spark: SparkSession, staging_root: str) -> tuple[Row, list[Row]]:
    """Checks and scorecard over the raw sources. ``tagged``: the raw transactions as they were
    tagged and written, each with its own failed checks."""
    # this table serves the checks, the scorecard and later the monthly log
    sinks.write_table(DQ.flagged_transactions(raw.transactions, raw.accounts, tagged=tagged), staging_root,
                      "transactions_flagged")
    flagged = sinks.read_table(spark, staging_root, "transactions_flagged")
    profile = sinks.staged(DQ.transaction_profile(raw.transactions, raw.accounts, flagged=flagged),
                           "transaction-profile")  # one row
    checks = DQ.dq_checks(raw.transactions, raw.accounts, raw.customers, txn_profile=profile)
    card = DQ.dq_scorecard(raw.transactions, raw.accounts, threshold=threshold,
                           txn_profile=profile)
    check_rows = checks.collect()  # 12 rows
    score = DQ.evaluate_gate(card, enforce=False)
    if report_root:
        sinks.write_json(spark.createDataFrame(check_rows, checks.schema),
                         f"{report_root}/dq_checks")
        sinks.write_json(spark.createDataFrame([score], card.schema),
                         f"{report_root}/dq_scorecard")
        sinks.write_text(spark, DQ.format_scorecard(score, check_rows),
                         f"{report_root}/dq_scorecard_txt")
    return score, check_rows


#: Warehouse tables as the clean zone has them: columns and, where they are pinned, types.
CONFORMED = {
    "dim_branch": (S.DIM_BRANCH_COLUMNS, None),
    "dim_customer": (S.DIM_CUSTOMER_COLUMNS, S.WAREHOUSE_TYPES["dim_customer"]),
    "dim_account": (S.DIM_ACCOUNT_COLUMNS, S.WAREHOUSE_TYPES["dim_account"]),
    "fact_transaction": (S.FACT_TXN_COLUMNS, S.WAREHOUSE_TYPES["fact_transaction"]),
    "fact_loan": (S.FACT_LOAN_COLUMNS, S.WAREHOUSE_TYPES["fact_loan"]),
    "customer_risk_metrics": (S.RISK_COLUMNS, None),
}


def _warehouse_commits(out_root: str) -> str:
    return f"{out_root.rstrip('/')}/_commits/warehouse"


def read_warehouse(spark: SparkSession, out_root: str) -> Warehouse:
    """The warehouse of the newest committed run, in this or another session."""
    record = in_force(spark, _warehouse_commits(out_root), ["name"])
    if record is None:
        raise FileNotFoundError(f"no run has loaded a warehouse into {out_root}")
    paths = record.first()["tables"]
    read = {name: spark.read.parquet(path) for name, path in paths.items()}
    tables = {name: conform(read[name], columns, types) for name, (columns, types) in CONFORMED.items()}
    return Warehouse(dim_date=read["dim_date"], data_quality_log=sinks.read_dq_log(spark, out_root), **tables)


def run_pipeline(spark: SparkSession, raw: RawTables, out_root: str,
                 run_at: str | None = None, threshold: float = S.QUALITY_GATE_THRESHOLD,
                 enforce_gate: bool = True, export_dir: str | None = None,
                 register_views: bool = True, read_back: bool = False) -> PipelineResult:
    """Run E1-E3 and return the warehouse as DataFrames over the written tables.

    With ``enforce_gate`` a failed quality gate raises ``QualityGateError``
    after the clean zone is written and before the warehouse is loaded, as in
    the reference. With ``enforce_gate=False`` the failure is recorded in the
    log row and the load continues.
    """
    out_root = out_root.rstrip("/")
    run_at = run_at or dt.datetime.now().replace(microsecond=0).isoformat()
    run_id = int(run_at.replace("-", "").replace(":", "").replace("T", "")[:14])
    run_root = f"{out_root}/runs/{run_id}-{uuid.uuid4().hex}"
    clean_root, reject_root, staging_root = (f"{run_root}/{x}" for x in ("clean", "rejected", "staging"))
    counts: dict[str, int] = {}
    clock = _Clock()
    # the quality pass reads no cleaned table: it runs in the background from when the transactions are
    # tagged, through the cleaning waves, and is joined before the gate
    with shuffles_freed(spark), ThreadPoolExecutor(max_workers=1) as background:
        quality: list[Future] = []
        run_clean_zone(spark, raw, clean_root, reject_root, staging_root, counts, clock,
                       lambda tagged: quality.append(background.submit(
                           run_quality, raw, tagged, threshold, f"{run_root}/reports", spark, staging_root)))
        score, check_rows = quality[0].result()
    clock.lap("quality_wait")
    if enforce_gate and not score["passed_quality_gate"]:
        raise DQ.QualityGateError(
            f"data quality score {score['data_quality_score_pct']}% is below the gate "
            f"{score['quality_gate_threshold_pct']}%")

    log_row = spark.createDataFrame(
        [(run_id, run_at, score["total_records"], score["valid_records"],
          score["rejected_records"], float(score["data_quality_score_pct"]),
          int(bool(score["passed_quality_gate"])))],
        "run_id long, run_at string, total_records long, valid_records long, "
        "rejected_records long, data_quality_score_pct double, passed_quality_gate int")
    counts.update(run_parallel({
        "data_quality_log": lambda: sinks.append_dq_log(log_row, out_root),
        "dim_date": lambda: sinks.write_table(build_dim_date(spark), clean_root, "dim_date"),
    }))
    # the tables are written: from here on readers of the warehouse see this run
    paths = {name: f"{clean_root}/{name}" for name in ("dim_date", *CONFORMED)}
    commit(spark.createDataFrame([("warehouse", run_id, paths)], "name string, run_id long, tables map<string,string>"),
           _warehouse_commits(out_root), ["name"])
    wh = read_warehouse(spark, out_root)
    if register_views:
        for name, df in wh.tables().items():
            df.createOrReplaceTempView(name)
    clock.lap("warehouse_load")
    if export_dir:
        counts.update({f"export_{k}": v for k, v in sinks.export_csv(wh.tables(),
                                                                     export_dir).items()})
        clock.lap("export")
    written: dict[str, DataFrame] = {}
    if read_back:  # every written table as a DataFrame (``PipelineResult.written``)
        written = {n: sinks.read_table(spark, clean_root, n) for n in CLEAN_TABLES}
        written.update({n: sinks.read_table(spark, reject_root, n) for n in REJECT_TABLES})
        written.update({n: sinks.read_table(spark, staging_root, n) for n in STAGED_TABLES})
    return PipelineResult(wh, out_root, run_root, counts, clock.timings, score, check_rows, written)
