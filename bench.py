"""Benchmark: the full pipeline plus every warehouse question, timed.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Stages: session start; ingestion of the CSV drops into the landing zone;
clean zone (dimensions, transactions, enriched fact,
risk mart and roll-ups, each written as parquet); quality checks + gate
(recorded, not enforced: the test data is dirtier than the 90% gate on
purpose); warehouse load; then each question collected once. Prints one JSON
line. Output goes to a fresh scratch folder under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    t0 = time.perf_counter()
    from ledgerline.session import local_session
    from ledgerline.plans import measures as M
    from ledgerline.plans import queries as Q
    from ledgerline.plans.pipeline import run_pipeline
    from ledgerline.sources.bridge import bridge_raw
    from ledgerline.sources.ingest import ingest_all, read_latest_landing, write_raw_csv

    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) * 2, app="ledgerline-bench")
    timings: dict[str, float] = {"session_start": round(time.perf_counter() - t0, 3)}
    out_root = f"{spark.conf.get('spark.checkpoint.dir').rstrip('/')}/bench-{uuid.uuid4().hex}"

    # upstream systems drop CSV files (not timed)
    drop_dir, landing = f"{out_root}/raw", f"{out_root}/landing"
    for name, df in bridge_raw(spark, sf_dir).as_dict().items():
        write_raw_csv(df, drop_dir, name)
    day = "2026-01-01"
    t = time.perf_counter()
    report = ingest_all(spark, drop_dir, landing, day)
    if not report.ok:
        raise RuntimeError(f"ingestion failed: {report.results}")
    raw = read_latest_landing(spark, landing)
    timings["ingest"] = round(time.perf_counter() - t, 3)
    result = run_pipeline(spark, raw, out_root, enforce_gate=False)
    timings.update(result.timings)
    pipeline_sec = time.perf_counter() - t

    wh = result.warehouse
    questions = {
        "q1a_total_txn_value": Q.total_txn_value, "q1b_txn_value_by_month": Q.txn_value_by_month,
        "q2a_avg_txn_amount": Q.avg_txn_amount, "q2b_avg_txn_by_type": Q.avg_txn_by_type,
        "q3a_high_value_detail": Q.high_value_detail, "q3b_high_value_summary": Q.high_value_summary,
        "q4a_failed_rate": Q.failed_rate, "q4b_failed_rate_by_channel": Q.failed_rate_by_channel,
        "q5a_top_risk_customers": Q.top_risk_customers,
        "q5b_risk_tier_distribution": Q.risk_tier_distribution,
        "q6_monthly_trend": Q.monthly_trend, "q7a_branch_performance": Q.branch_performance_sql,
        "q7b_branch_risk": Q.branch_risk, "q8a_loan_default_rate": Q.loan_default_rate,
        "q8b_loan_default_by_type": Q.loan_default_by_type,
        "q8c_loan_default_by_tier": Q.loan_default_by_tier, "q9_dq_log_trend": Q.dq_log_trend,
        "q10_credit_band_distribution": Q.credit_band_distribution,
        "bi_measures": M.bi_measures, "bi_value_mom": M.txn_value_mom,
    }
    t = time.perf_counter()
    for name, fn in questions.items():
        tq = time.perf_counter()
        fn(wh).collect()
        timings[name] = round(time.perf_counter() - tq, 3)
    query_sec = time.perf_counter() - t
    total = timings["session_start"] + pipeline_sec + query_sec  # excludes the upstream drop
    raw_txns = result.scorecard["total_records"]
    print(json.dumps({
        "metric": "end_to_end_sec", "value": round(total, 3), "unit": "sec",
        "queries": timings,
        "pipeline_sec": round(pipeline_sec, 3), "questions_sec": round(query_sec, 3),
        "raw_transactions": raw_txns,
        "rows_per_sec": round(raw_txns / pipeline_sec, 1),
        "baseline_rows_per_sec": 2676,
        "throughput_vs_baseline": round(raw_txns / pipeline_sec / 2676, 2),
        "sf": os.path.basename(sf_dir).replace("sf", ""), "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
