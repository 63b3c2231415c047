"""Physical-plan assertions: pushdown, pruning, broadcast, skew guards, no Python."""
import pytest

from pyspark.sql import functions as F

import __spark_entry__ as E
from ledgerline.plans import queries as Q

SMOKE = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def lazy(spark):
    """The warehouse as one un-checkpointed plan from the raw test tables."""
    from ledgerline.plans import warehouse as W
    from ledgerline.sources.bridge import bridge_raw
    raw = bridge_raw(spark, SMOKE)
    cz = W.build_clean_zone(raw)
    return cz, W.build_warehouse(spark, cz, W.dq_log(raw))


def test_no_python_in_any_query(spark, lazy):
    from ledgerline.plans import measures as M
    _, wh = lazy
    fns = [getattr(Q, n) for n in dir(Q) if callable(getattr(Q, n)) and not n.startswith("_")
           and n not in ("Warehouse", "DataFrame")]
    fns += [M.bi_measures, M.txn_value_mom, M.data_quality_kpi, M.risk_scatter]
    for fn in fns:
        p = plan(fn(wh))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, fn.__name__
    for name, fn in E._queries().items():
        if name != "ingest_roundtrip":
            assert "EvalPython" not in plan(fn(spark, SMOKE)), name


def test_ranked_dedup_limits_before_the_shuffle(lazy):
    cz, _ = lazy
    assert "WindowGroupLimit" in plan(cz.transactions)


def test_filter_and_columns_reach_the_scan(spark, scratch):
    from ledgerline.plans.warehouse import Warehouse
    df = spark.createDataFrame([(1, 1, 2.0, "x")], "transaction_id long, is_high_value int, "
                               "transaction_amount double, channel string")
    df.write.parquet(f"{scratch}/fact")
    fact = spark.read.parquet(f"{scratch}/fact")
    wh = Warehouse(*([None] * 4), fact, None, None, None)
    p = plan(Q.high_value_summary(wh))
    assert "PushedFilters: [IsNotNull(is_high_value), EqualTo(is_high_value,1)]" in p
    assert "ReadSchema: struct<is_high_value:int,transaction_amount:double>" in p


def test_calendar_is_broadcast(lazy):
    _, wh = lazy
    df = Q.monthly_trend(wh)
    df.collect()
    assert "BroadcastHashJoin" in plan(df)


def test_foreign_keys_read_one_typed_column_each(spark, scratch):
    import os
    import re

    from ledgerline.operators.constraints import check_constraints
    from ledgerline.plans.warehouse import from_testdata
    tables = {}
    for name, df in from_testdata(spark, SMOKE).wh.tables().items():
        df.write.parquet(f"{scratch}/{name}")
        tables[name] = spark.read.parquet(f"{scratch}/{name}")
    p = plan(check_constraints(tables))
    reads = [re.search("ReadSchema: struct<(.*?)>", line)[1] for line in p.splitlines()
             if "FileScan" in line and f"{os.path.basename(scratch)}/fact_transaction" in line]
    keys = ["account_id:bigint", "customer_id:bigint", "branch_id:bigint", "transaction_date:date"]
    assert sorted(r for r in reads if "," not in r) == sorted(keys) and len(reads) == 5
    assert "Generate explode" not in p.replace("Generate explode(array(struct(", "") and "as string" not in p


def test_losers_move_by_key_and_fingerprint_only(spark, scratch):
    import re

    from ledgerline.operators.clean import losers
    rows = [(i % 900, float(i), f"text {i}") for i in range(1000)]
    spark.createDataFrame(rows, "k long, x double, s string").write.parquet(f"{scratch}/rows")
    df = spark.read.parquet(f"{scratch}/rows")
    df.where("x < 900").write.parquet(f"{scratch}/kept")
    kept = spark.read.parquet(f"{scratch}/kept")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lost = losers(df, kept, "k", "why")
        assert {(r.k, r.x) for r in lost.collect()} == {(i % 900, float(i)) for i in range(900, 1000)}
        lines = plan(losers(df, kept, "k", "why")).splitlines()
        at = next(i for i, x in enumerate(lines) if "FileScan" in x and "/kept" in x)
        above = next(x for x in reversed(lines[:at]) if "Exchange" in x)
        assert re.search(r"hashpartitioning\(k#\d+L?, \d+\)", above), above
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_the_fact_is_aggregated_before_it_meets_the_branches(spark, scratch):
    from ledgerline.plans import measures as M
    from ledgerline.plans.warehouse import Warehouse
    spark.createDataFrame([(1, 1, 1, 2.0, 0, 1)], "transaction_id long, branch_id long, customer_id long, "
                          "transaction_amount double, is_failed int, is_high_value int"
                          ).write.parquet(f"{scratch}/fact")
    spark.createDataFrame([(1, "N", "C")], "branch_id long, branch_name string, city string"
                          ).write.parquet(f"{scratch}/branch")
    wh = Warehouse(None, spark.read.parquet(f"{scratch}/branch"), None, None,
                   spark.read.parquet(f"{scratch}/fact"), None, None, None)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for fn in (Q.branch_performance_sql, M.txn_value_by_branch, M.high_value_by_branch):
            lines = plan(fn(wh)).splitlines()
            at = next(i for i, x in enumerate(lines) if "FileScan" in x and "/fact" in x)
            above = [x for x in lines[:at] if "Exchange" in x or "partial_" in x or "Scan" in x]
            # the nearest of these above the fact's scan is a partial aggregate
            assert "partial_" in above[-1], fn.__name__
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_tagging_shuffles_nothing_and_winners_once(spark):                      # F1, F3, F4
    from ledgerline.operators import clean as C
    rows = [(f"T{i % 90}", "A1", "2024-03-05", f"{i % 95}.25", "Deposit", "Success", "ATM") for i in range(1, 200)]
    raw = spark.createDataFrame(rows, "transaction_id string, account_id string, transaction_date string, "
                                "transaction_amount string, transaction_type string, payment_status string, "
                                "channel string")
    assert "Exchange" not in plan(C.tag_transactions(raw))
    assert plan(C.clean_transactions(raw).valid).count("Exchange") == 1


def test_accounts_and_loans_are_ranked_without_a_shuffle_of_re_sends(spark):     # F1, F3, F4
    from ledgerline.operators import clean as C
    from ledgerline.sources.bridge import bridge_raw
    raw = bridge_raw(spark, SMOKE)
    assert plan(C.clean_loans(raw.loans).valid).count("Exchange hashpartitioning") == 1
    assert plan(C.clean_accounts(raw.accounts).valid.where("account_id > 0")).count("partial_") == 0


def test_calculated_columns_are_made_after_the_month_shuffle(spark, scratch, monkeypatch):    # F1, F3, F4
    from ledgerline.operators.enrich import ENRICHED_COLUMNS
    from ledgerline.plans import pipeline as P
    written = []
    monkeypatch.setattr(P.sinks, "write_table", lambda df, *a, **k: written.append(df) or 0)
    joined = spark.createDataFrame([(1, 2.0, "Failed", 5.0)], "transaction_id long, transaction_amount double, "
                                   "payment_status string, customer_income double")
    from pyspark.sql import functions as F
    joined = joined.select("*", F.lit("2024-03-05").cast("date").alias("transaction_date"), *[
        F.lit(None).cast("string").alias(c) for c in ENRICHED_COLUMNS if c not in joined.columns
        and c not in ("transaction_date", "txn_year", "txn_month", "txn_year_month", "is_high_value", "is_failed",
                      "income_bracket")])
    P.write_fact(joined, scratch)
    p = plan(written[0])
    assert tuple(written[0].columns) == ENRICHED_COLUMNS
    assert written[0].first().txn_year_month == "2024-03"
    assert "income_bracket" not in p[p.index("Exchange"):]


def test_rows_of_other_keys_leave_before_the_shuffle(spark, scratch):                    # F1, F3, F4
    from ledgerline.operators import clean as C
    spark.range(4000).selectExpr("id % 3990 AS k", "id AS x").write.parquet(f"{scratch}/rows")
    df = spark.read.parquet(f"{scratch}/rows")
    keys = df.groupBy("k").count().where("count > 1").select("k")
    assert {r.k for r in C._of_classes(df, keys, "k").collect()} == set(range(10))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = plan(C._of_keys(df, keys, "k")).splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    joins = [x for x in lines if "Join" in x]
    assert "SortMergeJoin" in joins[0] and "BroadcastHashJoin" in joins[1]     # the classes are met first


def test_queries_over_raw_sources_do_not_run_the_pipeline(spark, monkeypatch):          # F2
    from ledgerline.plans import warehouse as W
    monkeypatch.setattr(W, "from_testdata", lambda *a: pytest.fail("the pipeline ran"))
    assert E.queries()["parsed_dates"](spark, SMOKE).columns
    monkeypatch.setattr(E, "ingest_roundtrip", lambda _, raw: raw.branches)
    assert E.queries()["ingest_roundtrip"](spark, SMOKE).count() == 25


def test_a_run_builds_the_raw_transactions_once(spark, scratch, monkeypatch):            # F2, F3, F4
    from ledgerline.plans import pipeline as P
    from ledgerline.sources.bridge import bridge_raw
    reads, months, write = [], [], P.sinks.write_table

    def looked_at(df, root, name, **k):
        p = df._jdf.queryExecution().optimizedPlan().toString()
        if "l_partkey" in p:
            reads.append(name)
        if name == "fact_transaction":
            months.extend(x for x in plan(df).splitlines() if "Exchange hashpartitioning" in x and "xxhash64" in x)
            lines = p.splitlines()
            at = next(i for i, x in enumerate(lines) if "RepartitionByExpression" in x)
            depth = lines[at].index("Repartition")
            below = lines[at + 1:next((i for i in range(at + 1, len(lines)) if lines[i][:depth + 1].strip(" :+-|")),
                                      len(lines))]
            assert any("customer_income" in x for x in below) and not any("branch_name" in x for x in below)
        return write(df, root, name, **k)

    monkeypatch.setattr(P.sinks, "write_table", looked_at)
    P.run_pipeline(spark, bridge_raw(spark, SMOKE), scratch, enforce_gate=False, register_views=False)
    assert reads == ["transactions_tagged"] and len(months) == 1


def test_shuffles_go_when_their_query_ends(spark, scratch):                              # F2, F3, F4
    from ledgerline.session import FREE_SHUFFLES, shuffles_freed
    held = lambda: spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size()
    before, conf = held(), spark.conf.get(FREE_SHUFFLES, None)
    with shuffles_freed(spark):
        spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count().write.parquet(f"{scratch}/a")
    assert held() <= before and spark.conf.get(FREE_SHUFFLES, None) == conf
    assert spark.read.parquet(f"{scratch}/a").count() == 10
