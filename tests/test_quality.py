"""Data-quality checks, scorecard and gate on micro-frames."""
import pytest

from ledgerline.operators import quality as DQ

TXN = ("transaction_id string, account_id string, transaction_date string, "
       "transaction_amount string, transaction_type string, payment_status string, "
       "channel string")


def frames(spark):
    t = spark.createDataFrame([
        ("T1", "A1", "2024-01-05", "10", "Deposit", "Success", "ATM"),
        ("T1", "A1", "2024-01-05", "10", "Deposit", "Success", "ATM"),
        ("T2", None, "2024-01-05", "10", "Deposit", "Success", "ATM"),
        ("T3", "A9", "bad", "-1", " Deposit", "Success", "ATM"),
        (None, "A1", "2024-01-05", None, None, "Success", "ATM"),
        (None, "A1", "05-01-2024", "abc", "Deposit", "Success", "ATM"),
    ], TXN)
    a = spark.createDataFrame([("A1", "C1", "Savings"), ("A2", "C9", None)],
                              "account_id string, customer_id string, account_type string")
    c = spark.createDataFrame([("C1",), ("C1",), ("C2",)], "customer_id string")
    return t, a, c


def test_check_counts(spark):
    t, a, c = frames(spark)
    got = {r.check_name: (r.total_records, r.failed_records)
           for r in DQ.dq_checks(t, a, c).collect()}
    assert got["Missing Transaction ID"] == (6, 2)
    assert got["Missing Account ID (proxy for Customer linkage)"] == (6, 1)
    assert got["Missing Transaction Amount"] == (6, 1)
    assert got["Missing Transaction Type"] == (6, 1)
    assert got["Negative/Invalid/Zero Transaction Amount"] == (6, 3)   # -1, NULL, 'abc'
    assert got["Invalid Transaction Date"] == (6, 1)
    assert got["Invalid Transaction Type"] == (6, 2)                    # untrimmed + NULL
    assert got["Invalid Account Type"] == (2, 1)                        # NULL fails
    assert got["Duplicate Transaction IDs"] == (6, 4)                   # T1 x2, NULL x2
    assert got["Duplicate Customer IDs"] == (3, 2)
    assert got["Transaction Account ID not found in Account master"] == (6, 2)  # NULL + A9
    assert got["Account Customer ID not found in Customer master"] == (2, 1)
    assert len(got) == 12


def test_scorecard_counts_distinct_valid_ids(spark):
    t, a, _ = frames(spark)
    row = DQ.dq_scorecard(t, a).first()
    assert (row.total_records, row.valid_records, row.rejected_records) == (6, 1, 5)
    assert row.data_quality_score_pct == 16.67
    assert row.passed_quality_gate is False
    with pytest.raises(DQ.QualityGateError):
        DQ.evaluate_gate(DQ.dq_scorecard(t, a))


def test_gate_boundary_and_empty_table(spark):
    rows = [("T%d" % i, "A1", "2024-01-05", "1", "Deposit", "Success", "ATM") for i in range(9)]
    rows.append(("T9", None, "2024-01-05", "1", "Deposit", "Success", "ATM"))
    t = spark.createDataFrame(rows, TXN)
    a = spark.createDataFrame([("A1", "C1", "Savings")],
                              "account_id string, customer_id string, account_type string")
    row = DQ.evaluate_gate(DQ.dq_scorecard(t, a))                        # exactly 90.0 passes
    assert row.data_quality_score_pct == 90.0 and row.passed_quality_gate
    empty = spark.createDataFrame([], TXN)
    row = DQ.dq_scorecard(empty, a).first()
    assert row.total_records == 0 and row.data_quality_score_pct == 0.0
    checks = DQ.dq_checks(empty, a, spark.createDataFrame([], "customer_id string")).collect()
    assert all(r.pass_rate_pct == 100.0 for r in checks if r.total_records == 0)


def test_report_text(spark):
    t, a, c = frames(spark)
    text = DQ.format_scorecard(DQ.dq_scorecard(t, a).first(), DQ.dq_checks(t, a, c).collect())
    assert "not passed" in text and text.count("| Consistency |") == 2 and text.count("\n| ") == 14


def test_a_hot_account_is_split_in_the_profile(spark):
    """A third of the rows on one account: AQE cuts that partition (broadcast off)."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        t = spark.range(200_000, numPartitions=8).selectExpr(
            "md5(cast(id as string)) transaction_id",        # only ids and a mask meet the masters
            "if(id % 3 = 0, 'HOT', cast(id as string)) account_id", "'2024-01-05' transaction_date",
            "'10' transaction_amount", "'Deposit' transaction_type")
        a = spark.range(200_000).selectExpr("if(id = 0, 'HOT', cast(id as string)) account_id")
        p = DQ.transaction_profile(t, a).first()
        assert (p["total"], p["orphan_txn_account"], p["valid_ids"]) == (200_000, 0, 200_000)
        joined = DQ._flagged(t, a, DQ.S.TXN_TYPES)               # the join that is written
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_months_are_scored_without_parsing_dates_again(spark, scratch):              # F1, F5
    t, a, _ = frames(spark)
    t.write.parquet(f"{scratch}/t")
    t = spark.read.parquet(f"{scratch}/t")
    rows = lambda log: {tuple(r) for r in log.collect()}
    expected = {(202401, "2024-01-01T00:00:00", 5, 1, 4, 20.0, 0)}
    assert rows(DQ.monthly_log(t, a)) == expected
    DQ.flagged_transactions(t, a).write.parquet(f"{scratch}/flagged")
    log = DQ.monthly_log(t, a, flagged=spark.read.parquet(f"{scratch}/flagged"))
    assert rows(log) == expected
    assert "transaction_date" not in log._jdf.queryExecution().optimizedPlan().toString()
    # without a written table: the dates are not parsed by a filter below the join
    plan = DQ.monthly_log(t, a)._jdf.queryExecution().optimizedPlan().toString()
    assert not any("Filter" in x and "RLIKE" in x for x in plan.splitlines())


def test_a_query_on_the_monthly_log_reads_what_the_run_flagged(spark, monkeypatch):     # F1, F5
    import __spark_entry__ as E
    seen, log = [], DQ.monthly_log
    monkeypatch.setattr(E.DQ, "monthly_log", lambda *a, **k: seen.append(k) or log(*a, **k))
    for name in ("dq_log_trend", "data_quality_kpi"):
        plan = E.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert "l_shipdate" not in plan and "l_orderkey" not in plan, name
    assert all(k["flagged"].inputFiles() for k in seen) and len(seen) == 2


def test_flags_of_tagged_rows_are_those_of_the_raw_ones(spark, scratch):             # F2, F3, F4
    from ledgerline.operators.clean import tag_transactions
    t, a, _ = frames(spark)
    tag_transactions(DQ.with_own_flags(t)).write.parquet(f"{scratch}/tagged")
    got = DQ.flagged_transactions(t, a, tagged=spark.read.parquet(f"{scratch}/tagged"))
    key = lambda df: sorted(map(repr, df.collect()))
    assert key(got) == key(DQ.flagged_transactions(t, a))
