"""Sinks (S11-S20): counts from Observations, append, extracts, reports."""
from ledgerline.sources import sinks


def test_write_table_counts_and_partitions(spark, scratch):
    df = spark.createDataFrame([(i, f"2024-0{i % 3 + 1}") for i in range(10)],
                               "id long, month string")
    assert sinks.write_table(df, scratch, "t", partition_by=["month"]) == 10
    back = sinks.read_table(spark, scratch, "t")
    assert back.count() == 10 and sorted(r.month for r in back.select("month").distinct().collect()) \
        == ["2024-01", "2024-02", "2024-03"]
    assert sinks.write_table(df.limit(4), scratch, "t") == 4          # overwrite
    assert sinks.read_table(spark, scratch, "t").count() == 4


def test_log_is_keyed_by_run(spark, scratch):
    row = lambda i, at: spark.createDataFrame([(i, at)], "run_id long, run_at string")
    for i, at in ((1, "a"), (2, "b"), (1, "c"), (1, "d")):
        assert sinks.append_dq_log(row(i, at), scratch) == 1
    assert {tuple(r) for r in sinks.read_dq_log(spark, scratch).collect()} == {(1, "d"), (2, "b")}


def test_extracts_and_reports(spark, scratch):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    assert sinks.export_csv({"x": df}, f"{scratch}/extracts") == {"x": 2}
    back = spark.read.option("header", True).csv(f"{scratch}/extracts/x")
    assert sorted(r.v for r in back.collect()) == ["a", "b"]
    odd = spark.createDataFrame([(1, 'a "q" b, c'), (2, "  blanks  ")], "id int, v string")
    sinks.export_csv({"odd": odd}, f"{scratch}/extracts")
    lines = spark.read.text(f"{scratch}/extracts/odd").where("value not like 'id%'").collect()
    assert sorted(r.value for r in lines) == ['1,"a ""q"" b, c"', "2,  blanks  "]
    sinks.write_json(df, f"{scratch}/json")
    assert spark.read.json(f"{scratch}/json").count() == 2
    sinks.write_text(spark, "line one\nline two", f"{scratch}/txt")
    assert [r.value for r in spark.read.text(f"{scratch}/txt").collect()] == ["line one",
                                                                            "line two"]
