"""Queries that SQL can express, against DuckDB over the same whole tables."""
import duckdb
import pytest

from ledgerline.llm import queries as Q

SMOKE = "/root/testdata/sf0.001"


def rows(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(map(str, frame.where(frame.notna(), None).itertuples(index=False, name=None)))


@pytest.mark.parametrize("name", sorted(Q.ORACLE_SQL))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SMOKE}/{table}.parquet')")
    got = Q.QUERIES[name](spark, SMOKE).toPandas()
    assert rows(got) == rows(con.execute(Q.ORACLE_SQL[name]).df())


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_covers_its_whole_table(spark, name):
    table = {"op3_url_filter": "pages", "op9_warc": "pages", "op5_chat_format": "conversations",
             "op13_centroids": "embeddings"}.get(name, "documents")
    if name == "op12_filter_audit":
        whole = spark.read.parquet(f"{SMOKE}/documents.parquet").groupBy("lang").count().collect()
        got = Q.QUERIES[name](spark, SMOKE).where("step = 1").collect()
        assert all(r["kept"] + r["removed"] == dict(whole)[r["part"]] for r in got) and len(got) == 120 * len(whole)
        return
    n, whole = Q.QUERIES[name](spark, SMOKE).count(), spark.read.parquet(f"{SMOKE}/{table}.parquet").count()
    assert n == whole if name not in ("op5_chat_format", "op7_mixing") else 0 < n <= whole
