"""Every oracle-checked query against its DuckDB SQL on the smallest test tables."""
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E

SMOKE = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SMOKE}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def norm(df):
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        s = df[c]
        if pd.api.types.is_datetime64_any_dtype(s):
            df[c] = s.dt.strftime("%Y-%m-%d").astype(object).where(s.notna(), None)
        else:
            df[c] = s.map(lambda v: None if v is None or (isinstance(v, float) and v != v)
                          else repr(v) if isinstance(v, float) else str(v))
    return df.sort_values(list(df.columns)).reset_index(drop=True)


CORE = sorted(E._queries())      # the training-data queries have tests of their own


@pytest.mark.parametrize("name", CORE)
def test_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SMOKE).toPandas()
    want = con.execute(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    pd.testing.assert_frame_equal(norm(got), norm(want))


def test_every_query_has_an_oracle():
    assert set(CORE) <= set(E.oracle_sql()) and set(CORE) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["risk_tier", "customer_count", "avg_risk_score", "avg_credit_score",
                          "total_txn_value"]


SPARK_TO_DUCKDB = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                   "date": "DATE", "boolean": "BOOLEAN", "timestamp": "TIMESTAMP"}


def test_column_types_match_the_oracle(spark, con):
    bad = {}
    for name in CORE:
        sql = E.oracle_sql()[name]
        spark_types = {f.name: SPARK_TO_DUCKDB.get(f.dataType.simpleString(),
                                                   f.dataType.simpleString())
                       for f in E.queries()[name](spark, SMOKE).schema.fields}
        duck_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
        if spark_types != duck_types:
            bad[name] = (spark_types, duck_types)
    assert bad == {}
