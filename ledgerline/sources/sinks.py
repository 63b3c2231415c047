"""Clean-zone, reject, warehouse and export sinks.

Writes return their row count through an ``Observation`` on the write itself,
so counting never costs a second pass over the data.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import ensure_checkpoint_dir
from ledgerline.sources.commits import commit, in_force

# What makes a CSV file readable by any other tool: quotes are doubled, blanks kept.
CSV_DIALECT = {"header": "true", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false",
               "ignoreTrailingWhiteSpace": "false"}


def write_table(df: DataFrame, root: str, name: str, partition_by: list[str] | None = None,
                mode: str = "overwrite") -> int:
    """Write parquet and return the number of rows written."""
    obs = Observation(f"rows_{name}")
    writer = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{root.rstrip('/')}/{name}")
    return int(obs.get["rows"])


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """S13."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write under ``spark.checkpoint.dir`` and read back: lineage is cut, the
    table is computed once, and a join on it is a plain join of two shuffles
    that AQE can split."""
    spark = df.sparkSession
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/staged-{uuid.uuid4().hex}"
    df.write.parquet(f"{root}/{name}")
    return read_table(spark, root, name)


def append_dq_log(log_row: DataFrame, root: str) -> int:
    """The log has one row per run_id; a run that is repeated replaces its row."""
    commit(log_row, f"{root.rstrip('/')}/data_quality_log", ["run_id"])
    return 1


def read_dq_log(spark: SparkSession, root: str) -> DataFrame:
    log = in_force(spark, f"{root.rstrip('/')}/data_quality_log", ["run_id"])
    if log is None:
        raise FileNotFoundError(f"no run is logged in {root}")
    return log


def write_json(df: DataFrame, path: str) -> None:
    """Small report frames (12 checks, 1 scorecard) as JSON lines."""
    df.coalesce(1).write.mode("overwrite").json(path)


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """A formatted report (a few dozen lines) as a text file."""
    spark.createDataFrame([(line,) for line in text.splitlines()], "value string") \
        .coalesce(1).write.mode("overwrite").text(path)


def export_csv(tables: dict[str, DataFrame], out_dir: str) -> dict[str, int]:
    """One CSV extract (a folder of part files) per warehouse table."""
    counts = {}
    for name, df in tables.items():
        obs = Observation(f"csv_{name}")
        (df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
         .options(**CSV_DIALECT).csv(f"{out_dir.rstrip('/')}/{name}"))
        counts[name] = int(obs.get["rows"])
    return counts
