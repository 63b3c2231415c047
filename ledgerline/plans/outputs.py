"""What a run leaves besides its tables, read back: manifest, reports, extracts, log, counts.

``run_outputs`` and ``quality_log_rerun`` are registered queries: everything is
written by the production functions and read again from the files.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import schemas as S
from ledgerline.plans.pipeline import PipelineResult
from ledgerline.session import ensure_checkpoint_dir
from ledgerline.sources import sinks
from ledgerline.sources.ingest import RawTables, ingest_all, write_manifest, write_raw_csv

NUMBERS_OF_A_SCORE = ("total_records", "valid_records", "rejected_records")


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _rows(df: DataFrame, output: str, item: Column, n: Column) -> DataFrame:
    return df.select(F.lit(output).alias("output"), item.alias("item"), n.cast("long").alias("n"))


def _manifest(spark: SparkSession, raw: RawTables) -> DataFrame:
    """Branches and loans are there, accounts aren't."""
    root = _scratch(spark, "manifest")
    for name in ("branches", "loans"):
        write_raw_csv(getattr(raw, name), f"{root}/raw", name)
    wanted = {n: S.REQUIRED_COLUMNS[n] for n in ("branches", "loans", "accounts")}
    report = ingest_all(spark, f"{root}/raw", f"{root}/landing", "2026-01-01", wanted)
    write_manifest(spark, report, f"{root}/manifest")
    read = spark.read.json(f"{root}/manifest")
    ok = F.lit("ok" if report.ok else "not ok")
    return _rows(read, "manifest", F.concat_ws(" ", "source_name", "status", ok), F.col("row_count"))


def _reports(spark: SparkSession, reports: str) -> DataFrame:
    """The checks and the score as JSON, and the failures in the readable scorecard."""
    checks = spark.read.json(f"{reports}/dq_checks")
    score = spark.read.json(f"{reports}/dq_scorecard")
    lines = spark.read.text(f"{reports}/dq_scorecard_txt")
    cell = lambda i: F.trim(F.get(F.split("value", r"\|"), F.lit(i)))
    return reduce(DataFrame.unionByName, [
        _rows(checks, "check", F.col("check_name"), F.col("failed_records")),
        *[_rows(score, "score", F.lit(c), F.col(c)) for c in NUMBERS_OF_A_SCORE],
        _rows(lines.where(F.col("value").rlike(r"^\| \d")), "scorecard line", cell(4), cell(1))])


def run_outputs(spark: SparkSession, raw: RawTables, run: PipelineResult) -> DataFrame:
    """One row per thing that a run leaves: output, item and a number read back from it."""
    extracts = _scratch(spark, "extracts")
    tables = run.warehouse.tables()
    sinks.export_csv(tables, extracts)
    read = [_rows(spark.read.options(**sinks.CSV_DIALECT).csv(f"{extracts}/{name}").agg(F.count(F.lit(1)).alias("n")),
                  "extract", F.lit(name), F.col("n")) for name in tables]
    written = {n: c for n, c in run.counts.items() if n in tables}      # S20, one number a table
    counts = spark.createDataFrame(sorted(written.items()), "item string, n long")
    return reduce(DataFrame.unionByName, [
        _manifest(spark, raw), _reports(spark, f"{run.run_root}/reports"), *read,
        _rows(counts, "rows written", F.col("item"), F.col("n"))])


def quality_log_rerun(spark: SparkSession, log: DataFrame) -> DataFrame:
    """A log whose runs were all put in twice, the first time with other numbers."""
    root = _scratch(spark, "log")
    for row in log.collect():                                           # one row per run
        mine = log.where(F.col("run_id") == row["run_id"])
        sinks.append_dq_log(mine.withColumn("valid_records", F.lit(-1).cast("long")), root)
        sinks.append_dq_log(mine, root)
    return sinks.read_dq_log(spark, root).select(*S.DQ_LOG_COLUMNS)
