"""Commit records: what a reader of a folder may see.

A run writes its data into a folder of its own, which nobody reads yet. When all of it is
there, one small record is appended that says so. Readers follow the newest record of a key,
so while a run replaces an earlier one they see the old data or the new, never none or half; a
driver that is lost before its record leaves the old data in force. Nothing is renamed or
deleted: folders that no newest record names can be removed once no reader uses them.

A record is one Parquet file of one row. Spark's committer moves the finished file into
place in one step. Records of a key count up (``_seq``); two writers that take the same
number are told apart by ``_commit``, so all readers follow the same one.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _records(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.option("mergeSchema", True).parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None             # no record yet
        raise


def commit(record: DataFrame, path: str, key: list[str]) -> None:
    """Put a record of one row into force: it replaces the one with its key."""
    spark = record.sparkSession
    known = _records(spark, path)
    last = F.lit(0).cast("long")
    if known is not None:
        mine = record.first()
        same = known
        for c in key:
            same = same.where(F.col(c).eqNullSafe(F.lit(mine[c])))
        last = F.lit(same.agg(F.coalesce(F.max("_seq"), F.lit(0))).first()[0]).cast("long")
    (record.withColumn("_seq", last + 1).withColumn("_commit", F.lit(uuid.uuid4().hex))
     .coalesce(1).write.mode("append").parquet(path))


def in_force(spark: SparkSession, path: str, key: list[str]) -> DataFrame | None:
    """The newest record of each key, without the counters; None before the first commit."""
    known = _records(spark, path)
    if known is None:
        return None
    w = Window.partitionBy(*key).orderBy(F.col("_seq").desc(), F.col("_commit").desc())
    return (known.withColumn("_rank", F.row_number().over(w)).where("_rank = 1")
            .drop("_rank", "_seq", "_commit"))
