"""Written tables that cut lineage, in the folder all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ledgerline.session import ensure_checkpoint_dir


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh path under ``spark.checkpoint.dir``; nothing is created yet."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write once as Parquet in the shared folder and read it back.

    The result survives lost executors, is not computed twice when it is used
    twice, and Spark knows its size when it picks a join.
    """
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, base: str) -> str:
    """``base``, or ``base_1``, ... : a column name that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    name, k = base, 0
    while name.lower() in taken:
        k += 1
        name = f"{base}_{k}"
    return name
