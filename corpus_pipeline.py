"""The corpus pipeline: quality rules, line dedup, near-duplicates, benchmark
decontamination, mixing to target weights.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept, written as Parquet and read again in between. All stages but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm.decontaminate import decontaminate
from ledgerline.llm.line_dedup import keep_first_lines
from ledgerline.llm.mixing import mix
from ledgerline.llm.quality_rules import keep_good
from ledgerline.llm.simhash import keep_one_per_group
from ledgerline.llm.staging import stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or the classifier go."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal and similar lines the first stays; emptied documents go."""
    return keep_first_lines(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return keep_one_per_group(docs, shingle=4, max_bits=4)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents selected to the target weights, with the epochs that take them."""
    return mix(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("mixing", mixing),
]

#: No SQL can express the fitted classifier and the hash-based stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
