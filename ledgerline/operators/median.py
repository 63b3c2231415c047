"""Exact medians as one DataFrame plan (P8), the same at every size.

``percentile(c, 0.5)`` is exact but merges a value->count map of *every*
distinct value into one task; ``percentile_approx`` is bounded but not exact.
Here values are counted (combined map-side, so a value that a third of the rows
have is one row), the distinct values are laid out in order over many
partitions and written, and only the one or two partitions in which the middle
ranks fall are looked into. Several columns share the pass.

The median of ``n`` values is ``(v[(n-1)//2] + v[n//2]) / 2`` over the sorted
non-NULL values (0-based ranks), i.e. the usual linear interpolation at 0.5.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.sources.sinks import staged


def exact_median(df: DataFrame, column: str) -> float | None:
    return exact_medians(df, [column])[column]


def exact_medians(df: DataFrame, columns: list[str]) -> dict[str, float | None]:
    """One value per column, None where it has no value. NULL and NaN don't count."""
    pairs = F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).cast("double").alias("v"))
                      for c in columns])
    counted = (df.select(F.explode(pairs).alias("p")).select("p.*")
               .where(F.col("v").isNotNull() & ~F.isnan("v")).groupBy("col", "v")
               .agg(F.count(F.lit(1)).alias("n")))
    laid = staged(counted.repartitionByRange("col", "v")
                  .withColumn("part", F.spark_partition_id()), "median-values")
    column = Window.partitionBy("col")
    parts = (laid.groupBy("col", "part").agg(F.sum("n").alias("n"))
             .withColumn("upto", F.sum("n").over(column.orderBy("part")))
             .withColumn("total", F.sum("n").over(column))
             .withColumn("k1", F.expr("(total - 1) DIV 2")).withColumn("k2", F.expr("total DIV 2"))
             # the partitions that hold the ranks k1 and k2: two at most
             .where("upto - n <= k2 AND k1 < upto")
             .select("col", "part", (F.col("upto") - F.col("n")).alias("before"), "k1", "k2"))
    inside = (laid.join(F.broadcast(parts), ["col", "part"])
              .withColumn("upto", F.col("before") + F.sum("n").over(
                  Window.partitionBy("col", "part").orderBy("v"))))
    at = lambda k: F.max(F.when((F.col("upto") - F.col("n") <= F.col(k))
                                & (F.col(k) < F.col("upto")), F.col("v")))
    rows = inside.groupBy("col").agg(((at("k1") + at("k2")) / 2).alias("median")).collect()
    found = {r["col"]: r["median"] for r in rows}          # one row per column
    return {c: found.get(c) for c in columns}
