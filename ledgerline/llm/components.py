"""Distributed union-find: connected components of an edge table.

Large-star / small-star rounds (Kiveris et al., "Connected Components in
MapReduce and Beyond", 2014) written as joins and grouped minima. The edges of
a hub are combined map-side before they are shuffled, and the join that sends a
hub its minimum is a plain join which AQE splits. Each round is checkpointed in
the shared folder, so the lineage stays short and a lost executor costs a
partial recomputation of one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.session import ensure_checkpoint_dir


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(src, dst)`` of any one orderable type -> ``(node, component)``.

    ``component`` is the smallest node reachable. Every node of an edge gets a
    row; loops and edges with a null end say nothing and are left out, so a node
    that only has such edges gets no row. No edges: no rows.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    pairs = (edges.where(F.col("src") != F.col("dst"))
             .select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"))
             .distinct().checkpoint())
    mark = _mark(pairs)
    while mark[0]:
        pairs = _small_star(_large_star(pairs)).checkpoint()
        before, mark = mark, _mark(pairs)
        if mark == before:
            break
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _mark(pairs: DataFrame) -> tuple:
    """Row count and an order-free checksum: equal when a round changed nothing."""
    return tuple(pairs.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")),
                           F.bit_xor(F.xxhash64("v", "u"))).first())


def _large_star(pairs: DataFrame) -> DataFrame:
    """Each node ties its larger neighbours to the smallest of its neighbourhood."""
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = (both.groupBy("u").agg(F.min("v").alias("m"))
             .select("u", F.least("u", "m").alias("m")))
    return (both.where(F.col("v") > F.col("u")).join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(pairs: DataFrame) -> DataFrame:
    """Each node ties its smaller neighbours and itself to the smallest of them."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    ends = F.explode(F.array(F.col("v"), F.col("u")))
    return (pairs.join(least, "u").select(ends.alias("e"), "m")
            .where(F.col("e") != F.col("m"))
            .select(F.col("e").alias("u"), F.col("m").alias("v")).distinct())
