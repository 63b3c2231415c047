"""SimHash near-duplicates through vantage-point trees.

Fingerprints of 64 bits link when they differ in at most ``max_bits`` bits. The
fingerprint is cut into ``max_bits // 2 + 1`` bands, so that two linked
fingerprints differ in at most one bit in some band (pigeonhole). Over each
band stands a vantage-point tree in the Hamming distance of that band:

* every node has a vantage point and a radius; a fingerprint's home is the leaf
  it reaches by its distances to the vantage points;
* as a query it goes down every branch that the triangle inequality can't rule
  out for one bit, so it also visits the shards whose boundary it overlaps;
* in a leaf the exact bit distance of the whole fingerprints decides.

The trees are fitted on at most ``SAMPLE`` fingerprints, every fingerprint is
indexed, and no pair is missed whatever the sample was: the bounds hold for any
tree. A leaf that holds many fingerprints (a group of near copies) is cut into
blocks of data and queries, and each block of the grid is a task's group of
bounded size. A group returns a spanning star instead of all its pairs; a
distributed union-find joins them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.components import connected_components
from ledgerline.llm.staging import free_name, stage

SEED = 42
SAMPLE = 65_536        # fingerprints that the trees are fitted on, at most
LEAF = 1_024           # fingerprints that a leaf should hold
BLOCK = 16_384         # fingerprints on each side of a block of a leaf


def simhash64(text: str | None, shingle: int) -> int:
    """The unsigned fingerprint; words are cut at ASCII blanks, A-Z lower-cased."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    grams = zip(*(words[i:] for i in range(shingle))) if len(words) > shingle else [words]
    hashes = np.fromiter((xxhash.xxh64_intdigest(b" ".join(g), SEED) for g in grams),
                         dtype=np.uint64)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 65_536):
        part = hashes[at:at + 65_536].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprint_column(text: str, shingle: int):
    @F.pandas_udf(T.LongType())
    def fingerprint(texts: pd.Series) -> pd.Series:
        made = np.array([simhash64(t, shingle) for t in texts], dtype=np.uint64)
        return pd.Series(made.view(np.int64))
    return fingerprint(F.col(text))


@dataclass
class VantageTree:
    """A vantage-point tree over one band; nodes in arrays, leaves numbered."""
    shift: int
    mask: int
    point: list[int]
    radius: list[int]
    inner: list[int]      # child with distance <= radius, or -1 - leaf
    outer: list[int]
    leaves: int

    def band(self, prints: np.ndarray) -> np.ndarray:
        return (prints >> np.uint64(self.shift)) & np.uint64(self.mask)

    def visits(self, prints: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
        """(index into prints, leaf) for each leaf that may hold a fingerprint
        within ``reach`` bits in this band; reach 0 gives each one's home."""
        values, found = self.band(prints), []
        todo = [(0 if self.point else -1, np.arange(len(prints)))]
        while todo:
            node, rows = todo.pop()
            if not len(rows):
                continue
            if node < 0:
                found.append((rows, np.full(len(rows), -1 - node, dtype=np.int32)))
                continue
            d = np.bitwise_count(values[rows] ^ np.uint64(self.point[node])).astype(np.int32)
            todo.append((self.inner[node], rows[d - reach <= self.radius[node]]))
            todo.append((self.outer[node], rows[d + reach > self.radius[node]]))
        if not found:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int32)
        return (np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found]))


def fit_tree(sample: np.ndarray, shift: int, width: int, leaf: int) -> VantageTree:
    """Split the sample's band values at the distance nearest the median, from
    the vantage point (of a few tried) whose distances spread the most, until
    ``leaf`` values are left or no distance parts them."""
    tree = VantageTree(shift, (1 << width) - 1, [], [], [], [], 0)
    rng = np.random.default_rng(SEED)

    def grow(values: np.ndarray) -> int:
        best = None
        if len(values) > leaf:
            for point in rng.choice(values, size=min(8, len(values)), replace=False):
                d = np.bitwise_count(values ^ point)
                below = np.cumsum(np.bincount(d, minlength=65))
                radius = int(np.argmin(np.abs(2 * below - len(values))))
                rank = (abs(2 * int(below[radius]) - len(values)), -float(d.var()))
                if 0 < below[radius] < len(values) and (best is None or rank < best[0]):
                    best = (rank, int(point), radius)
        if best is None:
            tree.leaves += 1
            return -tree.leaves
        _, point, radius = best
        node = len(tree.point)
        tree.point.append(point)
        tree.radius.append(radius)
        tree.inner.append(0)
        tree.outer.append(0)
        near = np.bitwise_count(values ^ np.uint64(point)) <= radius
        tree.inner[node] = grow(values[near])
        tree.outer[node] = grow(values[~near])
        return node

    grow(tree.band(sample))
    return tree


def bands(max_bits: int) -> list[tuple[int, int]]:
    """(shift, width) of max_bits // 2 + 1 bands that cover 64 bits."""
    n = max_bits // 2 + 1
    cuts = [round(64 * i / n) for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _links(block: pd.DataFrame, max_bits: int) -> pd.DataFrame:
    """A spanning star for each component of the links between the block's
    queries and its data."""
    prints = block["fp"].to_numpy().view(np.uint64)
    role = block["query"].to_numpy()
    nodes = np.unique(prints)
    data, queries = np.unique(prints[~role]), np.unique(prints[role])
    at = np.searchsorted(nodes, data)
    label = np.arange(len(nodes))
    step = max(1, 1_000_000 // max(1, len(data)))
    for lo in range(0, len(queries), step):
        part = queries[lo:lo + step]
        near = np.bitwise_count(part[:, None] ^ data[None, :]) <= max_bits
        for i in np.flatnonzero(near.any(axis=1)):
            own = label[np.searchsorted(nodes, part[i])]
            met = np.unique(np.append(label[at[near[i]]], own))
            if len(met) > 1:
                label[np.isin(label, met)] = met[0]
    tied = np.flatnonzero(label != np.arange(len(nodes)))
    return pd.DataFrame({"src": nodes[tied].view(np.int64),
                         "dst": nodes[label[tied]].view(np.int64)})


def link_fingerprints(prints: DataFrame, max_bits: int) -> DataFrame:
    """``prints(fp)``, distinct -> spanning edges ``(src, dst)`` of the graph
    that links fingerprints at ``max_bits`` or fewer differing bits."""
    spark = prints.sparkSession
    total = prints.count()
    sample = np.array([r.fp for r in prints.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()],
                      dtype=np.int64).view(np.uint64)
    leaf = max(8, round(LEAF * len(sample) / max(1, total)))
    trees = spark.sparkContext.broadcast(
        [fit_tree(sample, shift, width, leaf) for shift, width in bands(max_bits)])

    def visit(batches):
        for batch in batches:
            fp = batch["fp"].to_numpy()
            for k, tree in enumerate(trees.value):
                for query, reach in ((False, 0), (True, 1)):
                    rows, leaves = tree.visits(fp.view(np.uint64), reach)
                    yield pd.DataFrame({"tree": np.full(len(rows), k, dtype=np.int32),
                                        "leaf": leaves, "query": query, "fp": fp[rows]})

    visits = prints.mapInPandas(visit, "tree int, leaf int, query boolean, fp long")
    # at most SAMPLE leaves a tree, so this table is bounded and can be broadcast
    sizes = (visits.groupBy("tree", "leaf").agg(F.count_if(~F.col("query")).alias("n_data"),
                                                F.count_if("query").alias("n_query"))
             .where("n_data > 0")
             .select("tree", "leaf", F.ceil(F.col("n_data") / BLOCK).cast("int").alias("d"),
                     F.ceil(F.col("n_query") / BLOCK).cast("int").alias("q")))
    sizes = F.broadcast(stage(sizes, "leaf-sizes"))
    own = F.when(F.col("query"), F.pmod(F.xxhash64("fp"), "q")).otherwise(
        F.pmod(F.xxhash64("fp"), "d"))
    others = F.explode(F.sequence(F.lit(0), F.when(F.col("query"), F.col("d"))
                                  .otherwise(F.col("q")) - 1))
    grid = (visits.join(sizes, ["tree", "leaf"])
            .select("tree", "leaf", "query", "fp", own.alias("own"), others.alias("other"))
            .select("tree", "leaf", "query", "fp",
                    F.when(F.col("query"), F.col("other")).otherwise(F.col("own")).alias("a"),
                    F.when(F.col("query"), F.col("own")).otherwise(F.col("other")).alias("b")))
    return (grid.groupBy("tree", "leaf", "a", "b")
            .applyInPandas(lambda block: _links(block, max_bits), "src long, dst long")
            .distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """``(doc_id, fp, component_id)``, one row per row of ``docs``.

    ``component_id`` is the smallest id reachable over links, the own included.
    A null or wordless text has fingerprint zero and links like any other; a
    text of fewer words than a shingle is one shingle. Repeated rows each get
    their row. Rows with a null id keep it; their component is the smallest id
    of the others in it, or null if there is none. An empty table gives no
    rows; other columns of ``docs`` are not looked at.
    """
    return _grouped(docs, id_col, text_col, shingle, max_bits).select("doc_id", "fp", "component_id")


def _grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int, max_bits: int) -> DataFrame:
    """``near_duplicates`` with the column ``component``, the group's least
    fingerprint: two groups may have the same smallest id, if ids clash."""
    rows = stage(docs.select(F.col(id_col).alias("doc_id"),
                             fingerprint_column(text_col, shingle).alias("fp")), "fingerprints")
    prints = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    found = connected_components(link_fingerprints(prints.select("fp"), max_bits))
    label = prints.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("component", "fp").alias("component"), "least")
    least = label.groupBy("component").agg(F.min("least").alias("component_id"))
    return (rows.join(label.join(least, "component").select("fp", "component", "component_id"), "fp")
            .select("doc_id", "fp", "component", "component_id"))


def keep_one_per_group(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """The rows of ``docs`` (all its columns) of which each near-duplicate group
    keeps one: the row with the group's smallest doc_id, then fingerprint. Of
    rows that repeat both one stays, whichever comes first. A doc_id that stands
    on texts of several groups is judged in each. A group whose rows all lack a
    doc_id keeps one row; a null doc_id beside real ones goes."""
    groups = stage(_grouped(docs, "doc_id", "text", shingle, max_bits), "near-duplicates")
    gone = stage(groups.where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct(),
                 "copies")
    # an id of one row says which row is meant; the others go by id and fingerprint
    twice = stage(groups.where("doc_id IS NOT NULL").groupBy("doc_id")
                  .agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id"), "repeated-ids")
    real = docs.where(F.col("doc_id").isNotNull())
    single = real.join(gone, "doc_id", "left_anti").join(twice, "doc_id", "left_anti")
    winners = (groups.where("doc_id <=> component_id").groupBy("component")
               .agg(F.min("doc_id").alias("doc_id"), F.min("fp").alias("fp")))
    own = free_name(docs, "fp")
    unclear = (docs.where(F.col("doc_id").isNull()).select(docs.columns)
               .unionByName(real.join(twice, "doc_id", "left_semi").select(docs.columns))
               .withColumn(own, fingerprint_column("text", shingle)))
    chosen = (unclear.alias("d").join(winners.alias("w"), F.expr(f"d.{own} = w.fp AND d.doc_id <=> w.doc_id"),
                                      "left_semi").dropDuplicates(["doc_id", own]))
    return single.select(docs.columns).unionByName(chosen.select(docs.columns))
