"""Centroid clustering: nearest centroids by a progressive search over Walsh-Hadamard coefficients.

Vectors become integers, so everything is exact. The Walsh-Hadamard transform is
integer too and keeps distances up to a factor of 64: the squared differences of
the 64 coefficients add up to 64 times the squared distance. Coefficients are
taken coarse to fine (by the number of sign changes of their row), and each
partial sum is a lower bound. After the first block the centroid with the
smallest sum is finished; a centroid whose partial sum is strictly above the best
finished one can't win nor tie and is dropped; those left over get all 64.

A round is one Spark job over the written integer vectors: tasks assign in Arrow
batches and send a count and 64 sums per centroid and batch, which are added up by
centroid. Only the centroids (at most ``k`` times 64 integers) come to the driver.

Defined cases: a vector counts only if it has exactly 64 components, none null, not a
number or infinite; others give no row. Nor do vectors with a component of 16,384 or
more in magnitude: a squared distance between those may not fit the LONG that 64 of its
multiples are summed in (stated, not silent: ``usable`` says which). With fewer than ``k``
vectors there are as many centroids; without any, no rows. Equal hashes (a repeated
vec_id) are ordered by their vectors; vectors without a vec_id come last as seeds. Equal
distances go to the smaller centroid number. A sum over a cluster that is no LONG any
more is null. Columns other than the id and the vector are neither read nor returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.staging import stage

DIMENSIONS = 64
SCALE = 1024
#: Integers stay below 2^24, so 64 times a squared distance stays below 2^62.
LARGEST = 2.0 ** 24
#: Coefficients looked at before the first, second, ... elimination.
BLOCKS = (4, 8, 16, 32, 64)


def usable(vector: Column) -> Column:
    """64 finite components, none null, none beyond the range that LONG sums allow."""
    sound = lambda x: x.isNotNull() & (F.abs(x.cast("double") * SCALE) < LARGEST)
    return F.coalesce((F.size(vector) == DIMENSIONS) & F.forall(vector, lambda x: F.coalesce(sound(x), F.lit(False))),
                      F.lit(False))


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(vec_id, v)`` of the usable vectors; v holds floor(1024 * x)."""
    v = F.transform(F.col(vector_col), lambda x: F.floor(x.cast("double") * SCALE).cast("int"))
    return vectors.where(usable(F.col(vector_col))).select(F.col(id_col).alias("vec_id"), v.alias("v"))


def seeds(ints: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors with the smallest hashes of ``<seed>:<vec_id>``, in that order."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = ints.select(key.alias("key"), "v").orderBy(F.col("key").asc_nulls_last(), "v").limit(k).collect()
    return np.array([r["v"] for r in rows], dtype=np.int64).reshape(len(rows), DIMENSIONS)


def transform(x: np.ndarray) -> np.ndarray:
    """Integer Walsh-Hadamard transform of the rows, coefficients coarse to fine."""
    out = np.asarray(x, dtype=np.int64)
    n, half = out.shape[0], 1
    while half < DIMENSIONS:
        pairs = out.reshape(n, DIMENSIONS // (2 * half), 2, half)
        left, right = pairs[:, :, 0], pairs[:, :, 1]
        out = np.stack([left + right, left - right], axis=2).reshape(n, DIMENSIONS)
        half *= 2
    return out[:, _coarse_to_fine()]


def _coarse_to_fine() -> np.ndarray:
    """Rows of the transform by their number of sign changes."""
    index = np.arange(DIMENSIONS)
    signs = np.array([[bin(i & j).count("1") & 1 for j in index] for i in index])
    return np.argsort((signs[:, 1:] != signs[:, :-1]).sum(axis=1), kind="stable")


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Per row the nearest centroid (ties: the smaller number) and the squared distance,
    and how many coefficient differences were looked at."""
    n, k = len(vectors), len(centroids)
    a, c = transform(vectors), transform(centroids)
    part = np.zeros((n, k), dtype=np.int64)
    done = np.zeros((n, k), dtype=np.int64)            # coefficients in each partial sum
    alive = np.ones((n, k), dtype=bool)
    looked = 0

    def add(rows: np.ndarray, cents: np.ndarray, start: int, end: int) -> None:
        nonlocal looked
        part[rows, cents] += ((a[rows, start:end] - c[cents, start:end]) ** 2).sum(axis=1)
        done[rows, cents] = end
        looked += len(rows) * (end - start)

    everyone = np.arange(n)
    bound, start = None, 0
    for end in BLOCKS:
        rows, cents = np.nonzero(alive & (done < end))
        add(rows, cents, start, end)
        if bound is None:                               # finish the most promising one
            first = part.argmin(axis=1)
            add(everyone, first, end, DIMENSIONS)
            bound = part[everyone, first]
        alive &= part <= bound[:, None]                 # strictly worse ones go
        start = end
    distance = np.where(alive, part, np.iinfo(np.int64).max)
    cluster = distance.argmin(axis=1)                   # the first of equal ones
    return cluster.astype(np.int32), distance[everyone, cluster] // DIMENSIONS, looked


ROWS_AT_ONCE = 4096


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            some = batch.slice(at, ROWS_AT_ONCE)
            v = some.column(some.schema.get_field_index("v")).flatten().to_numpy(zero_copy_only=False)
            yield some, v.reshape(some.num_rows, DIMENSIONS).astype(np.int64)


def _sums(ints: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Per centroid that has vectors: their count and componentwise sums."""
    k = len(centroids)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(k, dtype=np.int64), np.zeros((k, DIMENSIONS), dtype=np.int64)
        for _, v in _batches(batches):
            cluster = nearest(v, centroids)[0]
            count += np.bincount(cluster, minlength=k)
            for i in np.unique(cluster):
                total[i] += v[cluster == i].sum(axis=0)
        has = np.nonzero(count)[0]
        yield pa.RecordBatch.from_pydict({
            "cluster": pa.array(has.astype(np.int32)), "n": pa.array(count[has]),
            **{f"s{j}": pa.array(total[has, j]) for j in range(DIMENSIONS)}})

    names = [f"s{j}" for j in range(DIMENSIONS)]
    schema = "cluster int, n long, " + ", ".join(f"{s} long" for s in names)
    return ints.select("v").mapInArrow(add_up, schema).groupBy("cluster").agg(
        F.sum("n").alias("n"), *[F.sum(s).alias(s) for s in names])


def _next_centroids(ints: DataFrame, centroids: np.ndarray) -> np.ndarray:
    moved = centroids.copy()
    for row in _sums(ints, centroids).collect():        # one row per centroid
        moved[row["cluster"]] = [row[f"s{j}"] // row["n"] for j in range(DIMENSIONS)]
    return moved


def _assigned(ints: DataFrame, centroids: np.ndarray) -> DataFrame:
    id_type = ints.schema["vec_id"].dataType.simpleString()

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, v in _batches(batches):
            cluster, distance, _ = nearest(v, centroids)
            ids = batch.column(batch.schema.get_field_index("vec_id"))
            yield pa.RecordBatch.from_arrays([ids, pa.array(cluster), pa.array(distance)],
                                             ["vec_id", "cluster", "distance"])

    return ints.mapInArrow(assign, f"vec_id {id_type}, cluster int, distance long")


def cluster(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 8,
            rounds: int = 10, seed: int = 3) -> tuple[DataFrame, np.ndarray]:
    """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` per usable
    vector after ``rounds`` rounds, and the final centroids."""
    spark = vectors.sparkSession
    ints = stage(integer_vectors(vectors, id_col, vector_col), "integer-vectors")
    centroids = seeds(ints, k, seed)
    for _ in range(rounds if len(centroids) else 0):
        centroids = _next_centroids(ints, centroids)
    if not len(centroids):
        return ints.select("vec_id", *[F.lit(None).cast(t).alias(c) for c, t in RESULT.items()]), centroids
    assigned = stage(_assigned(ints, centroids), "assigned")
    inertia = {r["cluster"]: int(r["d"]) for r in assigned.groupBy("cluster").agg(      # k rows at most
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    per_cluster = [(i, _as_long(inertia.get(i, 0)), _as_long(sum(inertia.values())),
                    hashlib.sha256(",".join(map(str, row)).encode()).hexdigest())
                   for i, row in enumerate(centroids.tolist())]
    known = spark.createDataFrame(per_cluster, "cluster int, cluster_inertia long, inertia long, "
                                               "centroid_sha256 string")
    return assigned.join(F.broadcast(known), "cluster").select("vec_id", *RESULT), centroids


RESULT = {"cluster": "int", "distance": "long", "cluster_inertia": "long", "inertia": "long",
          "centroid_sha256": "string"}


def _as_long(n: int) -> int | None:
    return n if n < 2 ** 63 else None
