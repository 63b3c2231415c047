"""Progressive search against all distances, and the defined cases. SQL: test_llm_oracle."""
import hashlib

import numpy as np
import pytest

from ledgerline.llm import centroids as CE

SCHEMA = "vec_id long, embedding array<double>"


def all_distances(v, c):
    return ((v[:, None, :].astype(object) - c[None, :, :].astype(object)) ** 2).sum(axis=2)


@pytest.mark.parametrize("spread, dim_bits", [(1, 1), (300, 10), (2 ** 24 - 1, 24)])
def test_nearest_is_exact_and_ties_go_to_the_smaller_number(spread, dim_bits):
    rng = np.random.default_rng(dim_bits)
    v = rng.integers(-spread, spread + 1, (500, 64))
    c = rng.integers(-spread, spread + 1, (8, 64))
    c[5] = c[2]                                         # equal centroids
    v[0] = c[5]
    c[7], v[1] = -spread, spread                        # the largest distance
    cluster, distance, looked = CE.nearest(v, c)
    full = all_distances(v, c)
    assert (cluster == full.argmin(axis=1)).all() and (distance == full.min(axis=1)).all()
    assert cluster[0] == 2 and distance[0] == 0 and looked <= 500 * 8 * 64


def test_transform_keeps_distances_and_starts_coarse():
    rng = np.random.default_rng(3)
    x = rng.integers(-1000, 1000, (20, 64))
    t = CE.transform(x)
    assert ((t ** 2).sum(axis=1) == 64 * (x ** 2).sum(axis=1)).all()
    assert (t[:, 0] == x.sum(axis=1)).all()


def test_far_centroids_are_dropped_early():
    rng = np.random.default_rng(4)
    c = np.arange(8)[:, None] * 1000 + np.zeros((8, 64), dtype=np.int64)
    v = c[rng.integers(0, 8, 400)] + rng.integers(-20, 20, (400, 64))
    assert CE.nearest(v, c)[2] < 400 * 8 * 64 / 3


def plain(rows, k=8, rounds=10, seed=3):
    kept = [(i, np.floor(np.array(v, dtype=float) * 1024).astype(int)) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) and abs(x) < 16384 for x in v)]
    seeds = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(),
                                        r[1].tolist()))[:k]
    c = np.array([v for _, v in seeds])
    v = np.array([x for _, x in kept])
    for _ in range(rounds):
        near = all_distances(v, c).argmin(axis=1)
        c = np.array([v[near == i].sum(axis=0) // (near == i).sum() if (near == i).any() else c[i]
                      for i in range(len(c))])
    d = all_distances(v, c)
    near = d.argmin(axis=1)
    own = d.min(axis=1)
    return sorted(((i, int(a), int(x), int(own[near == a].sum()), int(own.sum()),
                    hashlib.sha256(",".join(map(str, c[a])).encode()).hexdigest())
                   for (i, _), a, x in zip(kept, near, own)), key=str)


def clustered(spark, rows, schema=SCHEMA, **kw):
    return sorted((tuple(r) for r in CE.cluster(spark.createDataFrame(rows, schema), **kw)[0].collect()), key=str)


def test_against_plain_rounds_with_unusable_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=64) + 3 * (i % 4)).tolist()) for i in range(120)]
    rows += [(7, rows[7][1]), (None, rows[3][1]), (200, None), (201, []), (202, [1.0] * 63), (203, [None] + [1.0] * 63),
             (204, [float("nan")] * 64), (205, [float("inf")] + [0.0] * 63), (206, [16384.0] + [0.0] * 63),
             (207, [1e308] * 64), (208, [-16383.9] * 64)]
    got = clustered(spark, rows)
    assert got == plain(rows) and len(got) == 123


def test_few_equal_and_no_vectors(spark):
    few = [(i, [float(i)] * 64) for i in range(3)]
    assert clustered(spark, few) == plain(few)
    same = [(i, [0.5] * 64) for i in range(20)]              # all ties: everything in cluster 0
    assert clustered(spark, same) == plain(same) and {r[1] for r in clustered(spark, same)} == {0}
    assert clustered(spark, []) == [] and clustered(spark, [(1, [1.0])]) == []


def test_clashing_columns(spark):
    rows = [(i, [float(i % 5)] * 64, 9, "x", 1) for i in range(30)]
    names = SCHEMA + ", cluster int, v string, distance int"
    assert clustered(spark, rows, names) == plain([r[:2] for r in rows])
