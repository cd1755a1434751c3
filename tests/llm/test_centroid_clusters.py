import hashlib
import math
from collections import Counter

import numpy as np
import pytest

from tallyloom.llm import centroid_clusters as C


@pytest.mark.parametrize("seed", range(8))
def test_nearest_is_exact(seed):
    """Small numbers give many ties, repeated centroids and vectors that are centroids."""
    rnd = np.random.default_rng(seed)
    k, size, n = int(rnd.integers(1, 30)), int(rnd.integers(1, 9)), 300
    high = int(rnd.integers(2, 40))
    centroids, x = rnd.integers(-high, high, (k, size)), rnd.integers(-high, high, (n, size))
    who, best, asked = C.Lists(centroids).nearest(x)
    exact = np.square(x[:, None] - centroids[None]).sum(axis=2)
    assert who.tolist() == exact.argmin(axis=1).tolist() and best.tolist() == exact.min(axis=1).tolist()
    assert asked <= n * k


def test_walks_end_early():
    rnd = np.random.default_rng(1)
    centroids = rnd.integers(-10_000, 10_000, (200, 2))
    x = centroids[rnd.integers(0, 200, 500)] + rnd.integers(-3, 4, (500, 2))
    _, _, asked = C.Lists(centroids).nearest(x)
    assert asked < 500 * 200 / 20


def by_loops(rows, size, k, rounds, scale, seed):
    kept = [
        (i, [math.floor(scale * x) for x in v])
        for i, v in rows
        if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)
    ]
    named = lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1])
    centroids = [v for _, v in sorted(kept, key=named)[:k]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c, strict=True))
    nearest = lambda v: min((far(v, c), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        own = [[v for _, v in kept if nearest(v)[1] == j] for j in range(len(centroids))]
        centroids = [[sum(c) // len(o) for c in zip(*o, strict=True)] if o else centroids[j] for j, o in enumerate(own)]
    found = [(i, *nearest(v)) for i, v in kept]
    inertia = sum(d for _, d, _ in found)
    return Counter((i, j, d, sum(e for _, e, m in found if m == j), inertia, tuple(centroids[j])) for i, d, j in found)


def fixture(spark):
    rnd = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rnd.normal(size=4).round(2)]) for i in range(150)]
    rows += [(7, rows[7][1])] * 3 + [(None, [0.5, -0.5, 0.25, 0.0])] * 2
    rows += [(900, None), (901, []), (902, [1.0] * 3), (903, [1.0] * 5), (904, [1.0, None, 1.0, 1.0])]
    rows += [(905, [1.0, math.nan, 1.0, 1.0]), (906, [math.inf, 1.0, 1.0, 1.0])]
    wide = [(i, v, "c", 1, 2, 3) for i, v in rows]
    ddl = "vec_id long, embedding array<double>, cluster string, _id int, _vec int, inertia int"
    return rows, spark.createDataFrame(wide, ddl).repartition(3)


@pytest.mark.parametrize("k,rounds", [(1, 1), (5, 0), (5, 3), (8, 10), (500, 2)])
def test_against_loops(spark, k, rounds):
    rows, vectors = fixture(spark)
    found = C.cluster(vectors, size=4, k=k, rounds=rounds, scale=16, seed=3).collect()
    got = Counter((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, tuple(r.centroid)) for r in found)
    assert got == by_loops(rows, 4, k, rounds, 16, 3)


def test_empty_tables_and_large_numbers(spark):
    _, vectors = fixture(spark)
    assert C.cluster(vectors.where("false"), size=4).count() == 0
    assert C.cluster(vectors, size=77).count() == 0
    huge = spark.createDataFrame([(1, [1e300, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="too large"):
        C.cluster(huge, size=2)
