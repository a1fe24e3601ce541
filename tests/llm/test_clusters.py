"""Clustering over zone maps against a comparison of every vector with every centroid."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from peernet.llm.clusters import candidates, cluster_vectors, hilbert_keys, nearest
from peernet.llm.topk import fixed_point

LIMIT = (1 << 63) - 1


def by_force(vectors, k, rounds, dimension):
    kept = [(i, [int(x) for x in v]) for i, v in vectors if v is not None and len(v) == dimension and None not in v]
    seeds = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    centroids = [v for _, v in seeds]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        found = assign()
        for c in range(len(centroids)):
            own = [v for (_, v), (_, n) in zip(kept, found, strict=True) if n == c]
            if own:
                centroids[c] = [sum(column) // len(own) for column in zip(*own, strict=True)]
    found = assign()
    inertia = {c: min(sum(d for d, n in found if n == c), LIMIT) for c in range(k)}
    every = min(sum(d for d, _ in found), LIMIT)
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, n, min(d, LIMIT), inertia[n], every, digest[n]) for (i, _), (d, n) in zip(kept, found, strict=True)), key=repr)


def frame(spark, vectors):
    rows = spark.createDataFrame(vectors, "vec_id long, v array<long>")
    return rows.selectExpr("*", "'x' AS key", "1 AS id", "2 AS cluster")


def corpus(rng, n, dimension, reach):
    centres = [[rng.randrange(-reach, reach) for _ in range(dimension)] for _ in range(5)]
    return [(i, [x + rng.randrange(-4, 5) for x in rng.choice(centres)]) for i in range(n)]


@pytest.mark.parametrize("reach", [100, 1 << 30, 1 << 61])
def test_against_every_centroid(spark, reach):
    rng = random.Random(reach)
    vectors = corpus(rng, 400, 4, reach)
    vectors += [(i, [1, 2, 3, 4]) for i in range(400, 600)] + [(7, [1, 2, 3, 4])] * 50  # copies, and one id many times
    vectors += [(None, [5, 5, 5, 5]), (900, None), (901, [1, None, 2, 3]), (902, [1, 2]), (903, []), (904, [LIMIT, -LIMIT - 1, 0, 0])]
    found = cluster_vectors(frame(spark, vectors), "vec_id", "v", k=6, rounds=3, dimension=4, block_rows=16)
    assert sorted(map(tuple, found.collect()), key=repr) == by_force(vectors, 6, 3, 4)


def test_fewer_rows_than_clusters_and_none(spark):
    few = [(1, [1, 1]), (2, [9, 9]), (None, [8, 9])]
    found = cluster_vectors(frame(spark, few), "vec_id", "v", k=16, rounds=2, dimension=2)
    assert sorted(map(tuple, found.collect()), key=repr) == by_force(few, 16, 2, 2)
    for none in ([], [(1, None)], [(None, [1, 1])]):
        found = cluster_vectors(frame(spark, none), "vec_id", "v", k=3, dimension=2)
        assert found.collect() == [] and len(found.columns) == 6


def test_components_that_are_not_finite(spark):
    rows = [(1, [0.5, float("nan")]), (2, [float("inf"), 1.0]), (3, [1.0, None]), (4, [-0.01, 3.0]), (5, [1e300, 0.0])]
    table = spark.createDataFrame(rows, "vec_id long, e array<double>").select("vec_id", fixed_point(F.col("e"), 64).alias("v"))
    found = {r.vec_id: r.distance for r in cluster_vectors(table, "vec_id", "v", k=2, rounds=1, dimension=2).collect()}
    assert found == {4: 0, 5: 0}


def test_curve_visits_neighbours():
    """Every cell of a grid once, each next to the one before."""
    for d, bits in ((2, 4), (3, 3)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * d, indexing="ij"), -1).reshape(-1, d)
        order = sorted(zip(hilbert_keys(cells, bits), cells.tolist(), strict=True))
        assert len({k for k, _ in order}) == len(cells)
        assert all(sum(abs(x - y) for x, y in zip(a, b, strict=True)) == 1 for (_, a), (_, b) in zip(order, order[1:]))


def test_boxes_never_lose_the_nearest_and_refuse_far_ones():
    rng = np.random.default_rng(2)
    refused = 0
    for _ in range(50):
        v, c = rng.integers(-40, 40, (30, 3)) + rng.integers(-200, 200, 3), rng.integers(-200, 200, (12, 3))
        some = candidates(v.min(axis=0).astype(object), v.max(axis=0).astype(object), c.astype(object))
        assert set(nearest(v, c)[0]) <= set(some.tolist())
        refused += len(c) - len(some)
    assert refused > 200
