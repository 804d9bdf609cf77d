"""Clustering against plain Lloyd rounds, and the threshold walk against all distances."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from courtview.llm import centroid_clustering as cc

SCHEMA = "vec_id long, embedding array<double>, label int, id long, cluster string, distance string, mat string"


def plain(rows, k, rounds, dim, scale=1024.0):
    """(vec_id, cluster, distance) of each kept row and the final centroids."""
    kept = []
    for vec_id, vec, *_ in rows:
        if vec is not None and len(vec) == dim and all(x is not None and math.isfinite(x) and math.isfinite(scale * x) for x in vec):
            kept.append((vec_id, [math.floor(scale * x) for x in vec]))
    seeds = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[0] or 0, r[1]))[:k]
    cents = [list(v) for _, v in seeds]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), i) for i, c in enumerate(cents))
    for _ in range(rounds):
        sets = [[] for _ in cents]
        for _, v in kept:
            sets[near(v)[1]].append(v)
        cents = [[sum(x) // len(s) for x in zip(*s, strict=True)] if s else c for s, c in zip(sets, cents, strict=True)]
    return sorted(((i, near(v)[1], min(near(v)[0], (1 << 63) - 1)) for i, v in kept), key=str), cents


def check(spark, rows, k=4, rounds=5, dim=4, **more):
    rows = [(i, v and [x if x is None else float(x) for x in v]) for i, v in rows]
    df = spark.createDataFrame([(i, v, 1, 7, "x", "y", "z") for i, v in rows], SCHEMA).repartition(3)
    found, cents = cc.cluster_vectors(df, k=k, rounds=rounds, dim=dim, **more)
    want, want_cents = plain(rows, k, rounds, dim)
    assert sorted((tuple(r) for r in found.collect()), key=str) == want
    assert cents == want_cents
    return found, cents


def test_rounds_equal_a_plain_version(spark):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(4)]) for i in range(300)]
    rows += [(3, rows[3][1]), (3, rows[4][1]), (None, [0.5] * 4), (None, [0.5] * 4)]  # repeated rows, repeated and null ids
    rows += [(900, None), (901, []), (902, [0.1] * 3), (903, [0.1] * 5), (904, [0.1, None, 0.2, 0.3]), (905, [0.1, math.nan, 0, 0]), (906, [math.inf, 0, 0, 0])]
    found, cents = check(spark, rows, block_rows=7)
    out = {r.vec_id: r for r in cc.clusters_with_inertia(found, cents).collect()}
    by = found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()
    assert {r.cluster: r.s for r in by} == {r.cluster: r.cluster_inertia for r in out.values()}
    assert {r.inertia for r in out.values()} == {sum(r.s for r in by)}
    assert all(r.centroid_sha256 == hashlib.sha256(",".join(map(str, cents[r.cluster])).encode()).hexdigest() for r in out.values())


def test_ties_empty_clusters_and_few_vectors(spark):
    check(spark, [(i, [0.25, -0.25, 0.0, 1.0]) for i in range(20)])  # all equal: clusters 1 to 3 stay empty
    check(spark, [(1, [0.5] * 4), (2, [-0.5] * 4)])  # fewer vectors than centroids
    check(spark, [(i, [float(i % 2), 0.0, 0.0, 0.0]) for i in range(40)], k=5)


def test_components_beyond_64_bits(spark):
    check(spark, [(i, [(-1) ** i * 3e30 * i, 1e-30, -3e38, float(i)]) for i in range(12)], k=3)
    check(spark, [(1, [1e308, 0, 0, 0]), (2, [1e10, 0, 0, 0]), (3, [-1e10, 0.1, 0, 0])], k=2)  # the first overflows when scaled


def test_no_vectors(spark):
    found, cents = cc.cluster_vectors(spark.createDataFrame([], SCHEMA))
    assert cents == [] and cc.clusters_with_inertia(found, cents).count() == 0


@pytest.mark.parametrize("spread", [2, 50, 100_000])
def test_threshold_walk_finds_the_nearest(spread):
    rng = np.random.default_rng(spread)
    for k, dim in ((1, 3), (5, 1), (40, 2), (9, 16)):
        v, c = rng.integers(-spread, spread, (200, dim)), rng.integers(-spread, spread, (k, dim))
        nearest, best = cc.threshold_nearest(v, c)
        every = ((v[:, None] - c[None]) ** 2).sum(2)
        assert (nearest == every.argmin(1)).all() and (best == every.min(1)).all()
