"""Centroid clustering: bounds that hold, exact distances, and the cases of odd vectors."""

import hashlib
import random

import numpy as np
import pytest

from ensemblescore.llm import clustering

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k, rounds, dimensions):
    """Plain Python over (id, vector) rows, in whole numbers."""
    kept = [(i, [int(np.floor(np.float64(np.float32(x)) * 64)) for x in v]) for i, v in rows
            if v is not None and len(v) == dimensions and all(x is not None and np.isfinite(x) for x in v)]
    digest = {i: hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest() for i, _ in kept}
    centroids = [v for _, v in sorted(kept, key=lambda r: (digest[r[0]], r[1]))[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        found = assign()
        centroids = [[sum(col) // len(own) for col in zip(*own)] if (own := [
            v for (_, v), (_, n) in zip(kept, found) if n == c]) else old for c, old in enumerate(centroids)]
    found = assign()
    inertia = {}
    for d, n in found:
        inertia[n] = inertia.get(n, 0) + d
    return sorted(((i, n, d, inertia[n], sum(inertia.values()), tuple(centroids[n]))
                   for (i, _), (d, n) in zip(kept, found)), key=repr)


def got(df):
    return sorted(((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, tuple(r.centroid))
                   for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_clusters_are_those_of_brute_force(spark, seed):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    rows = [(i, [float(np.float32(c + rng.gauss(0, 0.2))) for c in rng.choice(centres)]) for i in range(300)]
    rows += rows[:20] + [(900 + i, rows[0][1]) for i in range(60)]  # copies, under their own ids and under others
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for k, rounds in ((7, 3), (1, 2), (400, 1)):
        assert got(clustering.cluster(df, centroids=k, rounds=rounds, dimensions=6)) == brute(rows, k, rounds, 6)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (2, None), (3, [1.0]), (4, [nan, 1.0]), (5, [inf, 0.0]), (6, [None, 0.0]), (None, [0.5, -0.01]),
            (None, [0.25, 0.0]), (7, [-0.0, 1e-30]), (8, [1.0, 2.0, 3.0]), (1, [1.0, 2.0]), (9, [])]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr(
        "vec_id", "embedding", "1 AS cluster", "2 AS ints", "3 AS `a.b`", "map(1, 2) AS m", "4 AS distance").toDF(
        "vec_id", "embedding", "cluster", "ints", "a.b", "m", "a.b")
    assert got(clustering.cluster(df, centroids=3, dimensions=2)) == brute(rows, 3, 3, 2)
    empty = clustering.cluster(df.where("false"), dimensions=2)
    assert empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"] and empty.isEmpty()
    far = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1e30, 0.0])], SCHEMA)
    with pytest.raises(Exception, match="is beyond"):
        clustering.cluster(far, dimensions=2).collect()


@pytest.mark.parametrize("n, dimensions", [(1, 4), (2, 3), (8, 2), (12, 16), (9, 64)])
def test_bounds_hold_and_spare_distances(n, dimensions):
    rng = np.random.default_rng(n)
    candidates = rng.integers(-500, 500, (n, dimensions))
    rows = np.vstack([rng.integers(-500, 500, (200, dimensions)), candidates, candidates[:1] + 1,
                      rng.integers(-1 << 26, 1 << 26, (20, dimensions))])
    simplex = clustering.Simplex(candidates.tolist())
    squared = simplex.distances(rows)
    apexes, slack = simplex.apexes(squared), simplex.slack(squared)
    low, high = clustering.bounds(apexes, simplex.apexes(simplex.distances(candidates)))
    exact = np.array([[((r - c) ** 2).sum() for c in candidates] for r in rows], np.float64)
    room = np.maximum(slack[:, None], 1e-9 * exact)
    assert (low <= exact + room).all() and (high >= exact - room).all()
    cluster, best, computed = clustering.nearest(rows, apexes, candidates, simplex.apexes(simplex.distances(candidates)), slack)
    assert (best == exact.min(axis=1)).all() and (cluster == exact.argmin(axis=1)).all()
    assert computed <= exact.size


def test_most_distances_are_spared_on_clustered_vectors():
    rng = np.random.default_rng(1)
    centres = rng.integers(-2000, 2000, (16, 64))
    rows = centres[rng.integers(0, 16, 2000)] + rng.integers(-60, 60, (2000, 64))
    simplex = clustering.Simplex(centres.tolist())
    squared = simplex.distances(rows)
    of = simplex.apexes(simplex.distances(centres))
    assert clustering.nearest(rows, simplex.apexes(squared), centres, of, simplex.slack(squared))[2] < 0.4 * 16 * 2000
