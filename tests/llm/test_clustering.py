import hashlib
import math

import numpy as np
import pytest

from tokenloom.llm.clustering import Model, approach, cluster_vectors, clustering_report

SCHEMA = "vec_id bigint, embedding array<double>"


def lloyd(rows, k, rounds, seed, dim, scale):
    """All distances in every round, in Python integers: vectors with their cluster and distance, centroids."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "g", r[1]))
    centroids = [v for _, v in order[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        held = [[] for _ in centroids]
        for _, v in kept:
            held[near(v)[1]].append(v)
        centroids = [[sum(xs) // len(h) for xs in zip(*h)] if h else c for h, c in zip(held, centroids)]
    return [(i, near(v)[1], near(v)[0]) for i, v in kept], centroids


def blobs(n, dim, centres, spread, seed):
    random = np.random.default_rng(seed)
    at = random.normal(size=(centres, dim)) * 2
    return [(i, (at[i % centres] + random.normal(size=dim) * spread).tolist()) for i in range(n)]


def found(spark, rows, **options):
    out = cluster_vectors(spark.createDataFrame(rows, SCHEMA).repartition(3), **options)
    return sorted(map(tuple, out.rows.collect()), key=repr), out.centroids


@pytest.mark.parametrize("stale", [1, 8, 10**9])
@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_equals_plain_rounds(spark, stale, spread):
    """Whether bounds are written always or hardly ever."""
    rows = blobs(300, 5, 6, spread, 1)
    want, centroids = lloyd(rows, 6, 6, 3, 5, 100)
    assert found(spark, rows, k=6, rounds=6, dim=5, scale=100, stale=stale) == (sorted(want, key=repr), centroids)


def test_ties_repeats_and_unusable_vectors(spark):
    grid = [(i, [float(i % 3), float(i % 2)]) for i in range(40)]
    rows = grid + grid[:5] + [(None, [1.0, 1.0]), (90, None), (91, [1.0]), (92, [1.0, None]), (93, [1.0, float("nan")]), (94, [1.0, float("inf")]), (95, [1.0, 2.0, 3.0])]
    want, centroids = lloyd(rows, 4, 5, 3, 2, 1)
    assert found(spark, rows, k=4, rounds=5, dim=2, scale=1) == (sorted(want, key=repr), centroids)


def test_few_large_and_no_vectors(spark):
    rows = [(1, [1.0e6, -2.0e6]), (2, [1.0e6, 2.0]), (3, [-1.0, 0.5])]
    want, centroids = lloyd(rows, 8, 3, 3, 2, 1024)
    assert found(spark, rows, k=8, rounds=3, dim=2) == (sorted(want, key=repr), centroids)
    assert found(spark, [(1, None)], dim=2) == ([], [])
    assert clustering_report(spark.createDataFrame([], SCHEMA)).count() == 0
    with pytest.raises(Exception, match="component too large in vector 7"):
        found(spark, [(7, [1e30, 0.0])], dim=2)


def test_spheres_bound_what_comes_nearer():
    """No point of the sphere gains more than the bound, and the bound is mostly below the drift."""
    random = np.random.default_rng(5)
    below = 0
    for _ in range(300):
        dim = int(random.integers(2, 6))
        old, centre = random.normal(size=(3, dim)) * 3, random.normal(size=dim) * 3
        new = old + random.normal(size=(3, dim)) * random.choice([0.01, 1.0])
        radius = float(random.random() * 3)
        points = random.normal(size=(400, dim))
        points = centre + points / np.linalg.norm(points, axis=1, keepdims=True) * radius * random.random((400, 1)) ** 0.2
        bound = approach(old, new, centre, radius)
        gain = np.linalg.norm(points[:, None] - old, axis=2) - np.linalg.norm(points[:, None] - new, axis=2)
        assert (gain.max(axis=0) <= bound + 1e-12).all()
        drift = np.linalg.norm(new - old, axis=1)
        assert (bound <= drift).all()
        below += int((bound < 0.9 * drift).sum())
    assert below > 300
    still = Model.since(np.zeros((2, 2), np.int64), np.ones(2), np.zeros((2, 2), np.int64))
    assert not still.drift.any() and not still.looser.any()


def test_report(spark):
    rows = blobs(120, 64, 5, 0.3, 2)
    want, centroids = lloyd(rows, 8, 10, 3, 64, 1024)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as cluster", "vec_id as distance", "'x' as id")
    got = {r.vec_id: r for r in clustering_report(df).collect()}
    for i, cluster, distance in want:
        row = got[i]
        assert (row.cluster, row.distance) == (cluster, distance)
        assert row.cluster_inertia == sum(d for _, c, d in want if c == cluster)
        assert row.inertia == sum(d for _, _, d in want)
        assert row.centroid_sha256 == hashlib.sha256(",".join(map(str, centroids[cluster])).encode()).hexdigest()
    assert len(got) == len(want)
