"""Clustering against plain integer arithmetic."""

import hashlib

import numpy as np
import pytest

from martloom.llm import clusters

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, distance string"


def _brute(rows, count=16, rounds=3, width=64):
    """Rows (vec_id, cluster, distance, cluster_inertia, inertia, centroid) by Python integers."""
    usable = lambda v: v is not None and len(v) == width and all(x is not None and abs(x) < clusters.FAR for x in v)
    kept = [(i, [int(np.floor(64 * float(x))) for x in v]) for i, v in rows if usable(v)]
    first = sorted([(hashlib.sha256(f"1:{i}".encode()).hexdigest(), q) for i, q in kept if i is not None])
    centroids = [list(q) for _, q in first[:count]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(q, c, strict=True)), n) for n, c in enumerate(centroids)) for _, q in kept]

    for _ in range(rounds):
        found = assign()
        for n in {n for _, n in found}:
            own = [q for (_, q), (_, m) in zip(kept, found, strict=True) if m == n]
            centroids[n] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    found = assign()
    inside = {n: sum(d for d, m in found if m == n) for _, n in found}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, n, d, inside[n], sum(inside.values()), digest[n]) for (i, _), (d, n) in zip(kept, found, strict=True)]


def _same(spark, rows):
    df = spark.createDataFrame([(i, v, 0, "x", "y") for i, v in rows], SCHEMA).repartition(3)
    found = [tuple(r) for r in clusters.cluster_digests(df).collect()]
    key = lambda r: (str(r[0]), r[1:])
    assert sorted(found, key=key) == sorted(_brute(rows), key=key)
    return found


def test_odd_rows(spark):
    make = np.random.default_rng(1)
    good = make.standard_normal((40, 64)).astype(np.float32).tolist()
    rows = list(enumerate(good[:30]))
    rows += [(5, good[5]), (5, good[5]), (None, good[31]), (40, None), (41, []), (42, good[32][:63]), (43, [None, *good[33][1:]]), (44, [float("nan")] * 64)]
    rows += [(45, [float("inf")] * 64), (46, [0.0] * 64), (47, [0.0] * 64), (48, [-1e6] * 64), (49, [2e6] * 64), (None, None)]
    assert len(_same(spark, rows)) == 36


def test_one_group_holds_most(spark):
    """Copies, ties between centroids, and clusters that lose all their vectors."""
    make = np.random.default_rng(2)
    base = make.integers(-3, 4, (20, 64)) / 64.0
    rows = [(i, (base[0] if i % 3 else base[i % 20]).tolist()) for i in range(600)]
    _same(spark, rows)


def test_fewer_vectors_than_centroids(spark):
    assert len({r[1] for r in _same(spark, [(i, [float(i)] * 64) for i in range(5)])}) == 5
    assert clusters.cluster_digests(spark.createDataFrame([], SCHEMA)).collect() == []
    assert clusters.cluster_digests(spark.createDataFrame([(None, [1.0] * 64, 0, "x", "y")], SCHEMA)).collect() == []


@pytest.mark.parametrize("spread", [0.01, 1.0, 1000.0])
def test_bounds_never_decide(spread):
    make = np.random.default_rng(3)
    around = make.standard_normal((30, 64)) * spread * 64
    vectors = np.floor(around[make.integers(0, 30, 3000)] + make.standard_normal((3000, 64)) * spread * 8).astype(np.int64)
    rotation = clusters.Rotation(vectors[:500], 64)
    near = clusters.Filter(np.concatenate([vectors[:40], vectors[:5]]), rotation)
    best, distance = near.nearest(vectors, *rotation(vectors))
    every = ((vectors[:, None] - near.centroids) ** 2).sum(axis=2)
    assert (best == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()
    if spread > 0.1:
        assert near.verified < every.size / 3
