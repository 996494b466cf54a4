"""Clustering against plain Lloyd rounds in Python integers."""
import hashlib
import math

import numpy as np
import pytest

from factorspark.llm import clustering

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, _key int"


def plain(rows, k, rounds, scale=256, dims=8):
    kept = [(i, [math.floor(scale * float(np.float32(c))) for c in v]) for i, v, *_ in rows
            if v is not None and len(v) == dims and all(c is not None and math.isfinite(c) for c in v)]
    order = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), x) for i, x in kept if i is not None)
    cents = [x for _, x in order[:k]]

    def near(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(cents))
    for _ in range(rounds):
        of = [near(x)[1] for _, x in kept]
        for j in range(len(cents)):
            mine = [x for (_, x), c in zip(kept, of) if c == j]
            if mine:
                cents[j] = [sum(col) // len(mine) for col in zip(*mine)]
    last = [(i, *near(x)[::-1]) for i, x in kept]
    each = {j: sum(d for _, c, d in last if c == j) for j in range(len(cents))}
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted(((i, c, d, each[c], sum(each.values()), shas[c]) for i, c, d in last), key=repr)


def vectors(seed=1, n=400, dims=8):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(6, dims))
    rows = [(i, [float(x) for x in centers[i % 6] + rng.normal(scale=0.2, size=dims)], 0, "x", 1) for i in range(n)]
    rows += [(n + i, rows[3][1], 0, "x", 1) for i in range(120)]  # copies
    rows += [(n + 200 + i, [float(x) for x in np.round(rng.normal(size=dims))], 0, "x", 1) for i in range(80)]  # ties
    odd = [(9000, None), (9001, []), (9002, [1.0] * (dims - 1)), (9003, [None] + [1.0] * (dims - 1)), (9004, [math.nan] * dims), (9005, [math.inf] * dims),
           (None, [0.1] * dims), (None, [0.2] * dims), (7, [0.3] * dims), (7, [0.3] * dims)]
    return rows + [(i, v, 0, "x", 1) for i, v in odd]


@pytest.mark.parametrize("k, rounds, block", [(12, 5, 64), (1, 2, 4096), (40, 0, 100), (700, 2, 4096)])
def test_clusters_equal_plain_rounds(spark, k, rounds, block):
    rows = vectors()
    got = clustering.cluster(spark.createDataFrame(rows, SCHEMA), k=k, rounds=rounds, dims=8, block=block).collect()
    assert sorted((tuple(r) for r in got), key=repr) == plain(rows, k, rounds)


def test_wide_components_stay_exact(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(scale=40_000, size=8)], 0, "x", 1) for i in range(60)]
    got = clustering.cluster(spark.createDataFrame(rows, SCHEMA), k=5, rounds=3, dims=8).collect()
    assert sorted((tuple(r) for r in got), key=repr) == plain(rows, 5, 3)
    with pytest.raises(Exception, match="overflow"):
        clustering.cluster(spark.createDataFrame([(1, [1e9] * 8, 0, "x", 1), (2, [0.0] * 8, 0, "x", 1)], SCHEMA), k=1, dims=8).collect()


def test_empty_vector_table(spark):
    df = clustering.cluster(spark.createDataFrame([(1, None, 0, "x", 1)], SCHEMA))
    assert df.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"] and df.collect() == []


def test_heaps_leave_settled_vectors_alone():
    rng = np.random.default_rng(3)
    true = rng.normal(scale=2000, size=(8, 16))
    x = np.concatenate([c + rng.normal(scale=100, size=(200, 16)) for c in true]).astype(np.int64)
    cents = (true + rng.normal(scale=300, size=true.shape)).astype(np.int64)
    heaps, drift = clustering.Heaps(8), np.zeros(8)
    heaps.add(np.arange(len(x)), *clustering.compared(x, cents), drift)
    seen = []
    for _ in range(4):
        of = heaps.assigned(len(x))
        after = np.array([x[of == c].sum(0) // (of == c).sum() for c in range(8)])
        step = np.sqrt(((after - cents) ** 2).sum(1))
        drift = drift + step + np.array([np.delete(step, c).max() for c in range(8)])
        cents = after
        at, _ = heaps.expired(drift)
        near, gaps = clustering.compared(x[at], cents)
        heaps.add(at, near, gaps, drift)
        seen.append(len(at))
        assert (heaps.assigned(len(x)) == clustering.squared_distances(x, cents).argmin(1)).all()
    assert sum(seen) < len(x) / 10, seen  # compared again in four rounds, of 1600 vectors each
