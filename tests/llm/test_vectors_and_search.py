"""Vector near duplicates and top-k search against brute force."""
import math

import numpy as np
import pytest

from factorspark.llm import topk, vectors

SCHEMA = "vec_id long, embedding array<double>, label int, id string, n long"


def clusters(rng, n=120, dims=16):
    rows, base = [], rng.normal(size=(12, dims))
    for i in range(n):
        v = base[i % 12] + rng.normal(scale=rng.choice([0.02, 0.12, 0.3]), size=dims)
        rows.append((i, [float(x) for x in v], int(i % 3), "x", 1))
    odd = [(200, None, 1), (201, [0.0] * dims, 1), (202, [math.nan] + [1.0] * (dims - 1), 1), (203, rows[0][1], None), (204, [], 1),
           (205, [None] + rows[0][1][1:], 0), (206, [math.inf] + [1.0] * (dims - 1), 0), (207, rows[0][1][:4], 0), (208, [1e300 * x for x in rows[0][1]], 0)]
    # Repeated rows, other vectors under one key, null keys: alone, in a group and among copies.
    more = [(5, rows[60][1], rows[60][2]), (7, rows[7][1], rows[7][2]), (None, rows[3][1], rows[3][2]), (None, [9.0 - i for i in range(dims)], 0), (None, None, 0),
            (None, [float(i) for i in range(dims)], 2), (None, [float(i) for i in range(dims)], 2)]
    return rows + [(*o, "x", 1) for o in odd + more] + [rows[5], rows[5]] + [(300 + i, rows[8][1], rows[8][2], "x", 1) for i in range(20)]


def brute_links(rows, least):
    good = {n: np.array(r[1]) for n, r in enumerate(rows) if r[1] and None not in r[1] and np.isfinite(r[1]).all() and np.any(r[1]) and r[2] is not None}
    unit = {n: (v / np.abs(v).max()) / np.linalg.norm(v / np.abs(v).max()) for n, v in good.items()}
    links = {n: {j for j in good if j != n and rows[j][2] == rows[n][2] and len(unit[j]) == len(unit[n]) and unit[j] @ unit[n] >= least} for n in good}
    out = []
    for n, r in enumerate(rows):
        seen, todo = {n}, [n]
        while todo:
            for j in links.get(todo.pop(), ()):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        low = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((r[0], len(links.get(n, ())), low, low == r[0]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [2048, 4])
def test_links_equal_brute_force(spark, block):
    rows = clusters(np.random.default_rng(3))
    got = vectors.near_duplicates(spark.createDataFrame(rows, SCHEMA), block=block).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute_links(rows, 0.93)


def test_empty_vector_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert vectors.near_duplicates(empty).collect() == [] and topk.search(empty).collect() == []


def brute_top(rows, every, k):
    one = {n: np.floor(1024 * np.array(r[1])).astype(np.int64) for n, r in enumerate(rows) if r[1] and None not in r[1] and np.isfinite(r[1]).all()}
    last = 1 << 60
    out = []
    for q in one:
        if rows[q][0] is not None and rows[q][0] % every == 0:
            best = sorted((-int(v @ one[q]), rows[i][0] if rows[i][0] is not None else last) for i, v in one.items() if i != q)[:k]
            out += [(rows[q][0], n + 1, i if i != last else None, -s) for n, (s, i) in enumerate(best)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [16384, 100])
def test_top_k_equals_brute_force_with_ties(spark, block):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in np.round(rng.normal(size=6), 1)], 0, "x", 1) for i in range(700)]
    rows += [(1000 + i, [0.5, -0.5, 0.0, 0.0, 1.0, 0.0], 0, "x", 1) for i in range(30)]  # ties
    rows += [(2000, None, 0, "x", 1), (2100, [math.nan] * 6, 0, "x", 1), (2200, [0.0] * 6, 0, "x", 1), (None, [1.0] * 6, 0, "x", 1), rows[0],
             (100, [2.0] * 6, 0, "x", 1), (None, [3.0] * 6, 0, "x", 1), (None, [3.0] * 6, 0, "x", 1), (1003, rows[0][1], 0, "x", 1)]
    got = topk.search(spark.createDataFrame(rows, SCHEMA), every=100, k=7, rows_per_block=block, queries_per_block=5).collect()
    assert sorted(((r.query_id, r["rank"], r.vec_id, r.score) for r in got), key=repr) == brute_top(rows, 100, 7)


def test_index_stops_only_on_proof():
    rng = np.random.default_rng(5)
    for dims in (1, 3, 40):
        m = rng.integers(-300, 300, (900, dims))
        index = topk.Index(np.arange(900), m)
        for q in (m[3], -m[4], np.zeros(dims, np.int64)):
            want = sorted((-int(s), i) for i, s in enumerate(m @ q) if i != 3)[:5]
            assert [(-s, int(index.ids[r])) for r, s in index.top(q, 3, 5)] == want


def test_fewer_rows_than_k(spark):
    rows = [(0, [1.0, 2.0], 0, "x", 1), (1, [1.0], 0, "x", 1)]
    got = topk.search(spark.createDataFrame(rows, SCHEMA), every=100, k=10).collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in got] == [(0, 1, 1, 1024 * 1024)]
