"""Whitening against numpy's eigenvectors, and its exact parts against plain integer arithmetic."""
import math
from fractions import Fraction

import numpy as np
import pytest

from factorspark.llm import spectrum, whitening

SCHEMA = "vec_id long, embedding array<float>, component string, n int"


def plain_polynomial(m):
    """Faddeev-LeVerrier in fractions, the constant first."""
    n = len(m)
    a = [[Fraction(x) for x in row] for row in m]
    out, b = [Fraction(1)], [[Fraction(0)] * n for _ in range(n)]
    for k in range(1, n + 1):
        b = [[sum(a[i][t] * b[t][j] for t in range(n)) + (out[-1] if i == j else 0) for j in range(n)] for i in range(n)]
        out.append(-sum(a[i][t] * b[t][i] for i in range(n) for t in range(n)) / k)
    return [int(c) for c in reversed(out)]


def scatter_of(x):
    n, s = len(x), [sum(c) for c in zip(*x)]
    d = len(s)
    return [[n * sum(r[i] * r[j] for r in x) - s[i] * s[j] for j in range(d)] for i in range(d)]


@pytest.mark.parametrize("seed, n, d", [(1, 40, 7), (2, 4, 6), (3, 30, 1), (4, 3, 2)])
def test_polynomial_is_exact(seed, n, d):
    rng = np.random.default_rng(seed)
    m = scatter_of(rng.integers(-300, 300, (n, d)).tolist())
    primes = spectrum.enough_primes(sum(m[i][i] for i in range(d)), d)
    assert spectrum.polynomial({p: spectrum.polynomial_modulo(m, p) for p in primes}, d) == plain_polynomial(m)


def from_roots(roots):
    poly = [1]
    for r in roots:
        poly = [a - r * b for a, b in zip([0, *poly], [*poly, 0])]
    return poly


def test_roots_with_multiplicity_and_close_ones():
    assert [(r >> 64, m) for r, m in spectrum.largest_roots(from_roots([0, 0, 3, 3, 3, 7, 8, 100]), 8, 121, 64)] == [(100, 1), (8, 1), (7, 1), (3, 3)]
    assert spectrum.largest_roots(from_roots([0, 5]), 1, 5, 64) == [(5 << 64, 1)]
    # x*x - 6x + 7: 3 +- sqrt 2
    got = spectrum.largest_roots([7, -6, 1], 2, 6, 128)
    assert [float(Fraction(r, 1 << 128)) for r, _ in got] == pytest.approx([3 + math.sqrt(2), 3 - math.sqrt(2)], rel=1e-15)
    near = [10**12, 10**12 + 1, 10**12 + 2]
    assert [r >> 64 for r, _ in spectrum.largest_roots(from_roots(near), 3, 10**13, 64)] == near[::-1]


def test_close_eigenvalues_have_right_vectors():
    m = [[10**15, 1, 0], [1, 10**15, 0], [0, 0, 10**15 + 3]]  # values 1e15 + 3, + 1, - 1: one double apart or less
    poly = spectrum.polynomial({p: spectrum.polynomial_modulo(m, p) for p in spectrum.enough_primes(3 * 10**15 + 3, 3)}, 3)
    roots = spectrum.largest_roots(poly, 3, 3 * 10**15 + 3, 128)
    assert [r >> 128 for r, _ in roots] == [10**15 + 3, 10**15 + 1, 10**15 - 1]
    found = [np.abs(spectrum.null_vectors(m, r, 128, 1)[0]) for r, _ in roots]
    h = math.sqrt(0.5)
    assert np.allclose(found, [[0, 0, 1], [h, h, 0], [h, h, 0]], atol=1e-15)


def plain(x, components):
    x = np.array(x, dtype=np.float64)
    y = x - x.mean(0)
    e, v = np.linalg.eigh(y.T @ y / len(x))
    e, v = e[::-1][:components], v[:, ::-1][:, :components]
    return e, (y @ v) / np.sqrt(e), e / (y * y).sum(1).mean()


def check(spark, rows, kept, components):
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA), components=components).collect()
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v, *_ in kept]
    n, s = len(x), [sum(c) for c in zip(*x)]
    e, w, explained = plain(x, components)
    assert len(got) == len(kept) * len(e)
    far = [sum((n * a - b) ** 2 for a, b in zip(r, s)) for r in x]
    for k in range(len(e)):
        mine = sorted((r.vec_id is None, r.vec_id or 0, r.whitened) for r in got if r.component == k + 1)
        sides = [sorted((i is None, i or 0, sign * float(v)) for (i, *_), v in zip(kept, w[:, k])) for sign in (1, -1)]
        assert any(np.allclose([a[2] for a in mine], [b[2] for b in side], atol=1e-7) for side in sides)
        assert all(r.explained == pytest.approx(explained[k], rel=1e-9) for r in got if r.component == k + 1)
    assert sorted(r.deviation for r in got if r.component == 1) == sorted(far)
    assert {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    return got


def test_whitening_equals_numpy(spark):
    rng = np.random.default_rng(1)
    mix = rng.normal(size=(12, 12))
    kept = [(i, [float(c) for c in mix @ rng.normal(size=12)], "x", 1) for i in range(300)]
    kept += [(None, kept[0][1], "x", 1), (5, kept[5][1], "x", 1), (5, kept[9][1], "x", 1)]
    odd = [(900, None), (901, []), (902, [1.0] * 5), (903, [None] + [1.0] * 11), (904, [math.nan] * 12), (905, [math.inf] * 12)]
    check(spark, kept + [(i, v, "x", 1) for i, v in odd], kept, 5)


def test_fewer_components_than_asked_for(spark):
    rng = np.random.default_rng(2)
    kept = [(i, [float(c) for c in rng.normal(size=3)], "x", 1) for i in range(50)]
    assert {r.component for r in check(spark, kept, kept, 32)} == {1, 2, 3}
    flat = [(i, [float(i % 7), 1.0, 0.0], "x", 1) for i in range(50)]  # one dimension varies
    got = whitening.whiten(spark.createDataFrame(flat, SCHEMA)).collect()
    assert {r.component for r in got} == {1} and got[0].explained == 1.0 and got[0].identity_error < 1e-12


def test_large_sums_stay_exact(spark):
    rng = np.random.default_rng(3)
    kept = [(i, [float(c) for c in rng.normal(scale=2_000_000, size=4)], "x", 1) for i in range(64)]
    df = spark.createDataFrame(kept, SCHEMA)
    got = {r.vec_id: r.deviation for r in whitening.whiten(df).collect()}
    x = [[math.floor(64 * float(np.float32(c))) for c in v] for _, v, *_ in kept]
    s = [sum(c) for c in zip(*x)]
    far = [sum((64 * a - b) ** 2 for a, b in zip(r, s)) for r in x]
    assert [got[i] for i in range(64)] == [f if f < 1 << 63 else None for f in far] and None in got.values()


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0], "x", 1)], [(i, [1.0, 2.0], "x", 1) for i in range(5)], [(1, None, "x", 1)]])
def test_no_variance_no_rows(spark, rows):
    df = whitening.whiten(spark.createDataFrame(rows, SCHEMA))
    assert df.collect() == [] and df.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
