"""Exact spectra of integer symmetric matrices: characteristic polynomial by primes, real roots, null-space vectors.

The matrices have a row for each dimension of a vector, so all of this is small; primes and roots are spread over tasks.
"""

from __future__ import annotations

from fractions import Fraction
from math import comb, isqrt

import numpy as np


def primes_below(top: int, count: int) -> list[int]:
    """The ``count`` largest primes below ``top`` (at most 2**31)."""
    def prime(n: int) -> bool:
        if n % 2 == 0:
            return n == 2
        d, s = n - 1, 0
        while d % 2 == 0:
            d, s = d // 2, s + 1
        for a in (2, 3, 5, 7):  # enough below 3.2e9
            x = pow(a, d, n)
            if a % n == 0 or x in (1, n - 1):
                continue
            for _ in range(s - 1):
                x = x * x % n
                if x == n - 1:
                    break
            else:
                return False
        return n > 1
    out, n = [], top - 1
    while len(out) < count:
        if prime(n):
            out.append(n)
        n -= 1
    return out


def enough_primes(trace: int, dims: int) -> list[int]:
    """Primes whose product exceeds every coefficient of the polynomial of a positive semidefinite matrix with this trace: the
    sum of products of k eigenvalues is greatest when all are equal."""
    bound = max(comb(dims, k) * (trace ** k) // dims ** k + 1 for k in range(dims + 1))
    return primes_below(1 << 31, bound.bit_length() // 30 + 1)


def hessenberg_modulo(matrix: list[list[int]], p: int) -> np.ndarray:
    """A similar upper Hessenberg matrix modulo a prime."""
    a = np.array([[x % p for x in row] for row in matrix], dtype=np.int64)
    n = len(a)
    for k in range(n - 2):
        some = np.flatnonzero(a[k + 1:, k])
        if not len(some):
            continue
        pivot = k + 1 + some[0]
        if pivot != k + 1:
            a[[pivot, k + 1]] = a[[k + 1, pivot]]
            a[:, [pivot, k + 1]] = a[:, [k + 1, pivot]]
        u = a[k + 2:, k] * pow(int(a[k + 1, k]), -1, p) % p
        a[k + 2:] = (a[k + 2:] - u[:, None] * a[k + 1][None, :] % p) % p
        a[:, k + 1] = (a[:, k + 1] + (a[:, k + 2:] * u[None, :] % p).sum(1)) % p
    return a


def polynomial_modulo(matrix: list[list[int]], p: int) -> list[int]:
    """Coefficients of det(x - matrix) modulo a prime, the constant first."""
    h = hessenberg_modulo(matrix, p)
    n = len(h)
    poly = np.zeros((n + 1, n + 1), dtype=np.int64)
    poly[0, 0] = 1
    for k in range(1, n + 1):
        poly[k, 1:] = poly[k - 1, :-1]
        factors, t = np.zeros(k, dtype=np.int64), 1
        factors[k - 1] = h[k - 1, k - 1]
        for i in range(k - 1, 0, -1):  # products of the subdiagonal
            t = t * int(h[i, i - 1]) % p
            if not t:
                break
            factors[i - 1] = t * int(h[i - 1, k - 1]) % p
        poly[k] = (poly[k] - (factors[:, None] * poly[:k] % p).sum(0)) % p
    return poly[n].tolist()


def polynomial(residues: dict[int, list[int]], dims: int) -> list[int]:
    """The integer polynomial from its residues. Its coefficients alternate in sign, as no root is negative."""
    product = 1
    for p in residues:
        product *= p
    total = [0] * (dims + 1)
    for p, coefficients in residues.items():
        rest = product // p
        rest *= pow(rest % p, -1, p)
        for i, c in enumerate(coefficients):
            total[i] += (c if (dims - i) % 2 == 0 else -c) * rest
    return [(t % product) * (1 if (dims - i) % 2 == 0 else -1) for i, t in enumerate(total)]


def roots_above(poly: list[int], at: int) -> int:
    """How many roots lie above an integer, each with its multiplicity: exact, as all roots are real (Descartes)."""
    c = list(poly)
    n = len(c) - 1
    for i in range(n):  # Taylor shift
        for j in range(n - 1, i - 1, -1):
            c[j] += at * c[j + 1]
    signs = [x > 0 for x in c if x]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def scaled(poly: list[int], bits: int) -> list[int]:
    """The polynomial whose roots are 2**bits times as large."""
    n = len(poly) - 1
    return [c << bits * (n - i) for i, c in enumerate(poly)]


def value(poly: list[int], at: int) -> int:
    out = 0
    for c in reversed(poly):
        out = out * at + c
    return out


def largest_roots(poly: list[int], count: int, top: int, bits: int) -> list[tuple[int, int]]:
    """The ``count`` largest positive roots of a polynomial with real roots between 0 and ``top`` as (2**bits times the root,
    multiplicity within that precision), in falling order.

    Intervals are halved until each holds one root, first at whole numbers, then finer; then the sign decides to the last bit.
    """
    fine = scaled(poly, bits)
    out: list[tuple[int, int]] = []
    taken = 0
    # (low, high, roots above low, roots above high), the interval being (low, high] in units of 2**-level; the highest last.
    todo = [(0, 0, top, roots_above(poly, 0), 0)]
    levels = {0: poly}
    while todo and taken < count:
        level, low, high, n_low, n_high = todo.pop()
        n = n_low - n_high
        if not n:
            continue
        if n == 1:
            a, b = low << bits - level, high << bits - level
            positive = value(fine, b) >= 0  # the sign above the root; at the root itself the interval's upper end
            if value(fine, b) == 0:
                out.append((b, 1))
                taken += 1
                continue
            while b - a > 1:
                m = (a + b) // 2
                v = value(fine, m)
                if v == 0:
                    a = b = m
                elif (v > 0) == positive:
                    b = m
                else:
                    a = m
            out.append((b, 1))
            taken += 1
            continue
        if high - low == 1:
            if level == bits:
                out.append((high, n))
                taken += n
                continue
            step = min(32, bits - level)
            level, low, high = level + step, low << step, high << step
            if level not in levels:
                levels[level] = scaled(poly, level)
        mid = (low + high) // 2
        n_mid = roots_above(levels[level], mid)
        todo += [(level, low, mid, n_low, n_mid), (level, mid, high, n_mid, n_high)]
    return out


def null_vectors(matrix: list[list[int]], root: int, bits: int, count: int, rounds: int = 3) -> list[list[float]]:
    """Unit vectors of the eigenvalue ``root / 2**bits``, ``count`` of them, by inverse iteration in fixed-point numbers of
    ``bits`` bits behind the point, orthogonal to each other, rounded to doubles at the end."""
    n = len(matrix)
    a = np.array([[x << bits for x in row] for row in matrix], dtype=object)
    for i in range(n):
        a[i, i] -= root
    order = list(range(n))
    for k in range(n):
        pivot = k + max(range(n - k), key=lambda i: abs(a[k + i, k]))
        if pivot != k:
            a[[pivot, k]] = a[[k, pivot]]
            order[k], order[pivot] = order[pivot], order[k]
        if a[k, k] == 0:
            a[k, k] = 1  # exactly singular: the least change that can be written
        if k + 1 < n:
            a[k + 1:, k] = (a[k + 1:, k] << bits) // a[k, k]
            a[k + 1:, k + 1:] -= (a[k + 1:, k][:, None] * a[k, k + 1:][None, :]) >> bits
    rng = np.random.default_rng(n)
    found = [np.array([int(x) << bits for x in rng.integers(-1000, 1000, n)], dtype=object) for _ in range(count)]
    for _ in range(rounds):
        done: list[np.ndarray] = []
        for b in found:
            x = b[order]
            for k in range(n - 1):
                x[k + 1:] -= (a[k + 1:, k] * x[k]) >> bits
            for k in range(n - 1, -1, -1):
                x[k] = (x[k] << bits) // a[k, k]
                x[:k] -= (a[:k, k] * x[k]) >> bits
            x = unit(x, bits)
            for y in done:
                x = x - ((y * (int((x * y).sum()) >> bits)) >> bits)
            done.append(unit(x, bits))
        found = done
    return [[int(c) / (1 << bits) for c in x] for x in found]


def unit(x: np.ndarray, bits: int) -> np.ndarray:
    norm = isqrt(int((x * x).sum()))
    return np.array([(int(c) << bits) // norm for c in x], dtype=object)


def ratio(part: int, whole: int) -> float:
    return float(Fraction(part, whole))
