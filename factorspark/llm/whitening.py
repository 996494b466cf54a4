"""Embedding whitening by exact principal components: integer scatter, its characteristic polynomial, its roots and their vectors."""

from __future__ import annotations

from collections.abc import Iterator
from math import sqrt
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factorspark.llm import common, spectrum

LIMIT = 1 << 30  #: scaled components from here on are out of range


class Fit(NamedTuple):
    n: int
    dims: int
    sums: list[int]  #: of x - shift
    scatter: list[list[int]]  #: n * n * covariance
    eigenvalues: list[float]
    vectors: np.ndarray  #: a unit column for each component
    explained: list[float]


def vector_lengths(rows: DataFrame) -> dict[int, int]:
    x = F.col("_vector")
    good = x.isNotNull() & (F.size(x) > 0) & ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return {r["n"]: r["count"] for r in rows.where(good).groupBy(F.size(x).alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()}


def products(x: np.ndarray) -> np.ndarray:
    """Exact sums of x_i * x_j over the rows, as Python integers."""
    most = int(np.abs(x).max(initial=0)) or 1
    step = (1 << 53) // (most * most)
    total = np.zeros((x.shape[1], x.shape[1]), dtype=object)
    if step < 1:
        return np.einsum("ki,kj->ij", x.astype(object), x.astype(object), optimize=False) if len(x) else total
    for lo in range(0, len(x), step):
        part = x[lo:lo + step].astype(np.float64)
        total += (part.T @ part).astype(np.int64).astype(object)
    return total


def moments(rows: DataFrame, dims: int, scale: int) -> tuple[int, list[int], list[list[int]]]:
    """Count, sums and sums of products of the scaled components: one row for each task, added up by place."""
    upper = np.triu_indices(dims)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, g = 0, np.zeros(dims, dtype=object), np.zeros((dims, dims), dtype=object)
        for b in batches:
            _, x = common.whole_vectors(b.column(0), dims, scale, LIMIT)
            if len(x):
                n, s, g = n + len(x), s + x.sum(0).astype(object), g + products(x)
        yield pa.RecordBatch.from_arrays([pa.array([[str(v) for v in [n, *s, *g[upper]]]], pa.list_(pa.string()))], names=["parts"])

    parts = rows.select("_vector").mapInArrow(run, "parts array<string>").select(F.posexplode("parts").alias("place", "value"))
    got = {r["place"]: int(r["value"]) for r in parts.groupBy("place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()}
    g = [[0] * dims for _ in range(dims)]
    for at, (i, j) in enumerate(zip(*upper, strict=True)):
        g[i][j] = g[j][i] = got[1 + dims + at]
    return got[0], [got[1 + i] for i in range(dims)], g


def characteristic_polynomial(spark: SparkSession, scatter: list[list[int]]) -> list[int]:
    """A task for some primes each; a row of ``dims + 1`` residues for each prime comes back."""
    dims = len(scatter)
    primes = spectrum.enough_primes(sum(scatter[i][i] for i in range(dims)), dims)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = b.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([spectrum.polynomial_modulo(scatter, x) for x in p], pa.list_(pa.int64()))],
                                             names=["prime", "residues"])

    table = spark.createDataFrame([(p,) for p in primes], "prime long").repartition(min(len(primes), 64), "prime")
    return spectrum.polynomial({r["prime"]: r["residues"] for r in table.mapInArrow(run, "prime long, residues array<long>").collect()}, dims)


def components_of(spark: SparkSession, scatter: list[list[int]], count: int) -> tuple[list[tuple[int, int]], int, np.ndarray]:
    """Roots (2**bits times the eigenvalue, multiplicity), bits, and unit vectors as columns."""
    dims, trace = len(scatter), sum(scatter[i][i] for i in range(len(scatter)))
    bits = max(64, 288 - trace.bit_length())
    poly = characteristic_polynomial(spark, scatter)
    roots = spectrum.largest_roots(poly, count, trace, bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for place, root, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                found = spectrum.null_vectors(scatter, int(root), bits, n)
                yield pa.RecordBatch.from_arrays([pa.array([place], pa.int32()), pa.array([found], pa.list_(pa.list_(pa.float64())))], names=["place", "vectors"])

    table = spark.createDataFrame([(i, str(r), n) for i, (r, n) in enumerate(roots)], "place int, root string, n int").repartition(min(len(roots), 64), "place")
    found = {r["place"]: r["vectors"] for r in table.mapInArrow(run, "place int, vectors array<array<double>>").collect()}
    return roots, bits, np.array([v for i in range(len(roots)) for v in found[i]][:count]).T


def fit(rows: DataFrame, scale: int, count: int) -> Fit | None:
    """The fit over all vectors (``_vector``) of the most frequent length; None without one, or where all are equal."""
    spark = rows.sparkSession
    dims = next(iter(vector_lengths(rows)), 0)
    if not dims:
        return None
    n, sums, g = moments(rows, dims, scale)
    scatter = [[n * g[i][j] - sums[i] * sums[j] for j in range(dims)] for i in range(dims)]
    trace = sum(scatter[i][i] for i in range(dims))
    if not trace:
        return Fit(n, dims, sums, scatter, [], np.zeros((dims, 0)), [])
    roots, bits, vectors = components_of(spark, scatter, count)
    values = [r for r, m in roots for _ in range(m)][:count]
    return Fit(n, dims, sums, scatter, [spectrum.ratio(v, n * n << bits) for v in values], vectors, [spectrum.ratio(v, trace << bits) for v in values])


def projected(x: np.ndarray, model: Fit) -> np.ndarray:
    """Whitened components of the scaled vectors."""
    mean = np.array([spectrum.ratio(s, model.n) for s in model.sums])
    return ((x - mean) @ model.vectors) / np.sqrt(np.array(model.eigenvalues))


def deviations(x: np.ndarray, model: Fit) -> list[int]:
    """The sums of (n * x - S)**2 over the dimensions, exact (a shift of x changes neither)."""
    sums = np.array(model.sums, dtype=object)
    most = max(int(np.abs(x).max(initial=0)) * model.n, max(map(abs, model.sums))) * 2
    if most * most * model.dims < 1 << 63:
        r = x * model.n - sums.astype(np.int64)
        return (r * r).sum(1).tolist()
    r = x.astype(object) * model.n - sums
    return (r * r).sum(1).tolist()


def identity_error(rows: DataFrame, model: Fit, scale: int) -> float:
    """The largest entry of the whitened components' covariance minus the identity; their means are zero up to rounding."""
    c = len(model.eigenvalues)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(c * c + c)
        for b in batches:
            _, x = common.whole_vectors(b.column(0), model.dims, scale, LIMIT)
            w = projected(x, model)
            total += np.concatenate([(w.T @ w).ravel(), w.sum(0)])
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["parts"])

    parts = rows.select("_vector").mapInArrow(run, "parts array<double>").select(F.posexplode("parts").alias("place", "value"))
    got = {r["place"]: r["value"] for r in parts.groupBy("place").agg(F.sum("value").alias("value")).collect()}
    flat = np.array([got[i] for i in range(c * c + c)]) / model.n
    mean = flat[c * c:]
    return float(np.abs(flat[:c * c].reshape(c, c) - np.outer(mean, mean) - np.eye(c)).max())


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = 64, shift: int = 1_000_000, components: int = 32) -> DataFrame:
    """``key, component, n, deviation, whitened, explained, identity_error``: a row for each vector and component.

    Components of a vector become integers x = floor(scale * c) + shift. The covariance V of all ``n`` vectors (divisor n) is
    held exactly, as the integer scatter n * n * V. Its characteristic polynomial is found modulo primes, which are dealt out to
    tasks, its largest roots are isolated and refined to about 288 bits, and each root's unit vector comes from inverse iteration
    in fixed-point numbers. ``whitened`` is x - S/n projected on the component over the root of its eigenvalue, ``deviation`` the
    exact sum of (n * x - S)**2 over the dimensions (null where it doesn't fit a long), ``explained`` the eigenvalue over V's
    trace, ``identity_error`` the largest absolute entry of the whitened components' covariance minus the identity.

    Work grows with the vectors in three passes over them, and with the fourth power of their length on small matrices that
    don't grow with the rows. A task hands on its sums only.

    Null and empty vectors and those with null or non-finite components are dropped, as are vectors of another length than the
    most frequent one (ties: the shorter). Null and repeated keys and repeated rows all count and keep their rows. Only components
    with a positive eigenvalue exist, so a table without variance (no rows, one row, equal rows) gives no rows. Equal eigenvalues
    share a space in which any orthogonal vectors serve; the same ones are used for all rows. Other columns, whatever their names,
    are not read. Scaled components of 2**30 or more in magnitude raise an error.
    """
    spark = vectors.sparkSession
    common.ship(spark)
    rows = vectors.select(F.col(key).alias("_key"), F.col(vector).alias("_vector"))
    schema = T.StructType([T.StructField(key, vectors.schema[key].dataType)] + [T.StructField(n, t) for n, t in (
        ("component", T.IntegerType()), ("n", T.LongType()), ("deviation", T.LongType()), ("whitened", T.DoubleType()), ("explained", T.DoubleType()),
        ("identity_error", T.DoubleType()))])
    model = fit(rows, scale, components)
    if model is None or not model.eigenvalues:
        return spark.createDataFrame([], schema)
    error, c = identity_error(rows, model, scale), len(model.eigenvalues)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.slices(batches, 2048):
            at, x = common.whole_vectors(b.column(1), model.dims, scale, LIMIT)
            if not len(at):
                continue
            far = [d if d < 1 << 63 else None for d in deviations(x, model)]
            each = np.repeat(np.arange(len(at)), c)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(at[each])), pa.array(np.tile(np.arange(1, c + 1, dtype=np.int32), len(at))), pa.array(np.full(len(each), model.n)),
                 pa.array(far, pa.int64()).take(pa.array(each)), pa.array(projected(x, model).ravel()), pa.array(np.tile(model.explained, len(at))),
                 pa.array(np.full(len(each), error))], names=schema.names)

    return rows.mapInArrow(run, schema)
