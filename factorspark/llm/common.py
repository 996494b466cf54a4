"""Helpers that several operators share: tables, training rows, batches, connected components."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factorspark.session import materialize, shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Stage:
    """A table written to the shared folder, to be removed once nothing reads it any more."""

    def __init__(self, df: DataFrame, purpose: str):
        self.path = shared_dir(df.sparkSession, purpose)
        df.write.parquet(self.path)
        self.table = df.sparkSession.read.schema(df.schema).parquet(self.path)

    def remove(self) -> None:
        spark = self.table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def held_out(key: Column, modulus: int, remainder: int) -> Column:
    """Whether the row with this key is kept from training; false for a null key."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the session's executors, once: functions of tasks import it there."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[2]
    archive = os.path.join(tempfile.mkdtemp(prefix="package-"), "factorspark.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted((root / "factorspark").rglob("*.py")):
            z.write(p, p.relative_to(root))
    sc.addPyFile(archive)
    _shipped.add(sc.applicationId)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Parts of the batches, so that a task holds few texts as Python strings at once; none is empty."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def map_batches(df: DataFrame, f: Callable[[pa.RecordBatch], dict], schema: str) -> DataFrame:
    """Apply ``f`` to parts of Arrow batches; it returns the columns of ``schema`` as arrays or lists."""
    spark = df.sparkSession
    ship(spark)
    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(spark.createDataFrame([], schema).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            cols = f(b)
            yield pa.RecordBatch.from_arrays([pa.array(cols[x.name], type=x.type) if not isinstance(cols[x.name], pa.Array)
                                              else cols[x.name].cast(x.type) for x in target], schema=target)

    return df.mapInArrow(run, schema)


def whole_vectors(column: pa.Array, dims: int, scale: int, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the lists of ``dims`` finite components, and these as the integers ``floor(scale * component)``; from ``limit`` on
    in magnitude an error."""
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    at = np.flatnonzero(lengths == dims)
    x = column.take(pa.array(at)).flatten().cast(pa.float64(), safe=False).to_numpy(zero_copy_only=False).reshape(len(at), dims)  # null: nan
    good = np.isfinite(x).all(1)
    x = np.floor(x[good] * scale)
    if np.abs(x).max(initial=0) >= limit:
        raise ValueError(f"components of {limit // scale} or more would overflow")
    return at[good], x.astype(np.int64)


def sampled(docs: DataFrame, labels: DataFrame | None, label: str, key: str, held: tuple[int, int], text: str = "text",
            per_label: int = 3000, max_labels: int = 256, max_chars: int | None = None, extra: str | None = None) -> tuple[DataFrame, dict]:
    """Training rows ``_y, _t, _x, _k, _o`` (label, text, extra, key, place) and the number of eligible keys of each label.

    Rows that ``held_out`` (modulus, remainder) keeps back don't train. The sample is bounded: for each of the ``max_labels`` most frequent labels the ``per_label`` keys with the
    smallest hashes, among rows with texts of at most ``max_chars`` code points (None: of any length). ``labels`` holds key
    and label (the greatest label counts where a key repeats); None: the label is a column of ``docs``. A key that repeats
    in ``docs`` gives one row, that with the least text. Null keys, labels and texts don't train. The result doesn't depend
    on how rows are partitioned.
    """
    order = F.xxhash64(F.col("_k")).bitwiseAND(F.lit((1 << 40) - 1))
    rows = docs.select(F.col(key).alias("_k"), F.col(text).alias("_t"), F.coalesce((F.col(extra) if extra else F.lit(None)).cast("string"), F.lit("")).alias("_x"),
                       *([F.col(label).alias("_y")] if labels is None else []))
    rows = rows.where(F.col("_k").isNotNull() & F.col("_t").isNotNull() & ~held_out(F.col("_k"), *held))
    if max_chars is not None:
        rows = rows.where(F.length("_t") <= max_chars)
    if labels is not None:
        given = labels.select(F.col(key).alias("_k"), F.col(label).alias("_y")).where("_k is not null and _y is not null")
        named = rows.select("_k").distinct().join(given.groupBy("_k").agg(F.max("_y").alias("_y")), "_k")
    else:
        named = rows.where("_y is not null").groupBy("_k").agg(F.max("_y").alias("_y"))
    # Counted after all filters, on one row for each key: then the limits below always leave per_label keys or all.
    named = materialize(named, "named")
    counts = {r["_y"]: r["count"] for r in
              named.groupBy("_y").count().orderBy(F.desc("count"), "_y").limit(max_labels).collect()}
    # A hash limit for each label keeps little more than per_label keys of it, so that the exact cut ranks few.
    limit = {y: int((1 << 40) * min(1.0, (1.3 * per_label + 200) / n)) for y, n in counts.items()}
    share = F.create_map(*[F.lit(x) for y in sorted(limit) for x in (y, limit[y])]) if limit else None
    near = named.where(order < F.element_at(share, F.col("_y"))) if limit else named.where("false")
    place = F.row_number().over(Window.partitionBy("_y").orderBy(order, "_k"))
    chosen = near.select("_k", "_y", order.alias("_o"), place.alias("_n")).where(F.col("_n") <= per_label).drop("_n")
    found = rows.join(F.broadcast(chosen), ["_k", "_y"] if labels is None else "_k")  # at most a few thousand keys a label
    found = found.groupBy("_k", "_y", "_o").agg(F.min(F.struct("_t", "_x")).alias("_r"))
    return found.select("_y", F.col("_r._t").alias("_t"), F.col("_r._x").alias("_x"), "_k", "_o"), counts


def labelled_sample(docs: DataFrame, labels: DataFrame | None, label: str, key: str, held: tuple[int, int], text: str = "text",
                    per_label: int = 3000, max_labels: int = 256, max_chars: int = 16384, extra: str | None = None) -> tuple[list[tuple], dict]:
    """The rows of ``sampled`` on the driver, in the order of their hashes, as ``(label, text, extra, key)``, and its counts."""
    found, counts = sampled(docs, labels, label, key, held, text, per_label, max_labels, max_chars, extra)
    got = sorted((r["_o"], r["_k"], r["_t"], r["_y"], r["_x"]) for r in found.collect()) if counts else []
    return [(y, t, x, k) for _, k, t, y, x in got], counts


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, root``: for each node of the undirected ``edges`` (a, b) the smallest node it can reach.

    Alternates large and small stars: every round hangs a node's neighbours on their smallest one, so the number of
    rounds grows with the logarithm of the longest path. Each round is written to the shared folder. Null ends and
    loops are dropped; no edges give no rows.
    """
    e = edges.where("a is not null and b is not null and a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = materialize(e, "star")

    def state(edges: DataFrame) -> tuple:
        return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())

    before = state(e)
    if not before[0]:
        return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    # The least neighbours are written before they are joined: then both sides of each join are plain tables and adaptive
    # execution can split the rows of a node that a large group hangs on.
    for _ in range(max_rounds):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = materialize(both.join(low.hint("merge"), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")), "large")
        low = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(low.hint("merge"), "u")
        hung = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = materialize(small.select("u", F.col("m").alias("v")).union(hung).distinct(), "star")
        now = state(e)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = e.groupBy("u").agg(F.min("v").alias("root"))
    return roots.select(F.col("u").alias("node"), "root").union(roots.select(F.col("root").alias("node"), "root").distinct())
