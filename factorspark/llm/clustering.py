"""Centroid clustering: Lloyd rounds in which heaps of distance gaps tell the few vectors that must be compared again."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factorspark.llm import common

LIMIT = 1 << 27  #: components from here on could overflow a squared distance
EXACT = 1 << 22  #: below it sums of 64 products are exact in doubles
MARGIN = 1e-3  #: gaps are doubles of integer distances; a vector is compared again this much early


def squared_distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer vectors to integer centroids."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    if most * most * 4 * x.shape[1] < 1 << 53:
        a, c = x.astype(np.float64), centroids.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ c.T) + (c * c).sum(1)[None, :]).astype(np.int64)
    out = np.empty((len(x), len(centroids)), dtype=np.int64)
    for k, c in enumerate(centroids):
        d = x - c
        out[:, k] = (d * d).sum(1)
    return out


def compared(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each vector (ties: the smaller number) and the gap between the distances to the second and to it."""
    d = squared_distances(x, centroids)
    near = d.argmin(1)
    best = d[np.arange(len(x)), near]
    if len(centroids) == 1:
        return near, np.full(len(x), np.inf)
    d[np.arange(len(x)), near] = np.iinfo(np.int64).max
    return near, np.sqrt(d.min(1).astype(np.float64)) - np.sqrt(best.astype(np.float64))


class Heaps:
    """The vectors of a block in one heap for each cluster, ordered by gap + the drift that was accumulated when it was measured.

    While the accumulated drift of a cluster stays below that sum, the vector's own centroid is still the only nearest one: its
    distance grew and that to any other centroid fell by no more than the drift.
    """

    def __init__(self, k: int, heaps: list[list[tuple[float, int]]] | None = None):
        self.heaps = heaps or [[] for _ in range(k)]

    @classmethod
    def read(cls, sizes: np.ndarray, keys: np.ndarray, rows: np.ndarray) -> Heaps:
        ends = np.cumsum(sizes)
        return cls(len(sizes), [list(zip(keys[e - n:e].tolist(), rows[e - n:e].tolist(), strict=True)) for n, e in zip(sizes, ends, strict=True)])

    def written(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sizes = np.array([len(h) for h in self.heaps], dtype=np.int32)
        flat = [entry for h in self.heaps for entry in h]
        return sizes, np.array([key for key, _ in flat], dtype=np.float64), np.array([row for _, row in flat], dtype=np.int32)

    def expired(self, drift: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Take out the vectors whose gap the drift has used up; with the clusters they were in."""
        rows, old = [], []
        for c, heap in enumerate(self.heaps):
            while heap and heap[0][0] <= drift[c] + MARGIN:
                rows.append(heapq.heappop(heap)[1])
                old.append(c)
        return np.array(rows, dtype=np.int64), np.array(old, dtype=np.int64)

    def add(self, rows: np.ndarray, near: np.ndarray, gaps: np.ndarray, drift: np.ndarray) -> None:
        for row, c, key in zip(rows.tolist(), near.tolist(), (gaps + drift[near]).tolist(), strict=True):
            heapq.heappush(self.heaps[c], (key, row))

    def assigned(self, n: int) -> np.ndarray:
        out = np.empty(n, dtype=np.int32)
        for c, heap in enumerate(self.heaps):
            out[[row for _, row in heap]] = c
        return out


def changed_sums(x: np.ndarray, gone: np.ndarray, come: np.ndarray, k: int) -> list[dict]:
    """What vectors that left ``gone`` (-1: none) and joined ``come`` change in the sums (count first) of each cluster."""
    moved = gone != come
    x, gone, come = x[moved], gone[moved], come[moved]
    total = np.zeros((k, x.shape[1] + 1), dtype=np.int64)
    with_count = np.concatenate([np.ones((len(x), 1), dtype=np.int64), x], axis=1)
    np.add.at(total, come, with_count)
    left = gone >= 0
    np.subtract.at(total, gone[left], with_count[left])
    return [{"cluster": int(c), "sums": total[c].tolist()} for c in np.flatnonzero(total.any(1))]


def block_schema(key: T.DataType) -> T.StructType:
    sums = T.ArrayType(T.StructType([T.StructField("cluster", T.IntegerType()), T.StructField("sums", T.ArrayType(T.LongType()))]))
    return T.StructType([T.StructField("ids", T.ArrayType(key)), T.StructField("x", T.BinaryType()), T.StructField("sizes", T.BinaryType()),
                         T.StructField("keys", T.BinaryType()), T.StructField("rows", T.BinaryType()), T.StructField("changes", sums),
                         T.StructField("compared", T.LongType())])


def batch_of(rows: list[dict], schema: T.StructType) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema

    return pa.RecordBatch.from_pylist(rows, schema=to_arrow_schema(schema))


def packed(x: np.ndarray) -> bytes:
    """A width of 2 or 4 bytes, then the components in that width."""
    width = 2 if np.abs(x).max(initial=0) < 1 << 15 else 4
    return bytes([width]) + x.astype(f"<i{width}").tobytes()


def unpacked(data: bytes, dims: int) -> np.ndarray:
    return np.frombuffer(data, dtype=f"<i{data[0]}", offset=1).reshape(-1, dims).astype(np.int64)


def block_row(ids, x: np.ndarray, heaps: Heaps, changes: list[dict], compared_rows: int, data: bytes | None = None) -> dict:
    sizes, keys, rows = heaps.written()
    return {"ids": ids, "x": data or packed(x), "sizes": sizes.tobytes(), "keys": keys.tobytes(), "rows": rows.tobytes(), "changes": changes,
            "compared": compared_rows}


def first_blocks(rows: DataFrame, dims: int, scale: int, centroids: np.ndarray, block: int) -> DataFrame:
    """Blocks of vectors (``_key``, ``_vector``), each vector compared with all centroids."""
    schema = block_schema(rows.schema["_key"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.slices(batches, block):
            at, x = common.whole_vectors(b.column(1), dims, scale, LIMIT)
            if not len(at):
                continue
            heaps = Heaps(len(centroids))
            near, gaps = compared(x, centroids)
            heaps.add(np.arange(len(x)), near, gaps, np.zeros(len(centroids)))
            changes = changed_sums(x, np.full(len(x), -1), near, len(centroids))
            yield batch_of([block_row(b.column(0).take(pa.array(at)).to_pylist(), x, heaps, changes, len(x))], schema)

    return rows.mapInArrow(run, schema)


def next_blocks(blocks: DataFrame, dims: int, centroids: np.ndarray, drift: np.ndarray) -> DataFrame:
    """The blocks after the centroids moved: only vectors whose gap has expired are compared again."""
    schema = blocks.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                x, heaps = unpacked(r["x"], dims), heaps_of(r)
                at, old = heaps.expired(drift)
                near, gaps = compared(x[at], centroids)
                heaps.add(at, near, gaps, drift)
                yield batch_of([block_row(r["ids"], x, heaps, changed_sums(x[at], old, near, len(centroids)), len(at), r["x"])], schema)

    return blocks.mapInArrow(run, schema)


def heaps_of(r: dict) -> Heaps:
    return Heaps.read(np.frombuffer(r["sizes"], np.int32), np.frombuffer(r["keys"], np.float64), np.frombuffer(r["rows"], np.int32))


def assignments(blocks: DataFrame, dims: int, centroids: np.ndarray) -> DataFrame:
    """``_key, cluster, distance`` of each vector of the blocks."""
    schema = T.StructType([T.StructField("_key", blocks.schema["ids"].dataType.elementType), T.StructField("cluster", T.IntegerType()),
                           T.StructField("distance", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0)
            for i, r in enumerate(b.select(["x", "sizes", "keys", "rows"]).to_pylist()):
                x = unpacked(r["x"], dims)
                c = heaps_of(r).assigned(len(x))
                d = x - centroids[c]
                yield pa.RecordBatch.from_arrays([ids[i].values, pa.array(c), pa.array((d * d).sum(1))], names=schema.names)

    return blocks.select("ids", "x", "sizes", "keys", "rows").mapInArrow(run, schema)


def add_changes(blocks: DataFrame, totals: list[list[int]]) -> None:
    """Add the changes of all blocks to the totals (count, sums) of each cluster: a row for each cluster and component."""
    parts = blocks.select(F.explode("changes").alias("c")).select("c.cluster", F.posexplode("c.sums").alias("place", "value"))
    for r in parts.groupBy("cluster", "place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect():
        totals[r["cluster"]][r["place"]] += int(r["value"])


def moved(totals: list[list[int]], before: np.ndarray) -> np.ndarray:
    return np.array([[s // t[0] for s in t[1:]] if t[0] else old.tolist() for t, old in zip(totals, before, strict=True)], dtype=np.int64)


def starts(rows: DataFrame, k: int, dims: int, scale: int, seed: str) -> np.ndarray:
    """The vectors with the smallest SHA-256 of ``seed:key``, as integers; at most ``k`` rows reach the driver."""
    x = F.col("_vector")
    good = (F.size(x) == dims) & ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    first = rows.where(good & F.col("_key").isNotNull()).select(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("_key").cast("string")), 256).alias("h"),
                                                                x.cast("array<double>").alias("x"))
    got = first.orderBy("h", "x").limit(k).collect()
    return np.floor(np.array([r["x"] for r in got], dtype=np.float64).reshape(-1, dims) * scale).astype(np.int64)


def cluster(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 40, rounds: int = 5, scale: int = 256, dims: int = 64,
            seed: str = "2", block: int = 4096) -> DataFrame:
    """``key, cluster, distance, cluster_inertia, inertia, centroid_sha256`` for each vector of ``dims`` finite components.

    Components become ``floor(scale * component)``. The first centroids are the ``k`` vectors (all, if fewer) with the smallest
    SHA-256 of ``seed:key``. Each round assigns every vector to its nearest centroid (squared Euclidean distance, ties: the smaller
    number) and sets each non-empty centroid to the exact floor of its vectors' mean; then all are assigned once more. Distances,
    sums and inertias are exact integers.

    Vectors are held in blocks of at most ``block``, written to the shared folder with the heaps of their gaps; a round reads the
    blocks, compares the vectors whose gaps the centroids' drift has used up and writes the blocks again; the blocks before are
    removed once the next ones are written. The driver holds ``k`` centroids and sums.

    Null vectors, vectors of another length and those with null or non-finite components give no row. Null keys keep their rows
    but don't start clusters; repeated keys and repeated rows all count (of equal keys the least vector starts first). Fewer
    vectors than ``k`` give as many clusters, an empty table no rows. Other columns, whatever their names, are not read. Components
    of ``2**27 / scale`` or more in magnitude raise an error, as their distances would overflow.
    """
    spark = vectors.sparkSession
    common.ship(spark)
    rows = vectors.select(F.col(key).alias("_key"), F.col(vector).alias("_vector"))
    centroids = starts(rows, k, dims, scale, seed)
    if not len(centroids):
        empty = T.StructType([T.StructField(key, vectors.schema[key].dataType)])
        return spark.createDataFrame([], empty).selectExpr("*", "int(null) cluster", "bigint(null) distance", "bigint(null) cluster_inertia", "bigint(null) inertia",
                                                           "string(null) centroid_sha256")
    totals = [[0] * (dims + 1) for _ in centroids]
    drift = np.zeros(len(centroids))
    stage = common.Stage(first_blocks(rows, dims, scale, centroids, block), "blocks")
    for _ in range(rounds):
        add_changes(stage.table, totals)
        after = moved(totals, centroids)
        step = np.sqrt(((after - centroids).astype(np.float64) ** 2).sum(1))
        # The fall of the distance to the nearest other centroid: the longest step among the others.
        longest = np.sort(step)[::-1]
        others = np.where((step == longest[0]) & ((step == longest[0]).sum() == 1), longest[1] if len(step) > 1 else 0.0, longest[0])
        drift, centroids = drift + step + others, after
        following = common.Stage(next_blocks(stage.table, dims, centroids, drift), "blocks")
        stage.remove()
        stage = following
    done = common.Stage(assignments(stage.table, dims, centroids), "clusters").table
    stage.remove()
    by_cluster = done.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    shas = spark.createDataFrame([(c, ",".join(map(str, x))) for c, x in enumerate(centroids.tolist())], "cluster int, components string")
    facts = by_cluster.join(F.broadcast(shas), "cluster").select("cluster", "cluster_inertia", F.sha2("components", 256).alias("centroid_sha256"))
    found = {r["cluster"]: r for r in facts.collect()}  # k rows
    total = sum(r["cluster_inertia"] for r in found.values())
    facts = spark.createDataFrame([(c, r["cluster_inertia"], total, r["centroid_sha256"]) for c, r in found.items()],
                                  "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    joined = done.join(F.broadcast(facts), "cluster")  # a row for each of k clusters
    return joined.select(F.col("_key").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle_sql(k: int = 40, rounds: int = 5, scale: int = 256, dims: int = 64, seed: str = "2") -> str:
    """The clustering of ``embeddings`` in DuckDB: every round compares all vectors with all centroids."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""a{i} as materialized (select rid, c, d from (select rid, c, d, row_number() over (partition by rid order by d, c) place from (
    select v.rid, c{i}.c, list_sum(list_transform(list_zip(v.x, c{i}.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) d from v, c{i})) where place = 1)""")
        if i < rounds:
            steps.append(f"""m{i} as (select c, i, sum(value)::hugeint s, count(*)::hugeint n from (select a.c, unnest(v.x) as value, generate_subscripts(v.x, 1) i
    from a{i} a join v using (rid)) group by c, i),
c{i + 1} as materialized (select o.c, coalesce(m.x, o.x) x from c{i} o left join (select c, list(((s - ((s % n) + n) % n) // n)::bigint order by i) x from m{i} group by c) m
    using (c))""")
    chain = ",\n".join(steps)
    return f"""
with v as materialized (select row_number() over () rid, vec_id, list_transform(embedding, lambda e: floor({scale} * e::double)::bigint) x from embeddings
    where embedding is not null and len(embedding) = {dims} and len(list_filter(embedding, lambda e: e is null or isnan(e) or isinf(e))) = 0),
c0 as materialized (select (row_number() over (order by h, x) - 1)::integer c, x from (select sha256('{seed}:' || vec_id) h, x from v where vec_id is not null
    order by h, x limit {k})),
{chain}
select vec_id, c as cluster, d::bigint distance, sum(d) over (partition by c)::bigint cluster_inertia, sum(d) over ()::bigint inertia,
    sha256(array_to_string(f.x, ',')) centroid_sha256
from a{rounds} join v using (rid) join c{rounds} f using (c)
"""
