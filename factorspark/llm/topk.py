"""Exact top-k search: an impact-ordered index, read score at a time until the rest is proven out."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factorspark.llm import common
from factorspark.llm.vectors import groups_of, rows_as_vectors
from factorspark.session import materialize


class Index:
    """Postings of one block of integer vectors: for each dimension the rows in ascending order of their value.

    Times a query's component the values are the postings' impacts; read from the end (or the start, for a negative
    component) they descend, so the postings whose impact reaches a level are one run.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        by = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[by], vectors[by]
        self.rows = np.argsort(self.vectors, axis=0, kind="stable").T.copy()
        self.values = np.take_along_axis(self.vectors.T, self.rows, axis=1)

    def top(self, query: np.ndarray, own, k: int, levels: tuple[int, ...] = (8, 0)) -> list[int]:
        """Positions of the ``k`` best rows but those with the id ``own``, ties to smaller ids, and no other rows.

        Impacts are quantised to fractions of the largest one (``levels``: one over 8, zero). A level's postings add
        their impacts to the rows' sums; every posting not read yet is below the level, which bounds each row's score.
        Exact scores of the rows that lead so far give the score to beat. Rows whose bound is below it are out for good;
        once few are left, they are scored exactly. If no level proves enough, all rows are.
        """
        n, dims = self.vectors.shape
        allowed = self.ids != own
        if n <= 64 or n <= 4 * k:
            return self.best(np.flatnonzero(allowed), query, k)
        used = np.flatnonzero(query)
        ends = np.where(query > 0, self.values[:, -1] * query, self.values[:, 0] * query)
        largest = int(ends[used].max()) if len(used) else 0
        total, seen = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        done = np.where(query > 0, n, 0)  # postings from here on (or up to here) are read
        for part in levels:
            level = max(0, largest) // part if part else 0
            for d in used:
                q, values = int(query[d]), self.values[d]
                if q > 0:  # impact >= level: value >= level / q, rounded up
                    to = int(np.searchsorted(values, -(-level // q), side="left"))
                    run = slice(to, done[d])
                else:
                    to = int(np.searchsorted(values, -(level // -q), side="right"))
                    run = slice(done[d], to)
                if run.start < run.stop:
                    rows = self.rows[d, run]
                    total[rows] += q * values[run]
                    seen[rows] += 1
                    done[d] = to
            bound = total + level * (len(used) - seen)
            bound[~allowed] = np.iinfo(np.int64).min
            lead = np.argpartition(bound, n - 2 * k)[n - 2 * k:]
            exact = np.sort(self.vectors[lead[allowed[lead]]] @ query)[::-1]
            if len(exact) < k:
                continue
            possible = np.flatnonzero(bound >= exact[k - 1])
            if len(possible) <= n // 4 or part == levels[-1]:
                return self.best(possible[allowed[possible]], query, k)
        return self.best(np.flatnonzero(allowed), query, k)

    def best(self, rows: np.ndarray, query: np.ndarray, k: int) -> list[int]:
        score = self.vectors[rows] @ query
        by = np.lexsort((self.ids[rows], -score))[:k]
        return [(int(r), int(s)) for r, s in zip(rows[by], score[by], strict=True)]


def search(vectors: DataFrame, every: int = 100, k: int = 10, scale: int = 1024, key: str = "vec_id", vector: str = "embedding",
           rows_per_block: int = 16384, queries_per_block: int = 2048) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each vector whose key is divisible by ``every`` the ``k`` others with the highest
    inner product of the components floor(scale * x), ties to the smaller key; fewer if there are fewer.

    Rows meet in cells of a block of queries and a block of rows: each cell indexes its rows and answers its queries,
    then the best of all cells are ranked. A cell's size doesn't depend on the input, and no row is left out.
    Every row is a vector of its own: of rows that repeat a key each is a query and a candidate, and a row with a null key is a
    candidate, behind all others of its score. Null and empty vectors and those holding null or non-finite components take no
    part. A shorter vector counts as filled up with zeros. An empty table gives no rows; other columns, whatever their names, are not read.
    """
    spark = vectors.sparkSession
    common.ship(spark)
    kind = vectors.schema[key].dataType.simpleString()

    def whole(batches):
        for b in batches:
            ids, out = [], []
            for i, v in enumerate(rows_as_vectors(b.column(1))):
                if v is not None:
                    ids.append(i)
                    out.append(np.floor(v * scale).astype(np.int64).tobytes())
            if ids:
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(ids)), pa.array(out, pa.binary())], names=["id", "vec"])

    ints = vectors.select(F.col(key).alias("_key"), F.col(vector).alias("_vector")).mapInArrow(whole, f"id {kind}, vec binary")
    ints = materialize(ints.withColumn("row", F.monotonically_increasing_id()), "integers")  # numbered once
    is_query = F.col("id") % every == 0
    n, n_queries = ints.agg(F.count("*"), F.count(F.when(is_query, 1))).first()
    parts, query_parts = max(1, -(-n // rows_per_block)), max(1, -(-n_queries // queries_per_block))
    spread = lambda p: F.pmod(F.xxhash64("row"), F.lit(p)).cast("int")
    each = lambda p: F.explode(F.sequence(F.lit(0), F.lit(p - 1)))
    cells = ints.select(each(query_parts).alias("q"), spread(parts).alias("c"), F.lit(0).alias("role"), "id", "row", "vec").union(
        ints.where(is_query).select(spread(query_parts).alias("q"), each(parts).alias("c"), F.lit(1).alias("role"), "id", "row", "vec"))
    cells = cells.repartition("q", "c").sortWithinPartitions("q", "c", "role")

    def answered(batches):
        for g in groups_of(batches, 2):
            role = g.column("role").to_numpy()
            ids, row = g.column("id").combine_chunks(), g.column("row").to_numpy()
            vecs = [np.frombuffer(x, dtype=np.int64) for x in g.column("vec").to_pylist()]
            dims = max(map(len, vecs))
            if min(map(len, vecs)) < dims:
                vecs = [np.pad(v, (0, dims - len(v))) for v in vecs]
            matrix = np.stack(vecs)
            if not (role == 0).any():
                continue
            # Rows take part by their places in the order of keys, null last, so that ties go to the smaller one.
            mine = np.flatnonzero(role == 0)
            missing = ids.is_null().to_numpy(zero_copy_only=False)[mine]
            by = mine[np.lexsort((row[mine], ids.fill_null(0).to_numpy(zero_copy_only=False)[mine], missing))]
            index = Index(np.arange(len(by)), matrix[by])
            place = {r: n for n, r in enumerate(row[by].tolist())}
            out: list[tuple] = []
            for i in np.flatnonzero(role == 1).tolist():
                out += [(i, by[r], s) for r, s in index.top(matrix[i], place.get(int(row[i]), -1), k)]
            if out:
                a, b, s = (np.array(x, dtype=np.int64) for x in zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(a)), pa.array(row[a]), ids.take(pa.array(b)), pa.array(row[b]), pa.array(s)],
                                                 names=["query_id", "query_row", "vec_id", "vec_row", "score"])

    found = cells.mapInArrow(answered, f"query_id {kind}, query_row long, vec_id {kind}, vec_row long, score long")
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "vec_row"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
