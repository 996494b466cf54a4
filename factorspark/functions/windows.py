"""Window building blocks.

Per-code windows run over daily bars, whose rows per code are bounded by the calendar: the bars are
grouped (with map-side combine) before any window sees them, so a code that holds a third of the raw
rows still has one row per day here.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factorspark.session import materialize


def by(key: str | Sequence[str] = "code", order: str = "date") -> WindowSpec:
    keys = [key] if isinstance(key, str) else list(key)
    return Window.partitionBy(*keys).orderBy(order)


def last_rows(w: WindowSpec, n: int) -> WindowSpec:
    return w.rowsBetween(-(n - 1), 0)


def running(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, 0)


def roll(c: Column, n: int, fn: Callable[[Column], Column], w: WindowSpec, min_periods: int | None = None) -> Column:
    """Rolling aggregate over n rows; null unless min_periods (default n) values are present."""
    frame = last_rows(w, n)
    return F.when(F.count(c).over(frame) >= (n if min_periods is None else min_periods), fn(c).over(frame))


def prior(c: Column, n: int, fn: Callable[[Column], Column], w: WindowSpec) -> Column:
    """Rolling aggregate over the n rows before the current one."""
    frame = w.rowsBetween(-n, -1)
    return F.when(F.count(c).over(frame) == n, fn(c).over(frame))


def ret(c: Column, n: int, w: WindowSpec) -> Column:
    return F.try_divide(c, F.lag(c, n).over(w)) - 1


def corr(x: Column, y: Column, frame: WindowSpec | None = None) -> Column:
    """Correlation that is null, not an error, where one side is constant."""
    over = (lambda a: a) if frame is None else (lambda a: a.over(frame))
    return F.try_divide(over(F.covar_pop(x, y)), over(F.stddev_pop(x)) * over(F.stddev_pop(y)))


def product_of(x: Column, over: Callable[[Column], Column] = lambda a: a) -> Column:
    """Product of the values of an aggregate or window: zeros and signs are counted beside the sum of logarithms. Null
    where no value is there; null values are skipped."""
    zeros = over(F.count_if(x == 0))
    negative = over(F.count_if(x < 0))
    size = F.exp(F.coalesce(over(F.sum(F.when(x != 0, F.ln(F.abs(x))))), F.lit(0.0)))
    signed = F.when(negative % 2 == 1, -size).otherwise(size)
    return F.when(over(F.count(x)) > 0, F.when(zeros > 0, F.lit(0.0)).otherwise(signed))


def cumprod(r: Column, w: WindowSpec) -> Column:
    """Running product of 1 + r, where a null return counts as zero; a total loss keeps the product at zero."""
    return product_of(1 + F.coalesce(r, F.lit(0.0)), lambda a: a.over(running(w)))


def drawdown(nav: Column, w: WindowSpec) -> Column:
    return F.try_divide(nav, F.max(nav).over(running(w))) - 1


def avg_rank(v: Column, by_cols: Sequence[str], ascending: bool = True) -> Column:
    """Rank with averaged ties in a cross-section of few members (industries); nulls stay null and do not count."""
    order = v.asc_nulls_last() if ascending else v.desc_nulls_last()
    x = Window.partitionBy(*by_cols).orderBy(order)
    upto = F.count(v).over(x.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    return F.when(v.isNotNull(), (F.rank().over(x) + upto) / F.lit(2.0))


def pct_rank(v: Column, by_cols: Sequence[str], ascending: bool = True) -> Column:
    """Averaged rank as a share of the non-null values, for few members; see share_columns for names."""
    return avg_rank(v, by_cols, ascending) / F.count(v).over(Window.partitionBy(*by_cols))


def zscore(v: Column, by_cols: Sequence[str]) -> Column:
    """Population z-score in a cross-section of few members; zero where the spread vanishes."""
    x = Window.partitionBy(*by_cols)
    sd = F.stddev_pop(v).over(x)
    return F.when(v.isNotNull(), F.when(sd > 1e-12, (v - F.avg(v).over(x)) / sd).otherwise(F.lit(0.0)))


def zscore_columns(df: DataFrame, specs: dict[str, str], by_cols: Sequence[str]) -> DataFrame:
    """Population z-scores: specs maps the new column to its input. One row of means and spreads per cross-section is joined,
    so no cross-section meets in one task."""
    df = materialize(df, "scores")
    stats = [f(v).alias(f"__{n}_{v}") for v in dict.fromkeys(specs.values()) for n, f in (("m", F.avg), ("s", F.stddev_pop))]
    out = df.join(df.groupBy(*by_cols).agg(*stats), list(by_cols), "left")
    z = {o: F.when(F.col(v).isNotNull(), F.when(F.col(f"__s_{v}") > 1e-12, (F.col(v) - F.col(f"__m_{v}")) / F.col(f"__s_{v}")).otherwise(F.lit(0.0)))
         for o, v in specs.items()}
    return out.withColumns(z).select(*df.columns, *specs)


def with_rolling_ranks(df: DataFrame, specs: dict[str, tuple[str, int, int, float]], key: str = "code", order: str = "date") -> DataFrame:
    """Where each value stands among the last n of its key, as new columns ``<name>_le`` and ``<name>_pct``.

    specs maps a name to (column, n, min_periods, slack): ``_le`` is the share of the last n values that are at most the
    current one plus the slack and needs n of them, ``_pct`` the averaged rank as a share of the values present and
    needs min_periods. Each key's bars (bounded by the calendar) pass once through numpy, which compares a block of
    windows at a time, so no row carries a list of its window.
    """
    outs = [f"{o}_{kind}" for o in specs for kind in ("le", "pct")]
    schema = T.StructType(list(df.schema.fields) + [T.StructField(o, T.DoubleType()) for o in outs])
    names = schema.fieldNames()

    def rank(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        for out, (col, n, min_periods, slack) in specs.items():
            x = pdf[col].to_numpy(dtype=float, na_value=np.nan)
            windows = np.lib.stride_tricks.sliding_window_view(np.concatenate([np.full(n - 1, np.nan), x]), n)
            le, pct = np.full(len(x), np.nan), np.full(len(x), np.nan)
            step = max(1, (1 << 22) // n)
            for lo in range(0, len(x), step):
                w, v = windows[lo:lo + step], x[lo:lo + step, None]
                there = (~np.isnan(w)).sum(1)
                here = ~np.isnan(v[:, 0])
                share = (w <= v + slack).sum(1) / n
                middle = ((w < v).sum(1) + ((w == v).sum(1) + 1) / 2) / np.maximum(there, 1)
                le[lo:lo + step] = np.where(here & (there == n), share, np.nan)
                pct[lo:lo + step] = np.where(here & (there >= min_periods), middle, np.nan)
            pdf[f"{out}_le"], pdf[f"{out}_pct"] = le, pct
        return pdf[names]

    ranked = df.groupBy(key).applyInPandas(rank, schema)
    return ranked.withColumns({o: F.nanvl(c, F.lit(None).cast("double")) for o in outs for c in [F.col(o)]})


def with_streak(df: DataFrame, flag: Column, out: str, w: WindowSpec, keys: Sequence[str] = ("code",),
                order: str = "date", offset: int = 0) -> DataFrame:
    """Length of the run of true values ending at each row; offset is added inside every run that a
    false row of the same key opens."""
    seg = F.sum(F.when(F.coalesce(flag, F.lit(False)), 0).otherwise(1)).over(running(w))
    df = df.withColumn("__flag", F.coalesce(flag, F.lit(False))).withColumn("__seg", seg)
    run = Window.partitionBy(*keys, "__seg").orderBy(order)
    n = F.sum(F.col("__flag").cast("int")).over(running(run))
    led = F.when(F.col("__seg") > 0, F.lit(offset)).otherwise(F.lit(0))
    return df.withColumn(out, F.when(F.col("__flag"), (n + led).cast("long")).otherwise(F.lit(0).cast("long"))).drop(
        "__flag", "__seg")


def with_ewm(df: DataFrame, specs: dict[str, tuple[str | tuple[str, str], float, int]], key: str = "code", order: str = "date") -> DataFrame:
    """Exponentially weighted means y = (1-a)·y + a·x per key, added as new columns.

    specs maps the new column to (input, alpha, min_periods). An input is a column, an earlier output, or a
    pair (a, b) that stands for a - b. The recursion has no built-in window form, so each key's bars
    (bounded by the calendar) pass once through pandas in Arrow batches: call this early, while the frame
    is narrow, and once per query.
    """
    schema = T.StructType(list(df.schema.fields) + [T.StructField(o, T.DoubleType()) for o in specs])
    names = schema.fieldNames()

    def smooth(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        for out, (col, alpha, min_periods) in specs.items():
            x = pdf[col] if isinstance(col, str) else pdf[col[0]] - pdf[col[1]]
            pdf[out] = x.astype("float64").ewm(alpha=alpha, adjust=False, min_periods=min_periods).mean()
        return pdf[names]

    return df.groupBy(key).applyInPandas(smooth, schema)


def positions(rows: DataFrame, keys: Sequence[str], value: str, pieces: int | None = None) -> DataFrame:
    """``keys, value, first, last, n``: the distinct values of each group with the 0-based positions of their first and last copy
    in sorted order, and the group's size; null values don't count.

    One plan for groups of any size: copies are combined first, one sort by ranges deals all groups out at once (small ones whole,
    large ones over several tasks, ``pieces`` in all if given), positions run inside a piece, and the counts of a group's earlier
    pieces are added. The pieces are written, so that a lost task cannot cut them anew.
    """
    k = list(keys)
    counts = rows.filter(F.col(value).isNotNull()).groupBy(*k, value).agg(F.count("*").alias("__n"))
    ranged = counts.repartitionByRange(pieces, *k, value) if pieces else counts.repartitionByRange(*k, value)
    ranged = materialize(ranged.withColumn("__b", F.spark_partition_id()), "pieces")
    group = Window.partitionBy(*k)
    earlier = F.sum("__bn").over(group.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1))
    sizes = ranged.groupBy(*k, "__b").agg(F.sum("__n").alias("__bn")).select(
        *k, "__b", F.coalesce(earlier, F.lit(0)).alias("__earlier"), F.sum("__bn").over(group).alias("n"))
    inside = Window.partitionBy(*k, "__b").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("__earlier") + F.coalesce(F.sum("__n").over(inside), F.lit(0))
    return ranged.join(sizes, [*k, "__b"]).select(*k, value, first.alias("first"), (first + F.col("__n") - 1).alias("last"), "n")


def with_positions(df: DataFrame, values: Sequence[str], by_cols: Sequence[str], pieces: int | None = None) -> DataFrame:
    """df with a struct ``__at_<value>`` (first, last, n; see positions) for each of the number columns ``values``, null where the
    value is null. All columns are ranked in one pass; df is written once and read by both sides of the join."""
    k = list(by_cols)
    df = materialize(df.withColumn("__row", F.monotonically_increasing_id()), "ranks")
    cells = F.array(*[F.struct(F.lit(i).alias("f"), F.col(v).cast("double").alias("v")) for i, v in enumerate(values)])
    cells = df.select("__row", *k, F.explode(cells).alias("__x")).select("__row", *k, F.col("__x.f").alias("__f"), F.col("__x.v").alias("__v"))
    cells = cells.filter(F.col("__v").isNotNull())
    at = cells.join(positions(cells, [*k, "__f"], "__v", pieces), [*k, "__f", "__v"]).select("__row", "__f", F.struct("first", "last", "n").alias("at"))
    if len(values) == 1:
        at = at.select("__row", F.col("at").alias(f"__at_{values[0]}"))
    else:
        at = at.groupBy("__row").agg(*[F.max(F.when(F.col("__f") == i, F.col("at"))).alias(f"__at_{v}") for i, v in enumerate(values)])
    return df.join(at, "__row", "left").drop("__row")


def _rank_of(value: str, ascending: bool) -> Column:
    at = F.col(f"__at_{value}")
    up = (at["first"] + at["last"]) / F.lit(2.0) + 1
    return up if ascending else at["n"] + 1 - up


def rank_columns(df: DataFrame, specs: dict[str, tuple[str, bool]], by_cols: Sequence[str], counts: bool = False, pieces: int | None = None) -> DataFrame:
    """Ranks in the cross-section with averaged ties: specs maps the new column to (column, ascending); nulls stay null. With
    ``counts`` also ``n_<new column>``, the number of values ranked."""
    inputs = list(dict.fromkeys(v for v, _ in specs.values()))
    out = with_positions(df, inputs, by_cols, pieces).withColumns({o: _rank_of(v, up) for o, (v, up) in specs.items()})
    if counts:
        out = out.withColumns({f"n_{o}": F.col(f"__at_{v}")["n"] for o, (v, _) in specs.items()})
    return out.drop(*[f"__at_{v}" for v in inputs])


def share_columns(df: DataFrame, specs: dict[str, tuple[str, bool]], by_cols: Sequence[str]) -> DataFrame:
    """Averaged ranks as a share of the non-null values of the cross-section (0 < p <= 1)."""
    inputs = list(dict.fromkeys(v for v, _ in specs.values()))
    out = with_positions(df, inputs, by_cols)
    return out.withColumns({o: _rank_of(v, up) / F.col(f"__at_{v}")["n"] for o, (v, up) in specs.items()}).drop(*[f"__at_{v}" for v in inputs])


def group_quantiles(df: DataFrame, value: str, by_cols: Sequence[str], cuts: Sequence[float], out: str,
                    pieces: int | None = None) -> DataFrame:
    """Interpolated quantiles per group as one array, from the exact positions of the distinct values."""
    k = list(by_cols)
    pos = positions(df, k, value, pieces)
    points = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(q)).alias("q")) for i, q in enumerate(cuts)])
    marks = pos.withColumn("__p", F.explode(F.transform(points, lambda p: F.struct(p["i"].alias("i"), (p["q"] * (F.col("n") - 1)).alias("at")))))
    at, lo, hi = F.col("__p.at"), F.col("first"), F.col("last")
    # A quantile between two values takes each with the weight of its distance.
    share = F.when((F.floor(at) >= lo) & (F.floor(at) <= hi), 1 - (at - F.floor(at))).otherwise(0.0) + F.when(
        (F.floor(at) + 1 >= lo) & (F.floor(at) + 1 <= hi), at - F.floor(at)).otherwise(0.0)
    edges = marks.withColumn("__w", share).filter(F.col("__w") > 0).groupBy(*k, F.col("__p.i").alias("__i")).agg(
        F.sum(F.col("__w") * F.col(value)).alias("__e"))
    return edges.groupBy(*k).agg(F.array_sort(F.collect_list(F.struct("__i", "__e"))).alias("__a")).select(
        *k, F.transform("__a", lambda x: x["__e"]).alias(out))


def with_row_number(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str, pieces: int | None = None) -> DataFrame:
    """The 1-based place of each row in its group by ``order`` (ascending). As in positions, one sort by ranges splits large groups
    and the counts of a group's earlier pieces are added; df is written once."""
    k = list(keys)
    ranged = df.repartitionByRange(pieces, *k, *order) if pieces else df.repartitionByRange(*k, *order)
    ranged = materialize(ranged.withColumn("__b", F.spark_partition_id()), "pieces")
    earlier = F.sum("__bn").over(Window.partitionBy(*k).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1))
    sizes = ranged.groupBy(*k, "__b").agg(F.count("*").alias("__bn")).select(*k, "__b", F.coalesce(earlier, F.lit(0)).alias("__earlier"))
    inside = F.row_number().over(Window.partitionBy(*k, "__b").orderBy(*order))
    numbered = ranged.withColumn("__place", inside).join(sizes, [*k, "__b"])
    return numbered.select(*df.columns, (F.col("__earlier") + F.col("__place")).cast("bigint").alias(out))


def bucketed_rank(df: DataFrame, value: str, by_cols: Sequence[str], out: str, pieces: int = 64) -> DataFrame:
    """Averaged rank, the groups being dealt out in the given number of pieces."""
    return rank_columns(df, {out: (value, True)}, by_cols, pieces=pieces)
