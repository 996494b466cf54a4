"""Joins beyond equality: as-of, spine, previous-day and interval joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

c = F.col


def asof_by_date(left: DataFrame, right: DataFrame, values: Sequence[str]) -> DataFrame:
    """Latest right row on or before each left date, for one series without keys.

    The fill runs once per distinct date (bounded by the calendar), then an equality join carries it to
    all left rows.
    """
    fill = right.groupBy("date").agg(F.max(F.struct(*values)).alias("__v"))  # one row per date, of several the greatest
    spine = left.select("date").distinct().join(fill, "date", "full_outer")
    w = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    filled = spine.select("date", F.last("__v", ignorenulls=True).over(w).alias("__v"))
    out = left.join(filled, "date", "left")
    return out.select(*left.columns, *[c(f"__v.{v}").alias(v) for v in values])


def asof_join(left: DataFrame, right: DataFrame, keys: Sequence[str], values: Sequence[str], bucket: str = "year") -> DataFrame:
    """Latest right row per key on or before each left date.

    Keys are cut into time buckets so that one long key spreads over many tasks. What earlier buckets
    leave behind is one row per (key, bucket) and is carried over by a window on those rows alone.
    """
    k = list(keys)
    b = F.trunc("date", bucket)
    v = F.struct(*values)
    rr = right.select(*k, "date", v.alias("__v")).withColumn("__b", b)
    ll = left.withColumn("__b", b)
    ends = rr.groupBy(*k, "__b").agg(F.max_by("__v", "date").alias("__end"))
    slots = ll.select(*k, "__b").distinct().join(ends, [*k, "__b"], "full_outer")
    before = Window.partitionBy(*k).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    carry = slots.select(*k, "__b", F.last("__end", ignorenulls=True).over(before).alias("__carry"))
    both = ll.withColumn("__left", F.lit(True)).unionByName(rr.withColumn("__left", F.lit(False)), allowMissingColumns=True)
    # A right row of the same day comes first, so the left row of that day sees it.
    inside = Window.partitionBy(*k, "__b").orderBy("date", "__left").rowsBetween(Window.unboundedPreceding, 0)
    hit = both.withColumn("__in", F.last("__v", ignorenulls=True).over(inside)).filter("__left")
    out = hit.join(carry, [*k, "__b"], "left").withColumn("__x", F.coalesce("__in", "__carry"))
    return out.select(*left.columns, *[c(f"__x.{n}").alias(n) for n in values])


def reindex(df: DataFrame, dates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every key on every date, null where df has no row. Keys unfold over one date array (bounded by
    the calendar) instead of a product of two tables."""
    k = list(keys)
    days = dates.select("date").distinct().agg(F.array_sort(F.collect_list("date"))).scalar()
    spine = df.select(*k).distinct().withColumn("date", F.explode(days))
    return spine.join(df, [*k, "date"], "left")


def previous_day(df: DataFrame, calendar: DataFrame, keys: Sequence[str], values: Sequence[str], prefix: str = "prev_") -> DataFrame:
    """Add the row of the trading day before with the same keys."""
    k = list(keys)
    cal = F.broadcast(calendar.select("date", "td_idx"))
    cur = df.join(cal, "date")
    prev = cur.select(*k, (c("td_idx") + 1).alias("td_idx"), *[c(v).alias(prefix + v) for v in values])
    return cur.join(prev, [*k, "td_idx"], "left")


def interval_join(points: DataFrame, blocks: DataFrame, point: str, lo: str, hi: str) -> DataFrame:
    """Points with lo <= point < hi. Blocks come from the calendar, so they are few and broadcast."""
    return points.join(F.broadcast(blocks), (c(point) >= c(lo)) & (c(point) < c(hi)))
