"""Limit-up facts, board ladders, pool summaries and broker seats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factorspark.functions import columns as C
from factorspark.functions import windows as W
from factorspark.session import materialize

c = F.col


def limit_up_flags(bars: DataFrame) -> DataFrame:
    """Previous close, threshold, change and the limit-up flag."""
    w = W.by()
    df = bars.withColumns({"prev_close": F.lag("close").over(w), "threshold": C.limit_threshold(c("code"))})
    # The limit price is rounded half up to cents; the small term keeps 0.005 from falling down.
    limit = F.rint((c("prev_close") * (1 + c("threshold") / 100) + 1e-9) * 100) / 100
    return df.withColumns({
        "change_rate": (C.div(c("close"), c("prev_close")) - 1) * 100,
        "limit_up": F.coalesce(c("close") >= limit - 0.001, F.lit(False)).cast("bigint")})


def limit_up_daily(bars: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Limit-up facts per (code, date): flag, run length and counts in the last 3, 5 and 10 rows."""
    w = W.by()
    df = limit_up_flags(bars)
    df = W.with_streak(df, c("limit_up") == 1, "limit_count", w)
    df = df.withColumns({f"m{n}": F.sum("limit_up").over(W.last_rows(w, n)) for n in (3, 5, 10)})
    cols = ["date", "code", "close", "change_rate", "limit_up", "limit_count", "m3", "m5", "m10", "threshold"]
    return df.select(*cols) if names is None else df.join(names.select("code", "name"), "code", "left").select(*cols, "name")


def limit_up_day(bars: DataFrame, day: str) -> DataFrame:
    """The facts of one day. A run may be as long as the history, so all bars up to the day count."""
    d = F.lit(day).cast("date")
    return limit_up_daily(bars.filter(c("date") <= d)).filter(c("date") == d)


def ladder(daily: DataFrame, calendar: DataFrame | None = None) -> DataFrame:
    """Names per run length and day against the names one step lower on the day before.

    The day before is the previous trading day when a calendar is given, else the previous day that has
    any limit-up; in that batch form the first day gives no rows. The rate is null where nobody stood
    one step lower.
    """
    dist = daily.filter(c("limit_count") > 0).groupBy("date", c("limit_count").alias("lbc")).agg(F.count("*").alias("count"))
    if calendar is not None:
        days = F.broadcast(calendar.select("date", c("td_idx").alias("k")))
    else:
        w = Window.orderBy("date")
        days = F.broadcast(dist.select("date").distinct().withColumn("k", F.row_number().over(w).cast("bigint")))
    cur = dist.join(days, "date")
    prev = cur.select((c("k") + 1).alias("k"), (c("lbc") + 1).alias("lbc"), c("count").alias("prev_count"))
    out = cur.join(prev, ["k", "lbc"], "left").withColumn("prev_count", F.coalesce("prev_count", F.lit(0)))
    if calendar is None:
        out = out.filter(c("k") > 1)
    return out.select("date", "lbc", "count", "prev_count", C.div(c("count").cast("double"), c("prev_count").cast("double")).alias("promote_rate"))


def pool_summary(daily: DataFrame, broken: DataFrame, longest: int | None = None) -> DataFrame:
    """Per day: limit-ups, broken limits, longest run and the distribution of runs; with ``longest`` of those up to it."""
    dist = daily.filter(c("limit_count") > 0).groupBy("date", "limit_count").agg(F.count("*").alias("n"))
    counted = F.lit(True) if longest is None else c("limit_count") <= longest
    up = dist.groupBy("date").agg(
        F.sum("n").alias("zt_count"), F.max("limit_count").alias("max_lb"),
        F.map_from_entries(F.array_sort(F.collect_list(F.when(counted, F.struct("limit_count", "n"))))).alias("lb_dist"))
    zb = broken.groupBy("date").agg(F.count("*").alias("zb_count"))
    return up.join(zb, "date", "full_outer").select(
        "date", F.coalesce("zt_count", F.lit(0)).alias("zt_count"), F.coalesce("zb_count", F.lit(0)).alias("zb_count"),
        F.coalesce("max_lb", F.lit(0)).alias("max_lb"), F.to_json("lb_dist").alias("lb_dist"))


SEAT_GROUP = ("date", "code", "trade_id", "side")


def seat_amount() -> Column:
    return F.when(c("side") == "buy", F.coalesce("buy", F.lit(0.0))).otherwise(F.coalesce("sell", F.lit(0.0)))


def top_seats(seats: DataFrame, n: int) -> DataFrame:
    """The first ``n`` ranks only: each task keeps the best of a group before the shuffle, so no group meets whole."""
    w = Window.partitionBy(*SEAT_GROUP).orderBy(seat_amount().desc(), "seat_code")
    return seats.withColumn("rank", F.row_number().over(w).cast("bigint")).filter(c("rank") <= n)


def rank_seats(seats: DataFrame, pieces: int | None = None) -> DataFrame:
    """Rank per (date, code, trade, side) by the amount of that side, equal amounts by seat code; large groups are split."""
    d = seats.withColumn("__less", -seat_amount())
    return W.with_row_number(d, SEAT_GROUP, ["__less", "seat_code"], "rank", pieces).select(*seats.columns, "rank")


def seat_net(seats: DataFrame) -> DataFrame:
    """Net amount and activity per seat."""
    return seats.groupBy("seat_code").agg(
        F.round(F.sum("buy") - F.sum("sell"), 2).alias("net"), F.countDistinct("code").alias("codes"), F.count("*").alias("rows"))


def institution_totals(seats: DataFrame, institutions: list[str]) -> DataFrame:
    """Buy, sell and net of institution seats per (date, code)."""
    s = seats.filter(c("seat_code").isin(institutions))
    return s.groupBy("date", "code").agg(F.round(F.sum("buy"), 2).alias("buy"), F.round(F.sum("sell"), 2).alias("sell"),
                                         F.round(F.sum("buy") - F.sum("sell"), 2).alias("net"))
