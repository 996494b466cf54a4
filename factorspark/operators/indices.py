"""Index-timing indicators, flags and the latest trigger gaps. Every series runs side by side."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factorspark.functions import columns as C
from factorspark.functions import windows as W
from factorspark.operators import calendar as cal

c = F.col
KEY = "series_id"


@dataclass(frozen=True)
class TimingParams:
    """Thresholds of the timing rules (fixed default values)."""

    j_low: float = 1.0
    j_high: float = 95.0
    j_from: float = 90.0
    j_to: float = 80.0
    rsi_os: float = 35.0
    rsi_from: float = 70.0
    rsi_to: float = 65.0
    x_up: float = 20.0
    y_down: float = 14.0
    y_acc: bool = False
    div_2of3: bool = False
    val_gate: bool = True
    ma250_gate: bool = True
    week_j0: bool = False
    val_years: float = 3.0


def weekly_indicators(series: DataFrame, calendar: DataFrame) -> DataFrame:
    """J of the weekly KDJ (seeded with 50) and Wilder RSI(14) at the last day of each complete ISO week.

    A week counts as complete unless the calendar has a trading day of the same week after the last date
    of its series.
    """
    last = F.max("date").over(Window.partitionBy(KEY))
    s = series.withColumns({"wk": C.iso_week_key(c("date")), "last": last})
    wk = s.groupBy(KEY, "wk").agg(F.max_by("px", "date").alias("close"), F.max("date").alias("date"), F.max("last").alias("last"))
    ends = F.broadcast(cal.period_ends(calendar, "weekly").withColumnRenamed("period_key", "wk"))
    wk = wk.join(ends, "wk", "left").filter(~F.coalesce(c("period_end") > c("last"), F.lit(False)))
    w = W.by(KEY)
    lo, hi = W.roll(c("close"), 9, F.min, w), W.roll(c("close"), 9, F.max, w)
    wk = wk.withColumns({"rsv": F.coalesce(C.div(c("close") - lo, C.non_zero(hi - lo)) * 100, F.lit(50.0)),
                         "delta": c("close") - F.lag("close").over(w)})
    wk = wk.withColumns({"up": F.when(c("delta").isNotNull(), F.greatest(c("delta"), F.lit(0.0))),
                         "dn": F.when(c("delta").isNotNull(), F.greatest(-c("delta"), F.lit(0.0))),
                         # The seed of both lines is 50 on the first week.
                         "rsv": F.when(F.row_number().over(w) == 1, F.lit(50.0)).otherwise(c("rsv"))})
    wk = W.with_ewm(wk.select(KEY, "date", "rsv", "up", "dn"),
                    {"k": ("rsv", 1 / 3, 0), "d": ("k", 1 / 3, 0), "wg": ("up", 1 / 14, 14), "wl": ("dn", 1 / 14, 14)}, key=KEY)
    rs = F.when(c("wl") == 0, F.when(c("wg") > 0, F.lit(100.0))).otherwise(100 - C.div(F.lit(100.0), 1 + C.div(c("wg"), c("wl"))))
    return wk.select(KEY, "date", (3 * c("k") - 2 * c("d")).alias("wj"), F.coalesce(rs, F.lit(50.0)).alias("wrsi"))


def timing_indicators(series: DataFrame, calendar: DataFrame, yields: DataFrame, params: TimingParams = TimingParams()) -> DataFrame:
    """All columns the timing flags need. Input: series_id, date, px, close, vol."""
    w = W.by(KEY)
    px = c("px")
    delta = px - F.lag(px).over(w)
    df = series.withColumns({"up": F.when(delta.isNotNull(), F.greatest(delta, F.lit(0.0))),
                             "dn": F.when(delta.isNotNull(), F.greatest(-delta, F.lit(0.0)))})
    # The exponential means come first, while the frame is narrow.
    df = W.with_ewm(df, {"ru": ("up", 1 / 14, 0), "rd": ("dn", 1 / 14, 0), "e12": ("px", 2 / 13, 0), "e26": ("px", 2 / 27, 0),
                         "dea": (("e12", "e26"), 0.2, 0)}, key=KEY)
    df = df.withColumns({
        "ma20": W.roll(px, 20, F.avg, w), "std20": W.roll(px, 20, F.stddev_pop, w), "ma200": W.roll(px, 200, F.avg, w),
        "ma250": W.roll(px, 250, F.avg, w), "lo63": W.prior(px, 63, F.min, w), "hi63": W.prior(px, 63, F.max, w),
        "hi10": W.prior(px, 10, F.max, w), "dif": c("e12") - c("e26"),
        "div_proxy": (C.div(c("close") / px, F.lag(c("close") / px, 252).over(w)) - 1) * 100,
        "vol5": W.roll(F.last("vol", ignorenulls=True).over(W.running(w)), 5, F.avg, w),
    })
    df = df.withColumns({
        "upper": c("ma20") + 2 * c("std20"), "lower": c("ma20") - 2 * c("std20"),
        "up63": (C.div(px, c("lo63")) - 1) * 100, "dn63": (C.div(px, c("hi63")) - 1) * 100, "dn10": (C.div(px, c("hi10")) - 1) * 100})
    # Weekly values and the yield hold from the day they are known on.
    y = yields.groupBy("date").agg(F.max("y10").alias("y10"))  # one row per day
    df = df.join(weekly_indicators(series, calendar), [KEY, "date"], "left").join(F.broadcast(y), "date", "left")
    df = df.withColumns({k: F.last(k, ignorenulls=True).over(W.running(w)) for k in ("wj", "wrsi", "y10")})
    df = df.withColumn("spread", c("div_proxy") - c("y10"))
    n = int(params.val_years * 252)
    places = df.select(KEY, "date", F.round("spread", 9).alias("__s"))
    places = W.with_rolling_ranks(places, {"spread": ("__s", n, int(n * 0.8), 0.0)}, key=KEY).select(KEY, "date", c("spread_pct"))
    df = df.join(places, [KEY, "date"])
    df = df.withColumns({"rsi": F.when(c("rd") == 0, F.when(c("ru") > 0, F.lit(100.0))).otherwise(100 - C.div(F.lit(100.0), 1 + C.div(c("ru"), c("rd")))),
                         "macd_hist": 2 * (c("dif") - c("dea"))})
    return df.withColumns({"hi10rsi": W.prior(c("rsi"), 10, F.max, w), "hi10macd": W.prior(c("macd_hist"), 10, F.max, w),
                           "j10": W.roll(c("wj"), 10, F.max, w), "r10": W.roll(c("wrsi"), 10, F.max, w)})


def timing_flags(df: DataFrame, params: TimingParams = TimingParams()) -> DataFrame:
    """Oversold (two of four), overbought, divergence, crosses and lost momentum."""
    p, px = params, c("px")
    t = lambda cond: F.coalesce(cond, F.lit(False))
    one = lambda cond: t(cond).cast("int")
    drop = c("dn63") <= -p.y_down
    if p.y_acc:
        drop = drop & (c("dn10") <= c("dn63") * 0.6)
    oversold = (one(c("wj") < p.j_low) + one(px <= c("lower")) + one(drop) + one(c("wrsi") < p.rsi_os)) >= 2
    if p.val_gate:
        oversold = oversold & t(c("spread_pct") >= 0.5)
    if p.ma250_gate:
        oversold = oversold & t(px < c("ma250"))
    if p.week_j0:
        oversold = oversold & t(c("wj") < 0)
    higher = px > c("hi10")
    diverg = t(higher & (c("rsi") < c("hi10rsi")))
    if p.div_2of3:
        diverg = (diverg.cast("int") + one(higher & (c("macd_hist") < c("hi10macd"))) + one(higher & (c("vol") < c("vol5")))) >= 2
    df = df.withColumns({
        "os_half": t(c("spread_pct").between(0.5, 0.8)), "oversold": oversold,
        "overbought": t((c("wj") > p.j_high) & (px >= c("upper")) & (c("up63") >= p.x_up)), "diverg": diverg,
        "j_cross": t((c("j10") > p.j_from) & (c("wj") <= p.j_to)), "rsi_cross": t((c("r10") > p.rsi_from) & (c("wrsi") <= p.rsi_to))})
    return df.withColumn("momentum_lost", c("j_cross") | c("rsi_cross") | c("diverg"))


def trigger_gaps(df: DataFrame, params: TimingParams = TimingParams()) -> DataFrame:
    """Latest row per series with the distance to each trigger, in percent of the price."""
    p = params
    latest = df.groupBy(KEY).agg(F.max_by(F.struct(*[x for x in df.columns if x != KEY]), "date").alias("r")).select(KEY, "r.*")
    px = c("px")
    hits = sum(F.coalesce(x, F.lit(False)).cast("int") for x in (c("wj") < p.j_low, px <= c("lower"), c("dn63") <= -p.y_down, c("wrsi") < p.rsi_os))
    out = latest.withColumns({"hits": hits, "hi63_next": F.greatest(c("hi63"), px)})
    pos = lambda x: F.greatest(F.lit(0.0), x)
    return out.withColumns({
        "need": F.greatest(F.lit(0), 2 - c("hits")),
        "band_gap": pos((px / c("lower") - 1) * 100),
        "dn63_gap": pos((1 - c("hi63_next") * (1 - p.y_down / 100) / px) * 100),
        "band_up_gap": pos((c("upper") / px - 1) * 100),
        "up63_gap": pos((c("lo63") * (1 + p.x_up / 100) / px - 1) * 100),
        "j_need_drop": pos(c("wj") - p.j_to), "rsi_need_drop": pos(c("wrsi") - p.rsi_to)})
