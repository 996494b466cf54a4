"""Industry baskets, sector factors and market caps, all on the long (industry, date) form."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from factorspark.functions import columns as C
from factorspark.functions import windows as W

c = F.col
IND = "industry"


@dataclass(frozen=True)
class SectorParams:
    """Windows and thresholds of the sector model (fixed default values)."""

    min_member_bars: int = 60
    min_history: int = 250
    crowd_window: int = 756
    turnover_window: int = 60
    vol_cut: float = 0.70
    vol_mult: float = 0.7
    crowd_cut: float = 0.80
    crowd_mult: float = 0.85
    reversal_cut: float = 0.10
    reversal_bonus: float = 0.15
    top_n: int = 4
    market_window: int = 60
    market_look: int = 252


def day_index(df: DataFrame) -> DataFrame:
    """Position of every date that occurs in df: one row per day, bounded by the calendar."""
    days = df.select("date").distinct().agg(F.array_sort(F.collect_list("date")).alias("d"))
    return days.select(F.posexplode("d").alias("p", "date")).select("date", (c("p") + 1).cast("double").alias("i"))


def trend_momentum(px: Column, i: Column, n: int, span: int, w: WindowSpec, skip: int = 0) -> Column:
    """Annualised move over n rows (leaving out the last ``skip``) times the fit of ln price on time."""
    frame = W.last_rows(w, n)
    end = px if skip == 0 else F.lag(px, skip).over(w)
    move = F.try_divide(end, F.lag(px, n).over(w))
    r = W.corr(F.ln(px), i, frame)
    full = F.count(px).over(frame) == n
    return F.when(full, (F.pow(move, F.lit(252.0 / span)) - 1) * F.pow(r, F.lit(2.0)))


def panel(members: DataFrame, params: SectorParams = SectorParams()) -> DataFrame:
    """Industry baskets on the grid of all panel dates.

    Members need more than ``min_member_bars`` bars. Return and turnover are means over members, amount
    is a sum and the price is the running product of the returns. ``avail_days`` counts the days with a
    basket so far; days without one stay null.
    """
    w = Window.partitionBy("code").orderBy("date")
    m = members.select(IND, "code", "date", "close", "amount", "turnover").withColumns({
        "ret": W.ret(c("close"), 1, w), "n_bars": F.count("*").over(Window.partitionBy("code"))})
    m = m.filter(c("n_bars") > params.min_member_bars)
    b = m.groupBy(IND, "date").agg(F.avg("ret").alias("ret"), F.sum("amount").alias("amount"), F.avg("turnover").alias("turnover"))
    x = W.by(IND)
    b = b.withColumn("price", W.cumprod(c("ret"), x) * 100)
    days = day_index(b)
    dates = days.agg(F.array_sort(F.collect_list(F.struct("date", "i")))).scalar()
    grid = b.select(IND).distinct().withColumn("d", F.explode(dates)).select(IND, "d.date", "d.i")
    g = grid.join(b, [IND, "date"], "left")
    active = c("price").isNotNull()
    return g.withColumns({"active": active, "avail_days": F.sum(active.cast("int")).over(W.running(x))})


def factors(p: DataFrame, params: SectorParams = SectorParams()) -> DataFrame:
    """Momentum, volatility, crowding and reversal per (industry, date) and the score."""
    w = W.by(IND)
    px = c("price")
    f = p.withColumns({
        "mom20": trend_momentum(px, c("i"), 20, 14, w, skip=6),
        "mom60": trend_momentum(px, c("i"), 60, 60, w),
        "mom120": trend_momentum(px, c("i"), 120, 120, w),
        "vol20": W.roll(c("ret"), 20, F.stddev_pop, w) * F.sqrt(F.lit(252.0)),
        "to_mean": W.roll(c("turnover"), params.turnover_window, F.avg, w),
        "share": C.div(c("amount"), F.sum("amount").over(Window.partitionBy("date"))),
        "r5": C.div(px, F.lag(px, 5).over(w)) - 1,
    })
    f = f.withColumns({
        "mom_raw": (c("mom20") + c("mom60") + c("mom120")) / 3.0,
        "share_chg": C.div(c("share"), F.lag("share", 60).over(w)) - 1,
    })
    n = params.crowd_window
    f = W.with_rolling_ranks(f, {"__t": ("to_mean", n, n, 0.0), "__c": ("share_chg", n, n, 0.0)}, key=IND)
    f = f.withColumn("crowd", 0.5 * c("__t_le") + 0.5 * c("__c_le"))
    pooled = c("avail_days") >= params.min_history
    f = f.withColumn("pooled", pooled)
    f = f.withColumns({k: F.when(pooled, c(k)) for k in ("mom_raw", "vol20", "crowd", "r5")})
    d = ["date"]
    f = f.withColumns({
        "mom_z": W.zscore(c("mom_raw"), d), "vol_pct": W.pct_rank(c("vol20"), d), "crowd_pct": W.pct_rank(c("crowd"), d),
        "r5_pct": W.pct_rank(c("r5"), d), "n_pooled": F.sum(pooled.cast("int")).over(Window.partitionBy("date"))})
    f = f.withColumns({
        "vol_mult": F.when(c("vol_pct") >= params.vol_cut, params.vol_mult).otherwise(1.0),
        "crowd_mult": F.when(c("crowd_pct") >= params.crowd_cut, params.crowd_mult).otherwise(1.0),
        "rev_bonus": F.when(c("r5_pct") < F.greatest(F.lit(params.reversal_cut), C.div(F.lit(1.0), c("n_pooled"))),
                            params.reversal_bonus).otherwise(0.0)})
    f = f.withColumn("score", F.when(c("pooled"), c("mom_z") * c("vol_mult") * c("crowd_mult") + c("rev_bonus")))
    return f.select(IND, "date", "i", "ret", "pooled", "mom_raw", "mom_z", "vol20", "vol_pct", "crowd", "crowd_pct", "r5", "r5_pct",
                    "vol_mult", "crowd_mult", "rev_bonus", "score")


def month_end(df: DataFrame) -> DataFrame:
    """Distinct dates with a flag on the last one of each month (the very last date counts)."""
    days = df.select("date").distinct()
    w = Window.orderBy("date")  # one row per day
    nxt = F.lead("date").over(w)
    return days.select("date", (nxt.isNull() | (F.trunc(nxt, "month") != F.trunc("date", "month"))).alias("month_end"))


def rank_snapshot(f: DataFrame, day: str | None = None, back: int = 20) -> DataFrame:
    """Ranking of the last (or given) day with the change against the ranking ``back`` rows earlier."""
    last = F.lit(day).cast("date") if day is not None else f.agg(F.max("date")).scalar()
    now_i = f.filter(c("date") == last).agg(F.max("i")).scalar()
    rows = f.filter((c("i") == now_i) | (c("i") == F.greatest(now_i - back, F.lit(1.0))))
    w = Window.partitionBy("i").orderBy(c("score").desc(), IND)
    rows = rows.filter(c("score").isNotNull()).withColumn("rank", F.row_number().over(w).cast("bigint"))
    now = rows.filter(c("i") == now_i)
    old = rows.filter(c("i") == F.greatest(now_i - back, F.lit(1.0))).select(IND, c("rank").alias("old"))
    return now.join(old, IND, "left").withColumn("rank_chg", c("rank") - F.coalesce("old", "rank")).drop("old")


def market_cap_scale(series: DataFrame, params: SectorParams = SectorParams()) -> DataFrame:
    """Volatility percentile of the market among the windows inside the last year, and the exposure cap."""
    w = W.by("series_id")
    df = series.withColumn("r", F.coalesce(C.div(c("close"), F.lag("close").over(w)) - 1, F.lit(0.0)))
    df = df.withColumn("v", W.roll(c("r"), params.market_window, F.stddev_pop, w))
    n = params.market_look - params.market_window + 1
    # Equal windows count as <=, so compare beyond rounding noise.
    df = W.with_rolling_ranks(df, {"__v": ("v", n, n, 1e-15)}, key="series_id")
    df = df.withColumn("mk_pct", F.coalesce("__v_le", F.lit(0.0))).drop("__v_le", "__v_pct")
    return df.withColumn("mk_scale", F.when(c("mk_pct") > 0.90, 0.50).when(c("mk_pct") > 0.80, 0.70).otherwise(1.0))


def trailing_excess(portfolio: DataFrame, index: DataFrame, n: int = 20, look: int = 252) -> DataFrame:
    """Compounded return over n rows of portfolio and index, their difference and its rolling maximum."""
    w = W.by("key")
    df = portfolio.join(index.select("date", c("ret").alias("iret")), "date")
    frame = W.last_rows(w, n)
    prod = lambda x: F.when(F.count("*").over(frame) == n, W.product_of(
        1 + F.coalesce(c(x), F.lit(0.0)), lambda a: a.over(frame))) - 1
    df = df.withColumns({"p20": prod("ret"), "i20": prod("iret")})
    df = df.withColumn("excess", c("p20") - c("i20"))
    return df.withColumn("excess_max", F.max("excess").over(W.last_rows(w, look)))


def top_n_targets(f: DataFrame, scale: DataFrame, params: SectorParams = SectorParams()) -> DataFrame:
    """Equal weights for the best industries on month ends, times the exposure cap of that day."""
    ends = F.broadcast(month_end(f).filter("month_end").select("date"))
    rows = f.filter(c("score").isNotNull()).join(ends, "date")
    w = Window.partitionBy("date").orderBy(c("score").desc(), IND)
    top = rows.withColumn("rank", F.row_number().over(w)).filter(c("rank") <= params.top_n)
    top = top.withColumn("k", F.count("*").over(Window.partitionBy("date"))).join(F.broadcast(scale.select("date", "mk_scale")), "date", "left")
    return top.select("date", IND, "rank", "score", (F.coalesce("mk_scale", F.lit(1.0)) / c("k")).alias("weight"))


def basket_nav(f: DataFrame) -> DataFrame:
    """Mean return of the pooled industries per day and its running product."""
    b = f.filter("pooled").groupBy("date").agg((F.sum(F.coalesce("ret", F.lit(0.0))) / F.count("*")).alias("ret"))
    b = b.withColumn("key", F.lit("EW"))
    return b.withColumn("nav", W.cumprod(c("ret"), W.by("key")))
