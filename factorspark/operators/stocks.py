"""Stock indicators, features, screens, scores and market states."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factorspark.functions import columns as C
from factorspark.functions import windows as W

c = F.col


@dataclass(frozen=True)
class ScreenParams:
    """Thresholds of the momentum screen (fixed default values)."""

    rank_min: float = 0.95
    ret20_max: float = 0.60
    amt20_min: float = 3e7


@dataclass(frozen=True)
class RegimeParams:
    """Market states and their target ratios (fixed default values)."""

    dip: float = -0.01
    ratios: tuple[tuple[str, float], ...] = (("Z0", 0.0), ("Z1", 0.3), ("Z2", 0.5), ("Z3", 1.0))


def join_bases(hfq: DataFrame, raw: DataFrame) -> DataFrame:
    """Back-adjusted prices with the traded volume, amount and prices of the raw bars."""
    r = raw.select("code", "date", c("volume"), c("amount"), c("open").alias("raw_open"), c("close").alias("raw_close"))
    return hfq.select("code", "date", "open", "high", "low", "close").join(r, ["code", "date"], "left")


def indicators(df: DataFrame) -> DataFrame:
    """The daily indicator block over joined bases (see join_bases). All windows share one partitioning
    and one sort."""
    w = W.by()
    px, vol = c("close"), c("volume")
    df = df.withColumns({
        **{f"ma{n}": W.roll(px, n, F.avg, w) for n in (5, 10, 20, 50, 60)},
        "vol_ma5": W.roll(vol, 5, F.avg, w),
        "vol_ma20": W.roll(vol, 20, F.avg, w),
        "ret": W.ret(px, 1, w),
        "ret20": W.ret(px, 20, w),
        "ret120": W.ret(px, 120, w),
        # Volume counts lots where the source has no amount, hence the factor 100.
        "amt": F.coalesce(c("amount"), px * vol * 100),
    })
    df = df.withColumns({
        "prev_vol_ma5": F.lag("vol_ma5").over(w),
        "prev_vol_ma20": F.lag("vol_ma20").over(w),
        "ma60_rising": F.coalesce(C.gt(c("ma60"), F.lag("ma60", 20).over(w)), F.lit(False)),
        "amt20": W.roll(c("amt"), 20, F.avg, w),
        "vol20": W.roll(c("ret"), 20, F.stddev_samp, w),
        # A missing return counts as "not up" here, so the share needs only 60 rows.
        "win60": W.roll(F.coalesce((c("ret") > 0), F.lit(False)).cast("double"), 60, F.avg, w),
        "illiq20": W.roll(C.div(F.abs("ret"), C.non_zero(c("amt"))), 20, F.avg, w),
    })
    df = df.withColumn("sharpe20", C.div(c("ret20"), F.when(c("vol20") > 0, c("vol20"))) / F.sqrt(F.lit(20.0)))
    bull = C.gt(c("ma5"), c("ma10")) & C.gt(c("ma10"), c("ma20")) & C.gt(c("ma20"), c("ma60"))
    # The run counts from 2 after a false row; only its order matters to the scores.
    return W.with_streak(df, bull, "trend_streak", w, offset=1)


def with_kdj(df: DataFrame) -> DataFrame:
    """J of KDJ(9,3,3) and its distance below the 20-row mean. Call it before the wide indicator block."""
    df = W.with_ewm(_with_rsv(df), {"k": ("rsv", 1 / 3, 0), "d": ("k", 1 / 3, 0)})
    return _with_j(df).drop("rsv", "k", "d")


def _with_rsv(df: DataFrame) -> DataFrame:
    w = W.by()
    hh, ll = W.roll(c("high"), 9, F.max, w), W.roll(c("low"), 9, F.min, w)
    return df.withColumn("rsv", C.div(c("close") - ll, C.non_zero(hh - ll)) * 100)


def _with_j(df: DataFrame) -> DataFrame:
    df = df.withColumn("kdj_j", 3 * c("k") - 2 * c("d"))
    return df.withColumn("j_dev", W.roll(c("kdj_j"), 20, F.avg, W.by()) - c("kdj_j"))


def skew_sample(x: Column, w) -> Callable:
    """Bias-corrected skewness over a frame of n rows."""
    def fn(n: int) -> Column:
        g = F.skewness(x).over(W.last_rows(w, n))
        return g * (n * (n - 1)) ** 0.5 / (n - 2)
    return fn


def kurt_sample(x: Column, w) -> Callable:
    """Bias-corrected excess kurtosis over a frame of n rows."""
    def fn(n: int) -> Column:
        g = F.kurtosis(x).over(W.last_rows(w, n))
        return (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g + 6)
    return fn


# The names of the features.
FEATURES = (
    "ret1", "ret3", "ret5", "ret10", "ret20", "ret60", "vol5", "vol20", "vol60", "dvol20", "skew20", "kurt20", "vol_ratio", "vma_ratio",
    "amt_ratio", "amp", "amp20", "intraday", "overnight", "bias20", "bias60", "rsi14", "macd_hist", "win20", "win60", "sharpe20",
    "trend_streak", "kdj_j", "j_dev", "illiq20", "rk_ret5", "rk_ret20", "rk_vol20", "rk_amt20", "rk_sharpe20",
)


def features(df: DataFrame) -> DataFrame:
    """The 35 model features per (code, date) over joined bases."""
    w = W.by()
    move = W.ret(c("close"), 1, w)
    # All exponential means come first, while the frame is narrow.
    df = _with_rsv(df).withColumns({"up": F.when(move.isNotNull(), F.greatest(move, F.lit(0.0))),
                                    "dn": F.when(move.isNotNull(), F.greatest(-move, F.lit(0.0)))})
    df = W.with_ewm(df, {"k": ("rsv", 1 / 3, 0), "d": ("k", 1 / 3, 0), "au": ("up", 1 / 14, 0), "ad": ("dn", 1 / 14, 0),
                         "e12": ("close", 2 / 13, 0), "e26": ("close", 2 / 27, 0), "sig9": (("e12", "e26"), 2 / 10, 0)})
    df = indicators(_with_j(df))
    px, r = c("close"), c("ret")
    full20 = F.count(r).over(W.last_rows(w, 20)) == 20
    spread = F.stddev_pop(r).over(W.last_rows(w, 20)) > 0
    df = df.withColumns({
        **{f"ret{n}": W.ret(px, n, w) for n in (1, 3, 5, 10, 60)},
        "vol5": W.roll(r, 5, F.stddev_samp, w),
        "vol60": W.roll(r, 60, F.stddev_samp, w),
        # Null unless 20 losses in a row: the window counts only the negative returns.
        "dvol20": W.roll(F.when(r < 0, r), 20, F.stddev_samp, w),
        "skew20": F.when(full20 & spread, skew_sample(r, w)(20)),
        "kurt20": F.when(full20 & spread, kurt_sample(r, w)(20)),
        "vol_ratio": C.div(c("volume"), C.non_zero(c("vol_ma5"))),
        "vma_ratio": C.div(c("vol_ma5"), C.non_zero(c("vol_ma20"))),
        "amt_ratio": C.div(c("amt"), C.non_zero(c("amt20"))),
        "amp": C.div(c("high") - c("low"), C.non_zero(px)),
        "intraday": C.div(px, c("open")) - 1,
        "overnight": C.div(c("open"), F.lag(px).over(w)) - 1,
        "bias20": C.div(px, c("ma20")) - 1,
        "bias60": C.div(px, c("ma60")) - 1,
        "win20": W.roll(F.coalesce((r > 0), F.lit(False)).cast("double"), 20, F.avg, w),
        "rsi14": 100 - C.div(F.lit(100.0), 1 + C.div(c("au"), C.non_zero(c("ad")))),
        "macd_hist": C.div(c("e12") - c("e26") - c("sig9"), px) * 100,
    })
    df = df.withColumn("amp20", W.roll(c("amp"), 20, F.avg, w))
    df = df.select("code", "date", "close", "amt20", *[f for f in FEATURES if not f.startswith("rk_")])
    df = W.share_columns(df, {f"rk_{v}": (v, True) for v in ("ret5", "ret20", "vol20", "amt20", "sharpe20")}, ["date"])
    return df.select("code", "date", "close", *FEATURES)


def momentum_screen(df: DataFrame, params: ScreenParams = ScreenParams()) -> DataFrame:
    """Add the rank ``rk`` of ret20 and the flag ``hit`` of the momentum screen to the indicator block; null
    inputs give false."""
    df = W.share_columns(df, {"rk": ("ret20", True)}, ["date"])
    hit = (
        (c("rk") >= params.rank_min) & C.gt(c("close"), c("ma20")) & C.gt(c("ma20"), c("ma60")) & c("ma60_rising")
        & (c("ret20") < params.ret20_max) & (c("ret120") > 0) & (c("amt20") >= params.amt20_min))
    return df.withColumn("hit", F.coalesce(hit, F.lit(False)))


def volume_shrink() -> Column:
    """Falling day on at least twice the previous five-day volume."""
    return F.coalesce(
        (c("volume") >= 2 * c("prev_vol_ma5")) & (c("ret") < 0) & (c("close") < c("open")), F.lit(False))


def tradable(df: DataFrame, st: DataFrame, universe: DataFrame, days_before_exit: int = 30) -> DataFrame:
    """Drop special-treatment days, the last days before delisting, and delisting names without a date."""
    out = df.join(st.filter(c("is_st") == 1).select("code", "date"), ["code", "date"], "left_anti")
    u = universe.select("code", F.date_sub("out_date", days_before_exit).alias("__cut"),
                        (F.contains("name", F.lit("退")) & c("out_date").isNull()).alias("__retire"))
    out = out.join(u, "code", "left")
    keep = (c("__cut").isNull() | (c("date") < c("__cut"))) & ~F.coalesce(c("__retire"), F.lit(False))
    return out.filter(keep).drop("__cut", "__retire")


def _weighted(parts: dict[str, float]) -> Column:
    total = None
    for name, weight in parts.items():
        term = F.lit(weight) * c(name)
        total = term if total is None else total + term
    return total


def _reciprocal(parts: dict[str, float], k: int) -> Column:
    total = None
    for name, weight in parts.items():
        term = F.lit(weight) / (k + c(name))
        total = term if total is None else total + term
    return total


# Weights of the composite scores.
QUALITY = {"p_ret20": 0.30, "p_sharpe20": 0.25, "p_win60": 0.20, "p_trend": 0.15, "p_lowvol": 0.10}
KDJ10 = {"p_ret20": 0.27, "p_sharpe20": 0.225, "p_win60": 0.18, "p_trend": 0.135, "p_lowvol": 0.09, "p_jdev": 0.10}


def kdj_weights(kdj: float = 0.05) -> dict[str, float]:
    """The quality weights with part of the low-volatility weight moved to the J distance."""
    return {**QUALITY, "p_lowvol": 0.10 - kdj, "p_jdev": kdj}


# Name -> column over the rank columns. The reciprocal ranks rank upwards, so the weakest name gets
# rank 1 there; this follows the scores as they are used.
SCORE_MODES: dict[str, Callable[[], Column]] = {
    "momentum": lambda: c("p_ret20"),
    "quality": lambda: _weighted(QUALITY),
    "quality_kdj5": lambda: _weighted(kdj_weights(0.05)),
    "quality_kdj10": lambda: _weighted(KDJ10),
    "rrf": lambda: _reciprocal({n: 1.0 for n in ("r_ret20", "r_sharpe20", "r_win60", "r_trend", "r_vol20", "r_jdev")}, 5),
    "wrrf": lambda: _reciprocal(
        {"r_ret20": 0.30, "r_sharpe20": 0.25, "r_win60": 0.20, "r_trend": 0.15, "r_vol20": 0.05, "r_jdev": 0.05}, 2),
    "amihud": lambda: c("p_ret20") * c("p_liquid"),
    "voladj": lambda: c("p_sharpe20"),
    "kdj": lambda: c("p_jdev"),
    "kdj_rev": lambda: c("p_jrev"),
}


# Rank column -> (indicator, ascending).
RANKS = {"ret20": ("ret20", True), "sharpe20": ("sharpe20", True), "win60": ("win60", True), "trend": ("trend_streak", True),
         "jdev": ("j_dev", True), "vol20": ("vol20", False), "liquid": ("liquidity", True), "jrev": ("j_dev", False)}


# Ranks each mode reads.
CORE = ("ret20", "sharpe20", "win60", "trend", "vol20")
MODE_RANKS = {
    "momentum": ("ret20",), "quality": CORE, "quality_kdj5": (*CORE, "jdev"), "quality_kdj10": (*CORE, "jdev"), "rrf": (*CORE, "jdev"),
    "wrrf": (*CORE, "jdev"), "amihud": ("ret20", "liquid"), "voladj": ("sharpe20",), "kdj": ("jdev",), "kdj_rev": ("jrev",)}


def scores(df: DataFrame, modes=tuple(SCORE_MODES), pieces: int | None = None) -> DataFrame:
    """Composite scores per day. Needs the indicator block with kdj columns; a null part gives null. ``pieces``: see W.positions."""
    need = [k for k in RANKS if any(k in MODE_RANKS[m] for m in modes)]
    df = df.withColumn("liquidity", C.div(F.lit(1.0), c("illiq20")))
    cols = [f"r_{k}" for k in need]
    df = W.rank_columns(df, {f"r_{k}": RANKS[k] for k in need}, ["date"], counts=True, pieces=pieces)
    share = {("p_lowvol" if k == "vol20" else f"p_{k}"): c(f"r_{k}") / c(f"n_r_{k}") for k in need}
    df = df.withColumns(share)
    return df.withColumns({f"score_{m}": SCORE_MODES[m]() for m in modes}).drop(*cols, *share, *[f"n_{x}" for x in cols], "liquidity")


def signals(df: DataFrame, score: str, strategy: str = "momentum") -> DataFrame:
    """Rows that pass the screen, with the score re-ranked within (date, strategy)."""
    out = df.filter("hit").select("date", F.lit(strategy).alias("strategy"), "code", c(score).alias("s"))
    return W.share_columns(out, {"score": ("s", True)}, ["date", "strategy"]).drop("s")


def regime(series: DataFrame, params: RegimeParams = RegimeParams()) -> DataFrame:
    """Market state per index series and day with its target ratio.

    Only the last rule looks at the state before: it steps from Z3 to Z2 below the ten-day mean, from Z2 or Z3 to Z1 below the
    twenty-day mean.
    """
    w = W.by("series_id")
    px = c("close")
    df = series.select("series_id", "date", "close").withColumns(
        {f"ma{n}": W.roll(px, n, F.avg, w) for n in (5, 10, 20)})
    df = df.withColumns({"ma5p": F.lag("ma5").over(w), "ma10p": F.lag("ma10").over(w), "r": W.ret(px, 1, w)})
    weak = C.gt(c("ma20"), c("ma5"))
    rule = (
        F.when(c("ma20").isNull() | c("ma5p").isNull(), F.lit("warm"))
        .when((C.gt(c("ma10"), c("ma5")) & weak) | (weak & (c("r") < params.dip)), F.lit("Z0"))
        .when(C.gt(px, c("ma5")) & C.gt(c("ma5"), c("ma10")) & C.gt(c("ma10"), c("ma20")), F.lit("Z3"))
        .when(C.gt(px, c("ma20")), F.lit("Z2"))
        .when(C.gt(c("ma5"), c("ma5p")) & C.gt(c("ma10"), c("ma10p")), F.lit("Z1"))
        .otherwise(F.lit("keep")))
    df = df.select("series_id", "date", "close", rule.alias("rule"), C.gt(c("ma10"), px).alias("below10"),
                   C.gt(c("ma20"), px).alias("below20"))

    # A rule that names a state opens a segment; inside it rows only step down, so what happened first and how often tells the state.
    keep, named = c("rule") == "keep", ~c("rule").isin("keep", "warm")
    yes = lambda x: keep & F.coalesce(x, F.lit(False))
    df = df.withColumns({"below10": yes(c("below10")), "below20": yes(c("below20")), "seg": F.count_if(named).over(W.running(w))})
    run = W.running(Window.partitionBy("series_id", "seg").orderBy("date"))
    fell = c("below10") | c("below20")
    df = df.withColumns({
        "start": F.coalesce(F.max(F.when(named, c("rule"))).over(run), F.lit("Z1")), "n20": F.count_if(c("below20")).over(run),
        "first": F.first(F.when(fell, F.struct("below10", "below20")), ignorenulls=True).over(run)})
    from_z3 = (F.when(c("first").isNull(), "Z3").when(~c("first.below10"), "Z1").when(c("n20") > c("first.below20").cast("int"), "Z1").otherwise("Z2"))
    state = (F.when(c("rule") == "warm", "Z1").when(named, c("rule")).when(c("start") == "Z3", from_z3)
             .when((c("start") == "Z2") & (c("n20") > 0), "Z1").otherwise(c("start")))
    out = df.select("series_id", "date", "close", state.alias("state"))
    ratio = F.lit(None).cast("double")
    for s, v in params.ratios:
        ratio = F.when(c("state") == s, F.lit(v)).otherwise(ratio)
    return out.withColumn("target_ratio", ratio)


def limit_open_flags(bars: DataFrame) -> DataFrame:
    """Opens too close to the price limit to buy or sell at; the previous close skips suspended days."""
    w = W.by()
    prev = F.last("close", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    move = C.div(c("open"), prev) - 1
    # Fixed value: tolerance of the limit test.
    edge = C.limit_rate(c("code")) - 0.002
    return bars.withColumns({
        "open_ret": move,
        "no_buy": F.coalesce(move >= edge, F.lit(False)),
        "no_sell": F.coalesce(move <= -edge, F.lit(False)),
    })


def forward_return(df: DataFrame, n: int, out: str = "fut") -> DataFrame:
    w = W.by()
    return df.withColumn(out, C.div(F.lead("close", n).over(w), c("close")) - 1)


def quantile_labels(df: DataFrame, value: str, bins: int = 5, out: str = "label", pieces: int | None = None) -> DataFrame:
    """Bin number of the value among the day's quantiles; equal edges are merged first."""
    edges = W.group_quantiles(df, value, ["date"], [i / bins for i in range(bins + 1)], "__edges", pieces)
    edges = edges.withColumn("__edges", F.array_distinct("__edges"))
    lab = F.greatest(F.lit(0), F.size(F.filter("__edges", lambda e: e < c(value))) - 1)
    return df.join(edges, "date", "left").withColumn(
        out, F.when(c(value).isNotNull() & (F.size("__edges") > 1), lab)).drop("__edges")


def rank_ic(df: DataFrame, score: str, fut: str, min_names: int = 10) -> DataFrame:
    """Daily rank correlation of score and future return, for days with more than min_names names."""
    d = df.filter(c(score).isNotNull() & c(fut).isNotNull())
    d = W.rank_columns(d, {"__a": (score, True), "__b": (fut, True)}, ["date"])
    return d.groupBy("date").agg(W.corr(c("__a"), c("__b")).alias("ic"), F.count("*").alias("n")).filter(c("n") > min_names)


def rank_ic_summary(daily: DataFrame) -> DataFrame:
    d = daily.filter(c("ic").isNotNull())
    return d.agg(F.avg("ic").alias("ic_mean"), C.div(F.avg("ic"), F.stddev_samp("ic")).alias("icir"), F.count("*").alias("days"))
