"""Parameter sweeps: all grid points of a rule from one pass over its rows, per walk-forward period.

A rule that gets easier from threshold to threshold has, for each row, a first threshold at which the row hits. Rows are counted by
that place, and the counts up to a place are what its threshold hits, so rows are never multiplied by the grid.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factorspark.functions import columns as C
from factorspark.functions import windows as W
from factorspark.operators import indices as I
from factorspark.operators import research as E
from factorspark.operators.sectors import IND, month_end

c = F.col
Periods = Sequence[tuple[str, str, str | None]]


def first_hit(x: Column, values: Sequence[float], hits: Callable[[Column, Column], Column]) -> Column:
    """Index of the first of ``values`` at which ``hits(x, value)``, which must then hold for all later ones; null for none."""
    misses = F.size(F.filter(F.array(*[F.lit(float(v)) for v in values]), lambda v: ~hits(x, v)))
    return F.when(x.isNotNull() & (misses < len(values)), misses)


def ladder(rows: DataFrame, places: Mapping[str, tuple[Sequence[float], Column]], period: Column, fut: str) -> DataFrame:
    """``param, value, period, n, avg_fut, win_rate``: rows hit by each threshold of each parameter, their mean ``fut`` and the
    share above zero. ``places`` maps a parameter to its values, easier ones later, and the index of a row's first hit."""
    marks = F.array(*[F.struct(F.lit(p).alias("param"), place.alias("place")) for p, (_, place) in places.items()])
    d = rows.select(period.alias("period"), c(fut).alias("fut"), F.explode(marks).alias("m")).filter(c("period").isNotNull() & c("m.place").isNotNull())
    hist = d.groupBy(c("m.param").alias("param"), "period", c("m.place").alias("place")).agg(
        F.count("*").alias("n"), F.count("fut").alias("n_fut"), F.coalesce(F.sum("fut"), F.lit(0.0)).alias("total"), F.count_if(c("fut") > 0).alias("wins"))
    # From here on there is a row for each parameter and period.
    lists = hist.groupBy("param", "period").agg(F.collect_list(F.struct("place", "n", "n_fut", "total", "wins")).alias("h"))
    grid = F.array(*[F.struct(F.lit(p).alias("param"), F.lit(i).alias("at"), F.lit(float(v)).alias("value")) for p, (values, _) in places.items()
                     for i, v in enumerate(values)])
    out = lists.withColumn("g", F.explode(F.filter(grid, lambda g: g["param"] == c("param"))))

    def upto(field: str, zero: Column) -> Column:
        return F.aggregate(F.filter("h", lambda x: x["place"] <= c("g.at")), zero, lambda a, x: a + x[field])
    whole = F.lit(0).cast("bigint")
    out = out.select("param", c("g.value").alias("value"), "period", upto("n", whole).alias("n"), upto("n_fut", whole).alias("n_fut"),
                     upto("total", F.lit(0.0)).alias("total"), upto("wins", whole).alias("wins")).filter(c("n") > 0)
    share = lambda x: F.try_divide(c(x).cast("double"), c("n_fut").cast("double"))
    return out.select("param", "value", "period", "n", share("total").alias("avg_fut"), share("wins").alias("win_rate"))


def grouped(grid: Sequence[tuple[str, float]], falling: Sequence[str]) -> dict[str, list[float]]:
    """The values of each parameter, easier ones later: those of ``falling`` get easier as they fall."""
    return {p: sorted({v for q, v in grid if q == p}, reverse=p in falling) for p in dict.fromkeys(p for p, _ in grid)}


def timing_sweep(df: DataFrame, params: I.TimingParams, grid: Sequence[tuple[str, float]], periods: Periods, horizon: int = 20) -> DataFrame:
    """Oversold days (``j_low``, ``rsi_os``, ``y_down``) and overbought days (``j_high``, ``x_up``) over timing indicators, one
    threshold moving at a time, with the series' return over the next ``horizon`` rows."""
    p, px = params, c("px")
    yes = lambda cond: F.coalesce(cond, F.lit(False))
    steep = yes(c("dn10") <= c("dn63") * 0.6) if p.y_acc else F.lit(True)
    gates = yes(c("spread_pct") >= 0.5) if p.val_gate else F.lit(True)
    if p.ma250_gate:
        gates = gates & yes(px < c("ma250"))
    if p.week_j0:
        gates = gates & yes(c("wj") < 0)
    band = yes(px <= c("lower"))
    now = {"j_low": yes(c("wj") < p.j_low), "rsi_os": yes(c("wrsi") < p.rsi_os), "y_down": yes(c("dn63") <= -p.y_down) & steep}
    test = {"j_low": (c("wj"), lambda x, v: x < v, F.lit(True)), "rsi_os": (c("wrsi"), lambda x, v: x < v, F.lit(True)),
            "y_down": (c("dn63"), lambda x, v: x <= -v, steep), "j_high": (c("wj"), lambda x, v: x > v, yes((px >= c("upper")) & (c("up63") >= p.x_up))),
            "x_up": (c("up63"), lambda x, v: x >= v, yes((px >= c("upper")) & (c("wj") > p.j_high)))}
    places = {}
    for name, values in grouped(grid, ("y_down", "j_high", "x_up")).items():
        x, hits, also = test[name]
        place = F.when(also, first_hit(x, values, hits))
        if name in now:  # two of four: the other three decide whether this one matters
            others = band.cast("int") + sum(cond.cast("int") for k, cond in now.items() if k != name)
            place = F.when(gates, F.when(others >= 2, F.lit(0)).when(others == 1, place))
        places[name] = (values, place)
    d = df.withColumn("fut", C.div(F.lead("px", horizon).over(W.by("series_id")), px) - 1)
    return ladder(d, places, E.period_of(c("date"), periods), "fut")


def screen_places(base, grid: Sequence[tuple[str, float]]) -> dict[str, tuple[Sequence[float], Column]]:
    """The momentum screen's thresholds ``rank_min``, ``ret20_max`` and ``amt20_min``, one moving at a time."""
    test = {"rank_min": (c("rk"), lambda x, v: x >= v), "ret20_max": (c("ret20"), lambda x, v: x < v), "amt20_min": (c("amt20"), lambda x, v: x >= v)}
    out = {}
    for name, values in grouped(grid, ("rank_min", "amt20_min")).items():
        others = F.lit(True)
        for k, (x, hits) in test.items():
            if k != name:
                others = others & hits(x, F.lit(getattr(base, k)))
        out[name] = (values, F.when(others, first_hit(test[name][0], values, test[name][1])))
    return out


def stop_sweep(signals: DataFrame, bars: DataFrame, stops: Sequence[float], periods: Periods, params: E.StudyParams = E.StudyParams()) -> DataFrame:
    """``stop, period, n, win_rate, avg_ret`` of the event study at each stop level, by the period of the entry.

    The lowest close so far along a trade's path falls, so the first row below a level is the number of rows above it: one
    path serves all levels.
    """
    p = params
    df = signals.join(E.trade_path(bars, p), ["code", "date"]).filter(F.size("path") > 0)
    df = df.withColumn("first", F.get("path", F.lit(0))).filter(~c("first.no_buy"))
    lows = F.transform("path", lambda _, i: F.array_min(F.transform(F.slice("path", 1, i + 1), lambda x: x["close"])))
    ends = F.transform("path", lambda x, i: (i + 1 >= p.max_hold) | ((i + 1 >= p.min_hold_shrink) & F.coalesce(x["shrink"], F.lit(False))))
    df = df.withColumns({"lows": lows, "other": F.array_position(ends, True) - 1}).withColumn("other", F.when(c("other") >= 0, c("other")))
    at = lambda s: F.size(F.filter("lows", lambda x: x > c("first.open") * s))
    sales = F.array(*[F.struct(F.lit(float(s)).alias("stop"), F.get("path", F.least(F.when(at(s) < F.size("path"), at(s)), c("other")).cast("int"))["sell"].alias("sell"))
                      for s in stops])
    gross = c("x.sell.open") * (1 - p.slippage) * (1 - p.commission - p.stamp)
    cost = c("first.open") * (1 + p.slippage) * (1 + p.commission)
    d = df.select("first", F.explode(sales).alias("x")).select(
        c("x.stop").alias("stop"), E.period_of(c("first.date"), periods).alias("period"), (C.div(gross, cost) - 1).alias("ret"))
    return d.filter(c("ret").isNotNull() & c("period").isNotNull()).groupBy("stop", "period").agg(
        F.count("*").alias("n"), F.avg((c("ret") > 0).cast("double")).alias("win_rate"), F.avg("ret").alias("avg_ret"))


def cost_sweep(study: DataFrame, slippages: Sequence[float], periods: Periods, params: E.StudyParams = E.StudyParams()) -> DataFrame:
    """``slippage, period, n, win_rate, avg_ret`` of studied trades at other slippage rates: a trade's return is its price ratio
    times a factor of the rates, so the mean ratio gives all means and the place of the ratio all win rates."""
    def factor(s: float) -> float:
        return (1 - s) * (1 - params.commission - params.stamp) / ((1 + s) * (1 + params.commission))
    values = sorted(slippages, reverse=True)  # the lower the cost, the more trades win
    d = study.withColumn("ratio", C.div(c("exit_px"), c("entry_px"))).filter(c("ratio").isNotNull())
    won = first_hit(c("ratio"), [1 / factor(s) for s in values], lambda x, v: x > v)
    d = d.withColumns({"period": E.period_of(c("entry_date"), periods), "won": won}).filter(c("period").isNotNull())
    d = d.groupBy("period").agg(F.count("*").alias("n"), F.avg("ratio").alias("ratio"), *[F.count_if(c("won") <= i).alias(f"w{i}") for i in range(len(values))])
    points = F.array(*[F.struct(F.lit(s).alias("slippage"), F.lit(factor(s)).alias("factor"), c(f"w{i}").alias("wins")) for i, s in enumerate(values)])
    d = d.withColumn("g", F.explode(points))
    return d.select(c("g.slippage").alias("slippage"), "period", "n", (c("g.wins") / c("n")).alias("win_rate"), (c("ratio") * c("g.factor") - 1).alias("avg_ret"))


def top_n_sweep(f: DataFrame, sizes: Sequence[int], periods: Periods, horizon: int = 20) -> DataFrame:
    """``param, value, period, n, avg_fut, win_rate`` of the best industries on month ends for each number of them: a rank is the
    place of its industry."""
    ahead = W.by(IND).rowsBetween(1, horizon)
    fut = F.when(F.count("*").over(ahead) == horizon, W.product_of(1 + F.coalesce("ret", F.lit(0.0)), lambda a: a.over(ahead)) - 1)
    d = f.withColumn("fut", fut).join(F.broadcast(month_end(f).filter("month_end").select("date")), "date").filter(c("score").isNotNull())
    d = d.withColumn("rank", F.row_number().over(Window.partitionBy("date").orderBy(c("score").desc(), IND)))
    values = sorted(sizes)
    return ladder(d, {"top_n": (values, first_hit(c("rank"), values, lambda x, v: x <= v))}, E.period_of(c("date"), periods), "fut")
