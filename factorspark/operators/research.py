"""Research side-products: event study, NAVs, lots, metrics, sweeps, controls and learned scores."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factorspark.functions import columns as C
from factorspark.functions import windows as W
from factorspark.operators import stocks as K
from factorspark.session import materialize

c = F.col


@dataclass(frozen=True)
class StudyParams:
    """Exit rules and cost rates (fixed default values)."""

    stop: float = 0.92
    max_hold: int = 10
    min_hold_shrink: int = 2
    commission: float = 0.0001
    stamp: float = 0.0005
    slippage: float = 0.001


# ---- event study -------------------------------------------------------------------------------

def trade_path(bars: DataFrame, params: StudyParams = StudyParams()) -> DataFrame:
    """Per (code, date): the next max_hold rows with the first sellable open after each of them.

    Bars need columns open, close and shrink. The path is a bounded array per row.
    """
    w = W.by()
    df = K.limit_open_flags(bars.select("code", "date", "open", "close", "shrink"))
    # The next sellable open is found by one running pass in descending order.
    back = Window.partitionBy("code").orderBy(c("date").desc()).rowsBetween(Window.unboundedPreceding, -1)
    sell = F.last(F.when(~c("no_sell"), F.struct("date", "open")), ignorenulls=True).over(back)
    df = df.withColumn("sell", sell)
    step = F.struct("date", "open", "close", "shrink", "no_buy", "sell")
    return df.select("code", "date", F.collect_list(step).over(w.rowsBetween(1, params.max_hold)).alias("path"))


def event_study(signals: DataFrame, bars: DataFrame, params: StudyParams = StudyParams()) -> DataFrame:
    """One independent trade per signal: entry at the next open unless that open is at its limit, exit at
    the first sellable open after the first trigger. Open trades keep null exits."""
    p = params
    df = signals.join(trade_path(bars, p), ["code", "date"]).filter(F.size("path") > 0)
    df = df.withColumn("first", F.get("path", F.lit(0))).filter(~c("first.no_buy"))

    def reason(x: Column, i: Column) -> Column:
        return (F.when(x["close"] <= c("first.open") * p.stop, F.lit("stop_loss")).when(i + 1 >= p.max_hold, F.lit("expired"))
                .when((i + 1 >= p.min_hold_shrink) & x["shrink"], F.lit("vol_shrink")))

    marks = F.transform("path", lambda x, i: F.struct(reason(x, i).alias("reason"), (i + 1).alias("hold"), x["sell"].alias("sell")))
    df = df.withColumn("hit", F.get(F.filter(marks, lambda m: m["reason"].isNotNull()), F.lit(0)))
    gross = c("hit.sell.open") * (1 - p.slippage) * (1 - p.commission - p.stamp)
    cost = c("first.open") * (1 + p.slippage) * (1 + p.commission)
    return df.select(
        *signals.columns, c("first.date").alias("entry_date"), c("first.open").alias("entry_px"), c("hit.reason").alias("reason"),
        c("hit.hold").alias("hold_days"), c("hit.sell.date").alias("exit_date"), c("hit.sell.open").alias("exit_px"),
        (C.div(gross, cost) - 1).alias("ret"))


def study_summary(study: DataFrame) -> DataFrame:
    """Trades, win rate and mean return over all, by reason and by entry year."""
    d = study.filter(c("ret").isNotNull()).withColumn("year", F.year("entry_date"))
    return d.groupingSets([[], [c("reason")], [c("year")]], c("reason"), c("year")).agg(
        F.count("*").alias("n"), F.avg((c("ret") > 0).cast("double")).alias("win_rate"), F.avg("ret").alias("avg_ret"))


# ---- lots and closed trades --------------------------------------------------------------------

def running_total(df: DataFrame, key: str, order: Sequence[str], value: str, out: str, bucket: str = "month") -> DataFrame:
    """Running sum per key in (date, order), cut into time buckets: inside a bucket by window, plus the sum
    of the buckets before it. One long key so spreads over many tasks."""
    d = df.withColumn("__b", F.trunc("date", bucket))
    sums = d.groupBy(key, "__b").agg(F.sum(value).alias("__s"))
    before = Window.partitionBy(key).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(key, "__b", F.coalesce(F.sum("__s").over(before), F.lit(0)).alias("__base"))
    inside = Window.partitionBy(key, "__b").orderBy("date", *order).rowsBetween(Window.unboundedPreceding, 0)
    return d.join(sums, [key, "__b"]).withColumn(out, c("__base") + F.sum(value).over(inside)).drop("__b", "__base")


def fifo_lots(opens: DataFrame, closes: DataFrame, key: str, order: Sequence[str] = ("id",)) -> DataFrame:
    """n-th opened lot against n-th closed lot per key. Inputs: key, date, id, lots (how many), price; other
    columns of the closing side are kept."""
    def numbered(df: DataFrame, side: str, extra: Sequence[str]) -> DataFrame:
        d = running_total(df.filter(c("lots") > 0), key, order, "lots", "hi")
        d = d.withColumn("lot", F.explode(F.sequence(c("hi") - c("lots") + 1, c("hi"))))
        return d.select(key, "lot", c("date").alias(f"{side}_date"), c("price").alias(f"{side}_px"), *extra)
    extra = [x for x in closes.columns if x not in (key, "date", "lots", "price", *order)]
    return numbered(opens, "buy", []).join(numbered(closes, "sell", extra), [key, "lot"]).withColumn(
        "ret", C.div(c("sell_px") - c("buy_px"), c("buy_px")) * 100)


# Reason buckets of closed lots, first match wins.
REASONS = (("到期", "到期强制卖出"), ("顶背离", "动能消失·顶背离"), ("J跌破80", "动能消失·J跌破80"), ("RSI跌破65", "动能消失·RSI跌破65"))


def reason_bucket(reason: Column) -> Column:
    out = reason
    for mark, name in reversed(REASONS):
        out = F.when(F.contains(reason, F.lit(mark)), F.lit(name)).otherwise(out)
    return out


def lot_statistics(closed: DataFrame) -> DataFrame:
    """Count, wins, win rate and mean return over all, by buy year and by reason."""
    d = closed.select("ret", F.year("buy_date").alias("year"), reason_bucket(c("reason")).alias("reason"))
    g = d.groupingSets([[], [c("year")], [c("reason")]], c("year"), c("reason")).agg(
        F.count("*").alias("n"), F.count_if(c("ret") > 0).alias("wins"), F.avg("ret").alias("avg_ret"))
    return g.withColumn("winrate", c("wins") / c("n") * 100)


def activity_overview(trades: DataFrame, closed: DataFrame, span: DataFrame) -> DataFrame:
    """Per key: adds, clears and holding days against the years of the span.

    trades: key, date, action (buy/sell), pos_before, pos_after; closed: key, buy_date, sell_date, ret;
    span: key, first, last.
    """
    t = trades.groupBy("key").agg(
        F.count_if((c("action") == "buy") & (c("pos_after") > 100)).alias("add_total"),
        F.count_if((c("action") == "sell") & (c("pos_after") == 0)).alias("clear_total"),
        F.count_if((c("action") == "sell") & (c("pos_after") == 100) & (c("pos_before") > 100)).alias("temp_sell_total"))
    days = F.datediff("sell_date", "buy_date")
    k = closed.groupBy("key").agg(F.avg(days).alias("hold_avg"), F.min(days).alias("hold_min"), F.max(days).alias("hold_max"),
                                  F.avg((c("ret") > 0).cast("double")).alias("winrate"))
    years = F.greatest(F.datediff("last", "first") / 365.25, F.lit(1e-9))
    out = span.join(t, "key", "left").join(k, "key", "left").withColumn("years", years)
    return out.withColumns({"add_per_year": c("add_total") / c("years"), "clear_per_year": c("clear_total") / c("years"),
                            "temp_sell_per_year": c("temp_sell_total") / c("years")})


# ---- NAV and performance -----------------------------------------------------------------------

def nav_from_targets(series: DataFrame, initial: float = 100_000.0, fee: float = 1e-4, fee_min: float = 5.0, slip: float = 5e-4,
                     financing: float = 0.07, days: int = 252) -> DataFrame:
    """NAV of a target weight on one total-return series per key. Input: key, date, close, weight.

    Between two weight changes the gross value moves by w·tr/tr0 + 1 − w; the values at the changes
    multiply up. Costs of the changes and financing of w > 1 are taken off as a running sum.
    """
    w = W.by("key")
    df = series.withColumn("w0", F.lag("weight").over(w))
    df = df.withColumn("change", c("w0").isNull() | (F.abs(c("weight") - c("w0")) > 1e-12))
    df = df.withColumns({"seg": F.sum(c("change").cast("int")).over(W.running(w))})
    s = Window.partitionBy("key", "seg").orderBy("date")
    start = F.first("close").over(s)
    df = df.withColumn("growth", c("weight") * c("close") / start + 1 - c("weight"))
    # On the day of a change the closing segment still grows at its old weight.
    df = df.withColumn("seg_close", start)
    df = df.withColumn("step", F.when(c("change") & c("w0").isNotNull(), c("w0") * c("close") / F.lag("seg_close").over(w) + 1 - c("w0")).otherwise(F.lit(1.0)))
    df = df.withColumn("base", W.product_of(c("step"), lambda a: a.over(W.running(w))))
    df = df.withColumn("gross", c("base") * c("growth") * initial)
    # What is held before the trade: the old weight, grown since its segment began.
    held = F.coalesce(F.lag("base").over(w) * c("w0") * c("close") / F.lag("seg_close").over(w) * initial, F.lit(0.0))
    amount = F.when(c("change"), F.abs(c("weight") * c("gross") - held)).otherwise(F.lit(0.0))
    trade = F.when(amount > 0, F.greatest(amount * fee, F.lit(fee_min)) + amount * slip).otherwise(F.lit(0.0))
    carry = F.when(c("weight") > 1 + 1e-9, c("gross") * (c("weight") - 1) * financing / days).otherwise(F.lit(0.0))
    df = df.withColumn("cost", trade + carry)
    df = df.withColumn("nav", (c("gross") - F.sum("cost").over(W.running(w))) / initial)
    return df.select("key", "date", "weight", "gross", "cost", "nav")


def held_weights(weights: DataFrame, days: DataFrame) -> DataFrame:
    """Weights in force per (key, date): set on a rebalance day, working from the day after until the next
    one. days: (key, date), bounded by the calendar per key."""
    marks = days.withColumns({"kind": F.lit(0), "set_date": F.lit(None).cast("date")}).unionByName(
        weights.select("key", "date").distinct().withColumns({"kind": F.lit(1), "set_date": c("date")}))
    # On a rebalance day the old weights still count, so the mark sorts after the day itself.
    w = Window.partitionBy("key").orderBy("date", "kind").rowsBetween(Window.unboundedPreceding, 0)
    slots = marks.withColumn("set_date", F.last("set_date", ignorenulls=True).over(w))
    slots = slots.filter((c("kind") == 0) & c("set_date").isNotNull()).drop("kind")
    return slots.join(weights.withColumnRenamed("date", "set_date"), ["key", "set_date"])


def nav_from_weights(weights: DataFrame, returns: DataFrame) -> DataFrame:
    """NAV of a panel of weights set on some days and held until the next. weights: (key, date, member,
    weight) on rebalance days; returns: (date, member, ret), or with a key where they differ per key."""
    on = ["date", "member"]
    if "key" in returns.columns:
        on = ["key", *on]
        days = returns.select("key", "date").distinct()
    else:
        all_days = returns.select("date").distinct().agg(F.collect_list("date")).scalar()
        days = weights.select("key").distinct().withColumn("date", F.explode(all_days))
    r = held_weights(weights, days).join(returns, on, "left")
    port = r.groupBy("key", "date").agg(F.sum(c("weight") * F.coalesce("ret", F.lit(0.0))).alias("ret"), F.sum("weight").alias("exposure"))
    return port.withColumn("nav", W.cumprod(c("ret"), W.by("key")))


def turnover(weights: DataFrame) -> DataFrame:
    """One-sided turnover per key and rebalance day: half the sum of absolute weight changes."""
    days = weights.select("key", "date").distinct()
    w = Window.partitionBy("key").orderBy("date")
    nxt = days.withColumn("next_date", F.lead("date").over(w))
    cur = weights.select("key", "date", "member", c("weight").alias("d"))
    gone = weights.join(nxt, ["key", "date"]).filter(c("next_date").isNotNull()).select(
        "key", c("next_date").alias("date"), "member", (-c("weight")).alias("d"))
    net = cur.unionByName(gone).groupBy("key", "date", "member").agg(F.sum("d").alias("d"))
    return net.groupBy("key", "date").agg((F.sum(F.abs("d")) / 2).alias("turnover"))


def performance(equity: DataFrame, periods: int = 252, ddof: int = 1, benchmark: DataFrame | None = None,
                trades: DataFrame | None = None, exposure: float | None = None) -> DataFrame:
    """Metrics per key from (key, date, nav): total, CAGR, Sharpe, drawdown, Calmar and win rates.

    The scale of the Sharpe ratio and its degrees of freedom differ between reports, so both are
    parameters. A benchmark (date, bnav) adds the information ratio and exposure-adjusted total.
    """
    std = F.stddev_samp if ddof == 1 else F.stddev_pop
    w = W.by("key")
    df = equity.select("key", "date", "nav")
    if benchmark is not None:
        df = df.join(benchmark.select("date", "bnav"), "date")
    df = df.withColumns({"r": W.ret(c("nav"), 1, w), "dd": W.drawdown(c("nav"), w)})
    aggs = [
        F.min_by("nav", "date").alias("nav0"), F.max_by("nav", "date").alias("nav1"), F.min("date").alias("start"), F.max("date").alias("end"),
        F.count("*").alias("n"), F.avg("r").alias("mean_r"), std("r").alias("std_r"), F.min("dd").alias("mdd"),
        F.avg((c("r") > 0).cast("double")).alias("day_win")]
    if benchmark is not None:
        df = df.withColumn("br", W.ret(c("bnav"), 1, w))
        df = df.withColumn("ex", c("r") - c("br"))
        aggs += [F.avg("ex").alias("mean_ex"), std("ex").alias("std_ex"), F.min_by("bnav", "date").alias("b0"), F.max_by("bnav", "date").alias("b1")]
    g = df.groupBy("key").agg(*aggs)
    years = F.datediff("end", "start") / 365.25
    scale = F.sqrt(F.lit(float(periods)))
    out = g.withColumns({
        "total": C.div(c("nav1"), c("nav0")) - 1, "years": years,
        "cagr": F.when(years > 0, F.pow(C.div(c("nav1"), c("nav0")), C.div(F.lit(1.0), years)) - 1).otherwise(0.0),
        "sharpe": F.when(c("std_r") > 1e-12, c("mean_r") / c("std_r") * scale).otherwise(0.0)})
    out = out.withColumn("calmar", F.when(c("mdd") < 0, c("cagr") / F.abs("mdd")).otherwise(0.0))
    cols = ["key", "start", "end", "n", "total", "years", "cagr", "sharpe", "mdd", "calmar", "day_win", c("nav1").alias("final_nav")]
    if benchmark is not None:
        btotal = C.div(c("b1"), c("b0")) - 1
        out = out.withColumns({"ir": F.when(c("std_ex") > 1e-12, c("mean_ex") / c("std_ex") * scale).otherwise(0.0), "bench_total": btotal})
        out = out.withColumn("bench_adj_total", F.pow(1 + c("bench_total"), F.lit(1.0 if exposure is None else exposure)) - 1)
        cols += ["ir", "bench_total", "bench_adj_total"]
    out = out.select(*cols)
    if trades is not None:
        tr = trades.groupBy("key").agg(F.count("*").alias("n_trades"), F.avg((c("ret") > 0).cast("double")).alias("trade_win"))
        out = out.join(tr, "key", "left")
    return out


def calendar_returns(equity: DataFrame) -> DataFrame:
    """Return of each calendar year, chained from the end of the year before (the first from its first day)."""
    g = equity.groupBy("key", F.year("date").alias("year")).agg(F.max_by("nav", "date").alias("last"), F.min_by("nav", "date").alias("first"))
    w = Window.partitionBy("key").orderBy("year")
    return g.select("key", "year", (C.div(c("last"), F.coalesce(F.lag("last").over(w), c("first"))) - 1).alias("ret"))


def monthly_win_rate(equity: DataFrame) -> DataFrame:
    g = equity.groupBy("key", F.trunc("date", "month").alias("m")).agg(F.max_by("nav", "date").alias("last"))
    r = g.withColumn("r", C.div(c("last"), F.lag("last").over(Window.partitionBy("key").orderBy("m"))) - 1).filter(c("r").isNotNull())
    return r.groupBy("key").agg(F.avg((c("r") > 0).cast("double")).alias("month_win"), F.count("*").alias("months"))


def rebase_window(equity: DataFrame, bench: DataFrame, start: str, capital: float = 1_000_000.0) -> DataFrame:
    """Equity and benchmark from ``start`` on, both scaled to the capital on the first day kept."""
    from factorspark.operators.joins import asof_by_date
    e = asof_by_date(equity, bench.select("date", "bnav"), ["bnav"]).filter(c("date") >= F.lit(start).cast("date"))
    first = e.groupBy("key").agg(F.min_by("nav", "date").alias("n0"), F.min_by("bnav", "date").alias("b0"))
    return e.join(first, "key").select("key", "date", (C.div(c("nav"), c("n0")) * capital).alias("equity"),
                                       (C.div(c("bnav"), c("b0")) * capital).alias("bench"))


def thin_series(df: DataFrame, n: int, keep_extremes: bool = True) -> DataFrame:
    """Every k-th row per key, the last one, and the first lowest and highest value."""
    w = Window.partitionBy("key").orderBy("date")
    g = Window.partitionBy("key")
    d = df.withColumns({"pos": F.row_number().over(w) - 1, "total": F.count("*").over(g)})
    step = F.greatest(F.lit(1), F.floor(c("total") / n))
    keep = (c("pos") % step == 0) | (c("pos") == c("total") - 1)
    if keep_extremes:
        d = d.withColumns({"lo_at": F.min_by("date", F.struct("nav", "date")).over(g),
                           "hi_at": F.min_by("date", F.struct(-c("nav"), c("date"))).over(g)})
        keep = keep | (c("date") == c("lo_at")) | (c("date") == c("hi_at"))
    return d.filter(keep).select(*df.columns)


def watchlists(signals: DataFrame, holdings: DataFrame, equity: float | Column, k: int = 3, max_hold: int = 10, stop: float = 0.92) -> DataFrame:
    """Rows (list, code, rank, note) for the last signal day: names to buy, holdings that are due and
    holdings close to their stop. holdings: code, value, pnl_pct, hold_days."""
    last = signals.agg(F.max("date")).scalar()
    w = Window.partitionBy("date").orderBy(c("score").desc(), c("code"))
    buy = signals.filter(c("date") == last).withColumn("rank", F.row_number().over(w)).filter(c("rank") <= k).select(
        F.lit("buy").alias("list"), "code", "rank", F.lit(None).cast("double").alias("value"))
    due = holdings.filter(c("hold_days") >= max_hold - 2).select(
        F.lit("due").alias("list"), "code", (max_hold - c("hold_days")).cast("int").alias("rank"), c("value").cast("double").alias("value"))
    # The buying costs sit in pnl_pct; 1.0011 takes them out.
    drop = 1 - stop / ((1 + c("pnl_pct")) * 1.0011)
    risk = holdings.withColumn("drop", drop).filter(c("drop").between(0, 0.02)).select(
        F.lit("risk").alias("list"), "code", F.lit(None).cast("int").alias("rank"), c("drop").alias("value"))
    eq = equity if isinstance(equity, Column) else F.lit(equity)
    total = holdings.agg(F.sum("value").alias("value")).select(
        F.lit("holdings_share").alias("list"), F.lit(None).cast("string").alias("code"), F.lit(None).cast("int").alias("rank"),
        C.div(c("value"), eq).alias("value"))
    return buy.unionByName(due).unionByName(risk).unionByName(total)


# ---- latest factors ----------------------------------------------------------------------------

def latest_factors(bars: DataFrame) -> DataFrame:
    """Close, 20- and 60-row momentum and annualised volatility of the latest row per code; codes with
    fewer than 21 rows are left out."""
    w = Window.partitionBy("code").orderBy(c("date").desc())
    d = bars.select("code", "date", "close").withColumns({
        "back": F.row_number().over(w) - 1, "ret": C.div(c("close"), F.lead("close").over(w)) - 1})
    at = lambda n: F.max(F.when(c("back") == n, c("close")))
    g = d.filter(c("back") <= 60).groupBy("code").agg(
        at(0).alias("c0"), at(20).alias("c20"), at(60).alias("c60"),
        F.stddev_pop(F.when(c("back") < 20, c("ret"))).alias("sd"))
    return g.filter(c("c20").isNotNull()).select(
        "code", F.round("c0", 2).alias("close"), F.round(C.div(c("c0"), c("c20")) - 1, 4).alias("mom_20"),
        F.round(C.div(c("c0"), c("c60")) - 1, 4).alias("mom_60"), F.round(c("sd") * F.sqrt(F.lit(252.0)), 4).alias("vol_20"))


def display_scores(factors: DataFrame) -> DataFrame:
    """Momentum and volatility as display scores between 5 and 98."""
    return factors.withColumns({"mom_score": C.clip(50 + c("mom_20") * 160, 5.0, 98.0), "vol_score": C.clip(95 - c("vol_20") * 120, 5.0, 98.0)})


# ---- walk-forward ------------------------------------------------------------------------------

def walk_forward_blocks(days: DataFrame, train_from: str, start: str, every: int = 42, purge: int = 6, warm: int = 40,
                        valid_share: float = 0.15) -> DataFrame:
    """Prediction blocks over a calendar (date, td_idx): block start, next start and the last day of fit
    and train. Blocks with too few days before them are left out."""
    d = days.filter(c("date") >= F.lit(start).cast("date"))
    first = d.agg(F.min("td_idx")).scalar()
    train0 = days.filter(c("date") >= F.lit(train_from).cast("date")).agg(F.min("td_idx")).scalar()
    last = days.agg(F.max("td_idx")).scalar()
    starts = d.filter((c("td_idx") - first) % every == 0)
    b = starts.select(c("td_idx").alias("lo"), c("date").alias("block_start"))
    b = b.withColumns({"hi": F.least(c("lo") + every, last + 1), "prior": c("lo") - train0, "t0": train0})
    b = b.filter(c("prior") > purge + warm)
    n_train = c("prior") - purge
    b = b.withColumns({"n_train": n_train, "fit_end": c("t0") + F.greatest(F.floor(n_train * (1 - valid_share)), F.lit(1)), "train_end": c("t0") + n_train})
    return b.select(((c("lo") - first) / every).cast("int").alias("block"), "block_start", "lo", "hi", "t0", "fit_end", "train_end", "n_train")


def block_roles(days: DataFrame, blocks: DataFrame) -> DataFrame:
    """(block, role, date): fit, valid and predict days of every block. Both sides are calendar-sized."""
    j = days.join(F.broadcast(blocks), (c("td_idx") >= c("t0")) & (c("td_idx") < c("hi")))
    role = (F.when(c("td_idx") < c("fit_end"), "fit").when(c("td_idx") < c("train_end"), "valid").when(c("td_idx") >= c("lo"), "predict"))
    return j.withColumn("role", role).filter(c("role").isNotNull()).select("block", "role", "date")


def fill_missing_scores(rows: DataFrame, scores: DataFrame) -> DataFrame:
    """Learned scores on the given rows; a missing score is 0 and flagged."""
    s = scores.select("code", "date", c("score").alias("__s"))
    return rows.join(s, ["code", "date"], "left").withColumns({"score": F.coalesce("__s", F.lit(0.0)), "missing": c("__s").isNull()}).drop("__s")


#: Stands for a missing feature.
MISSING = -1e300


def walk_forward_score(features: DataFrame, labels: DataFrame, days: DataFrame, blocks: DataFrame, columns: Sequence[str], seed: int = 42,
                       trees: int = 10, depth: int = 4, scored_until: str | None = None, store: ModelStore | None = None, at_once: int = 8) -> DataFrame:
    """Learned score: one gradient-boosted model per block, fit on the rows before it and applied inside
    it. The block's valid days don't fit: they stop the boosting where more trees no longer help. Every feature row of
    a block is scored; a missing value is a value of its own, below all others. With ``scored_until`` only later dates
    are predicted.

    With a ``store`` each block's model and scores are kept there: a later run reads the scores of the dates that have some,
    scores further dates of a known block by its model and fits new blocks only. Blocks are few (one per 42 days) and don't
    depend on each other, so the driver submits the jobs of ``at_once`` of them at a time.
    """
    from concurrent.futures import ThreadPoolExecutor

    from pyspark import inheritable_thread_target
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    spark = features.sparkSession
    place = {r["td_idx"]: r["date"] for r in days.select("td_idx", "date").collect()}  # the calendar
    todo = []
    for b in blocks.orderBy("block").collect():
        until = max((x for x in (scored_until, store and store.scored_until(b.block)) if x), default=None)
        inside = [d for i, d in place.items() if b.lo <= i < b.hi and (until is None or d.isoformat() > until)]
        if inside:
            todo.append((b, min(inside).isoformat()))
    schema = "code string, date date, block int, score float"
    parts = [] if store is None else [p for p in [store.scores()] if p is not None]
    if todo:
        known = {x: F.when(c(x).isNull() | F.isnan(c(x).cast("double")), F.lit(MISSING)).otherwise(c(x).cast("double")) for x in columns}
        va = VectorAssembler(inputCols=list(columns), outputCol="x")
        data = va.transform(features.select("code", "date", *columns).withColumns(known).join(labels.select("code", "date", "label"), ["code", "date"], "left"))
        # Every block reads these rows, so they are computed once.
        data = materialize(data.select("code", "date", "x", "label").join(F.broadcast(days.select("date", "td_idx")), "date"), "walk-forward")

        def fitted(b):
            model = None if store is None else store.model(b.block)
            if model is None:
                train = data.filter((c("td_idx") >= b.t0) & (c("td_idx") < b.train_end) & c("label").isNotNull())
                train = train.withColumns({"label": c("label").cast("double"), "valid": c("td_idx") >= b.fit_end})
                model = GBTRegressor(featuresCol="x", labelCol="label", predictionCol="p", maxIter=trees, maxDepth=depth, stepSize=0.05, seed=seed,
                                     subsamplingRate=0.8, validationIndicatorCol="valid", validationTol=0.0).fit(train)
                if store is not None:
                    store.keep_model(b.block, model)
            return model

        def scored(b, since):
            rows = data.filter((c("td_idx") >= b.lo) & (c("td_idx") < b.hi) & (c("date") >= F.lit(since).cast("date")))
            pred = fitted(b).transform(rows).select("code", "date", F.lit(b.block).alias("block"), c("p").cast("float").alias("score"))
            return pred if store is None else store.keep_scores(b.block, since, pred)

        with ThreadPoolExecutor(at_once) as pool:
            parts += list(pool.map(inheritable_thread_target(spark)(lambda job: scored(*job)), todo))
    out = spark.createDataFrame([], schema)
    for p in parts:
        out = out.unionByName(p)
    return out if scored_until is None else out.filter(c("date") > F.lit(scored_until).cast("date"))


class ModelStore:
    """Models and scores of walk-forward blocks under a shared folder: ``model/block=N`` and ``scores/block=N/since=DATE``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._scores = self.scores()
        self._until = {} if self._scores is None else {r["block"]: r["until"].isoformat() for r in self._scores.groupBy("block").agg(
            F.max("date").alias("until")).collect()}  # a row for each block
        self.fits: list[int] = []  #: blocks whose model was fitted through this object

    def _exists(self, path: str) -> bool:
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(hadoop)

    def scores(self) -> DataFrame | None:
        """All scores that were kept when this was called."""
        if not self._exists(f"{self.root}/scores"):
            return None
        return self.spark.read.schema("code string, date date, score float, block int, since string").parquet(f"{self.root}/scores").select(
            "code", "date", "block", "score")

    def scored_until(self, block: int) -> str | None:
        return self._until.get(block)

    def model(self, block: int):
        from pyspark.ml.regression import GBTRegressionModel

        path = f"{self.root}/model/block={block}"
        return GBTRegressionModel.load(path) if self._exists(f"{path}/treesMetadata") else None

    def keep_model(self, block: int, model) -> None:
        model.write().overwrite().save(f"{self.root}/model/block={block}")
        self.fits.append(block)

    def keep_scores(self, block: int, since: str, scores: DataFrame) -> DataFrame:
        path = f"{self.root}/scores/block={block}/since={since}"
        scores.drop("block").write.mode("overwrite").parquet(path)
        return self.spark.read.schema("code string, date date, score float").parquet(path).select("code", "date", F.lit(block).alias("block"), "score")


# ---- sweeps and controls -----------------------------------------------------------------------

def with_grid(df: DataFrame, grid: Sequence[tuple[str, float]], param: str = "param", value: str = "value") -> DataFrame:
    """Repeat each row once per grid point; the grid is a literal array, so no join is needed."""
    points = F.array(*[F.struct(F.lit(p).alias(param), F.lit(float(v)).alias(value)) for p, v in grid])
    return df.withColumn("__g", F.explode(points)).select("*", f"__g.{param}", f"__g.{value}").drop("__g")


def period_of(date: Column, periods: Sequence[tuple[str, str, str | None]]) -> Column:
    out = F.lit(None).cast("string")
    for name, lo, hi in reversed(list(periods)):
        inside = date >= F.lit(lo).cast("date")
        if hi is not None:
            inside = inside & (date <= F.lit(hi).cast("date"))
        out = F.when(inside, F.lit(name)).otherwise(out)
    return out


def screen_sweep(ind: DataFrame, fut: str, grid: Sequence[tuple[str, float]], periods: Sequence[tuple[str, str, str | None]],
                 base: K.ScreenParams) -> DataFrame:
    """Hits, mean future return and win rate of the momentum screen per (parameter, value, period).

    One threshold moves at a time. All thresholds are answered by one pass over the indicator block (see sweeps.ladder).
    """
    from factorspark.operators import sweeps

    d = W.share_columns(ind.select("date", "close", "ma20", "ma60", "ma60_rising", "ret20", "ret120", "amt20", fut), {"rk": ("ret20", True)}, ["date"])
    d = d.filter(C.gt(c("close"), c("ma20")) & C.gt(c("ma20"), c("ma60")) & c("ma60_rising") & (c("ret120") > 0))
    return sweeps.ladder(d, sweeps.screen_places(base, grid), period_of(c("date"), periods), fut)


def random_score(seed: Column, *keys: str) -> Column:
    """Deterministic pseudo-random number in [0, 1) from a seed and key columns."""
    return F.pmod(F.xxhash64(seed, *[c(k) for k in keys]), F.lit(2**53)).cast("double") / F.lit(float(2**53))


def random_control(f: DataFrame, seeds: int, top_n: int, real: DataFrame, score: Column | None = None) -> DataFrame:
    """Sharpe of Top-N month-end portfolios under random scores, and where the real one stands.

    f: industry, date, ret, pooled. real: one row with column sharpe. Seeds unfold from a literal range;
    only month-end rows are multiplied before the ranking.
    """
    from factorspark.operators.sectors import month_end
    ends = F.broadcast(month_end(f).filter("month_end").select("date"))
    rows = f.filter("pooled").join(ends, "date", "left_semi").drop("ret", "pooled")
    rows = rows.withColumn("key", F.explode(F.sequence(F.lit(1), F.lit(seeds))))
    rows = rows.withColumn("s", random_score(c("key"), "date", "industry") if score is None else score)
    w = Window.partitionBy("key", "date").orderBy(c("s").desc(), "industry")
    top = rows.withColumn("r", F.row_number().over(w)).filter(c("r") <= top_n)
    wts = top.withColumn("weight", 1 / F.count("*").over(Window.partitionBy("key", "date"))).select("key", "date", c("industry").alias("member"), "weight")
    nav = nav_from_weights(wts, f.select("date", c("industry").alias("member"), "ret"))
    perf = performance(nav, ddof=0).select("key", "sharpe", "total")
    target = real.agg(F.max("sharpe")).scalar()
    return perf.agg(F.count("*").alias("n"), F.avg("sharpe").alias("sharpe_mean"), F.percentile("sharpe", F.lit(0.5)).alias("sharpe_p50"),
                    F.percentile("sharpe", F.lit(0.95)).alias("sharpe_p95"), F.max("sharpe").alias("sharpe_max"),
                    F.avg((c("sharpe") < target).cast("double")).alias("percentile")).withColumn("p_value", 1 - c("percentile"))


def noise_neighbourhood(returns: DataFrame, weights: DataFrame, sigmas: Sequence[float], seeds: int,
                        uniforms: tuple[Column, Column] | None = None) -> DataFrame:
    """Metrics of fixed target weights when Gaussian noise of several sizes is added to the returns. The noise comes from two
    uniform numbers for each sigma, seed, date and member: hashes, or ``uniforms`` over these columns and those of returns."""
    grid = F.array(*[F.lit(float(s)) for s in sigmas])
    d = returns.withColumn("sigma", F.explode(grid)).withColumn("seed", F.explode(F.sequence(F.lit(1), F.lit(seeds))))
    key = F.concat_ws("|", c("sigma").cast("string"), c("seed").cast("string"))
    u1, u2 = uniforms or tuple(random_score(F.lit(k), "sigma", "seed", "date", "member") for k in (1, 2))
    gauss = F.sqrt(-2 * F.ln(F.greatest(u1, F.lit(1e-300)))) * F.cos(2 * F.pi() * u2)
    d = d.withColumns({"key": key, "ret": c("ret") + c("sigma") * gauss})
    w = weights.withColumn("sigma", F.explode(grid)).withColumn("seed", F.explode(F.sequence(F.lit(1), F.lit(seeds)))).withColumn("key", key)
    nav = nav_from_weights(w.select("key", "date", "member", "weight"), d.select("key", "date", "member", "ret"))
    perf = performance(nav, ddof=0).withColumn("sigma", F.split_part("key", F.lit("|"), F.lit(1)).cast("double"))
    q = lambda x: [F.percentile(x, F.lit(p)).alias(f"{x}_p{int(p * 100)}") for p in (0.05, 0.5, 0.95)]
    return perf.groupBy("sigma").agg(F.count("*").alias("n_seed"), *q("total"), *q("sharpe"), *q("mdd"))
