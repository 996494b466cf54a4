"""Queries over the research and reconciliation operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from factorspark.functions import windows as W
from factorspark.operators import indices as I
from factorspark.operators import reconcile as RC
from factorspark.operators import research as E
from factorspark.operators import stocks as K
from factorspark.operators import sweeps as SW
from factorspark.plans.ctes import cte
from factorspark.plans.market_plans import PARAMS, sector_table, sector_targets
from factorspark.plans.registry import R, query, rounded
from factorspark.plans.stock_plans import signal_table
from factorspark.session import materialize, shared_dir
from factorspark.sources.tables import brand_number

c = F.col

# ---- event study -------------------------------------------------------------------------------


def study_cte(name, signals, bars):
    """Blocks <name>b (bars with flags) and <name> (one row per signal)."""
    cte(f"{name}b", f"""SELECT *, row_number() OVER (PARTITION BY code ORDER BY date) AS rn, coalesce(o >= edge, false) AS no_buy, coalesce(o <= -edge, false) AS no_sell FROM (
        SELECT *, open / last_value(close IGNORE NULLS) OVER (PARTITION BY code ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 1 AS o,
        CASE WHEN substr(code, 1, 2) IN ('30', '68') THEN 0.20 ELSE 0.10 END - 0.002 AS edge FROM {bars})""")
    cte(f"{name}h", f"""SELECT s.code, s.date, e.rn AS ern, e.date AS entry_date, e.open AS entry_px, h.rn - e.rn + 1 AS hold, h.rn AS hrn,
        CASE WHEN h.close <= e.open * 0.92 THEN 'stop_loss' WHEN h.rn - e.rn + 1 >= 10 THEN 'expired' WHEN h.rn - e.rn + 1 >= 2 AND h.shrink THEN 'vol_shrink' END AS reason
        FROM {signals} AS s JOIN {name}b AS b USING (code, date) JOIN {name}b AS e ON e.code = s.code AND e.rn = b.rn + 1
        JOIN {name}b AS h ON h.code = s.code AND h.rn BETWEEN e.rn AND e.rn + 9 WHERE NOT e.no_buy""")
    cte(name, f"""SELECT g.*, x.date AS exit_date, x.open AS exit_px, x.open * (1 - 0.001) * (1 - 0.0001 - 0.0005) / (entry_px * (1 + 0.001) * (1 + 0.0001)) - 1 AS ret FROM (
        SELECT code, date, any_value(entry_date) AS entry_date, any_value(entry_px) AS entry_px, arg_min(reason, hold) FILTER (WHERE reason IS NOT NULL) AS reason,
        min(hold) FILTER (WHERE reason IS NOT NULL) AS hold_days, min(hrn) FILTER (WHERE reason IS NOT NULL) AS trn FROM {name}h GROUP BY code, date) AS g
        LEFT JOIN LATERAL (SELECT min(k.rn) AS xrn FROM {name}b AS k WHERE k.code = g.code AND k.rn > g.trn AND NOT k.no_sell) AS m ON true
        LEFT JOIN {name}b AS x ON x.code = g.code AND x.rn = m.xrn""")


cte("f_shbars", "SELECT code, date, open, close, coalesce(volume >= 2 * prev_vol_ma5 AND ret < 0 AND close < open, false) AS shrink FROM f_ind")
study_cte("f_es", "f_signals", "f_shbars")
cte("f_ushbars", "SELECT code, date, open, close, coalesce(close < open AND volume < lag(volume) OVER (PARTITION BY code ORDER BY date), false) AS shrink FROM f_ubars")
cte("f_usig", "SELECT code, date FROM f_ubars WHERE close > open")
study_cte("f_ues", "f_usig", "f_ushbars")
STUDY = f"entry_date, {R('entry_px', 6)} AS entry_px, reason, CAST(hold_days AS INTEGER) AS hold_days, exit_date, {R('exit_px', 6)} AS exit_px, {R('ret', 9)} AS ret"


def study(t):
    bars = K.indicators(t.both_bases)
    bars = bars.withColumn("shrink", K.volume_shrink())
    return E.event_study(signal_table(t).select("code", "date"), bars)


@query("e1_event_study", f"SELECT code, date, {STUDY} FROM f_es")
def e1(t):
    return rounded(study(t), entry_px=6, exit_px=6, ret=9)


def user_study(t):
    b = t.ubars.withColumn("shrink", F.coalesce((c("close") < c("open")) & (c("volume") < F.lag("volume").over(W.by())), F.lit(False)))
    return E.event_study(t.ubars.filter(c("close") > c("open")).select("code", "date"), b)


@query("e1b_event_study_limits", f"SELECT code, date, {STUDY} FROM f_ues")
def e1b(t):
    return rounded(user_study(t), entry_px=6, exit_px=6, ret=9)


@query("e2_study_summary", f"""SELECT reason, CAST(year(entry_date) AS INTEGER) AS year, count(*) AS n, {R('avg(CASE WHEN ret > 0 THEN 1 ELSE 0 END)', 9)} AS win_rate, {R('avg(ret)', 9)} AS avg_ret
    FROM f_es WHERE ret IS NOT NULL GROUP BY GROUPING SETS ((), (reason), (year(entry_date)))""")
def e2(t):
    return rounded(E.study_summary(study(t)), win_rate=9, avg_ret=9)


# ---- lots --------------------------------------------------------------------------------------

cte("f_lo", "SELECT o_custkey AS cust, CAST(o_orderdate AS DATE) AS date, o_orderkey AS id, 1 + o_orderkey % 3 AS lots, o_totalprice AS price, o_orderpriority AS reason, o_orderstatus AS st FROM orders")


def lot_side(side):
    return f"""SELECT * FROM (SELECT cust, hi - lots + unnest(generate_series(1, lots)) AS lot, date, price, reason FROM (
    SELECT *, sum(lots) OVER (PARTITION BY cust ORDER BY date, id ROWS UNBOUNDED PRECEDING) AS hi FROM f_lo WHERE st = '{side}'))"""


cte("f_lots", f"""SELECT a.cust, CAST(a.lot AS BIGINT) AS lot, a.date AS buy_date, a.price AS buy_px, b.date AS sell_date, b.price AS sell_px, b.reason, (b.price - a.price) / a.price * 100 AS ret
    FROM ({lot_side('O')}) AS a JOIN ({lot_side('F')}) AS b USING (cust, lot)""")


def lots(t):
    o = t.raw("orders").select(c("o_custkey").alias("cust"), c("o_orderdate").cast("date").alias("date"), c("o_orderkey").alias("id"),
                               (1 + c("o_orderkey") % 3).alias("lots"), c("o_totalprice").alias("price"), c("o_orderpriority").alias("reason"), "o_orderstatus")
    return E.fifo_lots(o.filter(c("o_orderstatus") == "O").drop("o_orderstatus", "reason"), o.filter(c("o_orderstatus") == "F").drop("o_orderstatus"), "cust")


@query("e5_fifo_lots", f"SELECT cust, lot, buy_date, buy_px, sell_date, sell_px, reason, {R('ret', 6)} AS ret FROM f_lots")
def e5(t):
    return rounded(lots(t), ret=6)


REASON_SQL = """CASE reason WHEN '1-URGENT' THEN '到期强制卖出' WHEN '2-HIGH' THEN '动能消失·顶背离' WHEN '3-MEDIUM' THEN '动能消失·J跌破80'
    WHEN '5-LOW' THEN '动能消失·RSI跌破65' ELSE reason END"""


@query("a17_lot_statistics", f"""SELECT CAST(year AS INTEGER) AS year, reason, count(*) AS n, count(*) FILTER (WHERE ret > 0) AS wins, {R('avg(ret)', 6)} AS avg_ret,
    {R('count(*) FILTER (WHERE ret > 0) / count(*) * 100', 6)} AS winrate FROM (SELECT ret, year(buy_date) AS year, {REASON_SQL} AS reason FROM f_lots) GROUP BY GROUPING SETS ((), (year), (reason))""")
def a17(t):
    text = (F.when(c("reason") == "1-URGENT", "满60日到期卖出").when(c("reason") == "2-HIGH", "顶背离了结").when(c("reason") == "3-MEDIUM", "周线J跌破80")
            .when(c("reason") == "5-LOW", "RSI跌破65卖出").otherwise(c("reason")))
    return rounded(E.lot_statistics(lots(t).withColumn("reason", text)), avg_ret=6, winrate=6)


@query("a18_activity_overview", f"""WITH p AS (SELECT o_orderpriority AS key, CASE WHEN o_orderstatus = 'O' THEN 'buy' ELSE 'sell' END AS action,
      [0, 100, 125, 150][CAST(o_orderkey % 4 AS INT) + 1] AS pos_after, [150, 125, 100, 0][CAST(o_orderkey % 4 AS INT) + 1] AS pos_before, CAST(o_orderdate AS DATE) AS date FROM orders),
    s AS (SELECT key, min(date) AS firstd, max(date) AS lastd, count(*) FILTER (WHERE action = 'buy' AND pos_after > 100) AS add_total, count(*) FILTER (WHERE action = 'sell' AND pos_after = 0) AS clear_total,
      count(*) FILTER (WHERE action = 'sell' AND pos_after = 100 AND pos_before > 100) AS temp_sell_total FROM p GROUP BY key),
    k AS (SELECT reason AS key, avg(date_diff('day', buy_date, sell_date)) AS hold_avg, min(date_diff('day', buy_date, sell_date)) AS hold_min, max(date_diff('day', buy_date, sell_date)) AS hold_max,
      avg(CASE WHEN ret > 0 THEN 1 ELSE 0 END) AS winrate FROM f_lots GROUP BY reason)
    SELECT key, add_total, clear_total, temp_sell_total, {R('hold_avg', 6)} AS hold_avg, CAST(hold_min AS INTEGER) AS hold_min, CAST(hold_max AS INTEGER) AS hold_max, {R('winrate', 9)} AS winrate,
    {R("add_total / (date_diff('day', firstd, lastd) / 365.25)", 6)} AS add_per_year FROM s LEFT JOIN k USING (key)""")
def a18(t):
    k = (c("o_orderkey") % 4).cast("int") + 1
    arr = lambda *v: F.element_at(F.array(*[F.lit(x) for x in v]), k)
    o = t.raw("orders").select(c("o_orderpriority").alias("key"), c("o_orderdate").cast("date").alias("date"),
                               F.when(c("o_orderstatus") == "O", "buy").otherwise("sell").alias("action"),
                               arr(0, 100, 125, 150).alias("pos_after"), arr(150, 125, 100, 0).alias("pos_before"))
    span = o.groupBy("key").agg(F.min("date").alias("first"), F.max("date").alias("last"))
    out = E.activity_overview(o, lots(t).withColumnRenamed("reason", "key"), span)
    return rounded(out.select("key", "add_total", "clear_total", "temp_sell_total", "hold_avg", "hold_min", "hold_max", "winrate", "add_per_year"),
                   hold_avg=6, winrate=9, add_per_year=6)


# ---- NAV and metrics ---------------------------------------------------------------------------

def equity(t):
    return t.index_series.select(c("series_id").alias("key"), "date", c("close").alias("nav"))


def bench(t):
    return t.index_series.filter(c("series_id") == "ALL").select("date", c("close").alias("bnav"))


cte("f_eq", "SELECT series_id AS key, date, close AS nav FROM f_index")
cte("f_bn", "SELECT date, close AS bnav FROM f_index WHERE series_id = 'ALL'")


@query("a19_calendar_returns", f"""SELECT key, CAST(year AS INTEGER) AS year, {R('lastn / coalesce(lag(lastn) OVER (PARTITION BY key ORDER BY year), firstn) - 1', 9)} AS ret FROM (
    SELECT key, year(date) AS year, arg_max(nav, date) AS lastn, arg_min(nav, date) AS firstn FROM f_eq GROUP BY 1, 2)""")
def a19(t):
    return rounded(E.calendar_returns(equity(t)), ret=9)


@query("a19b_monthly_win", f"""SELECT key, {R('avg(CASE WHEN r > 0 THEN 1 ELSE 0 END)', 9)} AS month_win, count(*) AS months FROM (
    SELECT key, n / lag(n) OVER (PARTITION BY key ORDER BY m) - 1 AS r FROM (SELECT key, date_trunc('month', date) AS m, arg_max(nav, date) AS n FROM f_eq GROUP BY 1, 2)) WHERE r IS NOT NULL GROUP BY key""")
def a19b(t):
    return rounded(E.monthly_win_rate(equity(t)), month_win=9)


cte("f_perf", """SELECT key, min(date) AS start, max(date) AS "end", count(*) AS n, arg_max(nav, date) / arg_min(nav, date) - 1 AS total, date_diff('day', min(date), max(date)) / 365.25 AS years,
    pow(arg_max(nav, date) / arg_min(nav, date), 1 / (date_diff('day', min(date), max(date)) / CAST(365.25 AS DOUBLE))) - 1 AS cagr, avg(r) AS mr, stddev_samp(r) AS s1, stddev_pop(r) AS s0, min(dd) AS mdd,
    avg(CASE WHEN r > 0 THEN 1 WHEN r IS NOT NULL THEN 0 END) AS day_win, arg_max(nav, date) AS final_nav, avg(r - br) AS mx, stddev_samp(r - br) AS sx, arg_max(bnav, date) / arg_min(bnav, date) - 1 AS bench_total FROM (
    SELECT *, nav / lag(nav) OVER w - 1 AS r, bnav / lag(bnav) OVER w - 1 AS br, nav / max(nav) OVER (PARTITION BY key ORDER BY date ROWS UNBOUNDED PRECEDING) - 1 AS dd
    FROM f_eq JOIN f_bn USING (date) WINDOW w AS (PARTITION BY key ORDER BY date)) GROUP BY key""")
PERF = f"""key, start, "end", n, {R('total', 9)} AS total, {R('years', 6)} AS years, {R('cagr', 9)} AS cagr, {R('mdd', 9)} AS mdd, {R('CASE WHEN mdd < 0 THEN cagr / abs(mdd) ELSE 0 END', 7)} AS calmar,
    {R('day_win', 9)} AS day_win, {R('final_nav', 6)} AS final_nav"""
PR = dict(total=9, years=6, cagr=9, mdd=9, calmar=7, day_win=9, final_nav=6, sharpe=7)


@query("a20_performance", f"""SELECT {PERF}, {R('mr / s1 * sqrt(CAST(252 AS DOUBLE))', 7)} AS sharpe, {R('CASE WHEN sx > 1e-12 THEN mx / sx * sqrt(CAST(252 AS DOUBLE)) ELSE 0 END', 7)} AS ir,
    {R('bench_total', 9)} AS bench_total, {R('pow(1 + bench_total, CAST(0.63 AS DOUBLE)) - 1', 9)} AS bench_adj_total FROM f_perf""")
def a20(t):
    return rounded(E.performance(equity(t), 252, 1, benchmark=bench(t), exposure=0.63), **PR, ir=7, bench_total=9, bench_adj_total=9)


@query("a20b_performance_244", f"SELECT {PERF}, {R('mr / s1 * sqrt(CAST(244 AS DOUBLE))', 7)} AS sharpe FROM f_perf")
def a20b(t):
    return rounded(E.performance(equity(t), 244, 1), **PR)


@query("a20c_performance_pop", f"SELECT {PERF}, {R('mr / s0 * sqrt(CAST(252 AS DOUBLE))', 7)} AS sharpe FROM f_perf")
def a20c(t):
    return rounded(E.performance(equity(t), 252, 0), **PR)


cte("f_w", """SELECT key, date, close, CASE state WHEN 'Z0' THEN CAST(0 AS DOUBLE) WHEN 'Z1' THEN 1.0 WHEN 'Z2' THEN 1.25 ELSE 1.5 END AS w FROM (
    SELECT series_id AS key, date, close, coalesce(lag(state) OVER (PARTITION BY series_id ORDER BY date), 'Z1') AS state FROM f_regime)""")
cte("f_wn", "SELECT *, row_number() OVER (PARTITION BY key ORDER BY date) AS rn FROM f_w")
# The day loop written as a recursive walk: cash, units and running cost.
cte("f_nav", """SELECT key, rn, date, w, CAST(100000.0 AS DOUBLE) * (1 - w) AS cash, CAST(100000.0 AS DOUBLE) * w / close AS q, CAST(100000.0 AS DOUBLE) AS gross,
      CASE WHEN w > 0 THEN greatest(100000.0 * w * 1e-4, 5.0) + 100000.0 * w * 5e-4 ELSE CAST(0 AS DOUBLE) END + CASE WHEN w > 1 + 1e-9 THEN 100000.0 * (w - 1) * 0.07 / 252 ELSE CAST(0 AS DOUBLE) END AS cost
      FROM f_wn WHERE rn = 1 UNION ALL
    SELECT t.key, t.rn, t.date, t.w, CASE WHEN ch THEN v * (1 - t.w) ELSE e.cash END, CASE WHEN ch THEN v * t.w / t.close ELSE e.q END, v,
      CASE WHEN ch AND amt > 0 THEN greatest(amt * 1e-4, 5.0) + amt * 5e-4 ELSE CAST(0 AS DOUBLE) END + CASE WHEN t.w > 1 + 1e-9 THEN v * (t.w - 1) * 0.07 / 252 ELSE CAST(0 AS DOUBLE) END
    FROM f_nav AS e JOIN f_wn AS t ON t.key = e.key AND t.rn = e.rn + 1, LATERAL (SELECT e.cash + e.q * t.close AS v, abs(t.w - e.w) > 1e-12 AS ch,
      abs((e.cash + e.q * t.close) * t.w - e.q * t.close) AS amt) AS z""")


def target_weights(t):
    r = K.regime(t.index_series)
    s = F.coalesce(F.lag("state").over(W.by("series_id")), F.lit("Z1"))
    w = F.when(s == "Z0", 0.0).when(s == "Z1", 1.0).when(s == "Z2", 1.25).otherwise(1.5)
    return r.select(c("series_id").alias("key"), "date", "close", w.alias("weight"))


@query("e3_nav_from_targets", f"""SELECT key, date, w AS weight, {R('gross', 3)} AS gross, {R('cost', 5)} AS cost,
    {R('(gross - sum(cost) OVER (PARTITION BY key ORDER BY date ROWS UNBOUNDED PRECEDING)) / 100000.0', 8)} AS nav FROM f_nav""")
def e3(t):
    return rounded(E.nav_from_targets(target_weights(t)), gross=3, cost=5, nav=8)


cte("f_nw", """SELECT d.date, sum(h.weight * coalesce(s.ret, 0)) AS ret, sum(h.weight) AS exposure FROM (
    SELECT k.date, max(m.date) AS set_date FROM f_pdays AS k JOIN (SELECT DISTINCT date FROM f_targets) AS m ON m.date < k.date GROUP BY k.date) AS d
    JOIN f_targets AS h ON h.date = d.set_date LEFT JOIN f_sector AS s ON s.date = d.date AND s.industry = h.industry GROUP BY d.date""")


def sector_weights(t, f):
    return sector_targets(t, f).select(F.lit("top").alias("key"), "date", c("industry").alias("member"), "weight")


@query("e4_nav_from_weights", f"SELECT 'top' AS key, date, {R('ret', 9)} AS ret, {R('exposure', 9)} AS exposure, {R('exp(sum(ln(1 + ret)) OVER (ORDER BY date ROWS UNBOUNDED PRECEDING))', 9)} AS nav FROM f_nw")
def e4(t):
    f = sector_table(t)
    return rounded(E.nav_from_weights(sector_weights(t, f), f.select("date", c("industry").alias("member"), "ret")), ret=9, exposure=9, nav=9)


@query("e4b_turnover", f"""WITH m AS (SELECT date, lag(date) OVER (ORDER BY date) AS pd FROM (SELECT DISTINCT date FROM f_targets)),
    ch AS (SELECT m.date, industry, weight AS d FROM m JOIN f_targets USING (date) UNION ALL SELECT m.date, t.industry, -t.weight FROM m JOIN f_targets AS t ON t.date = m.pd)
    SELECT 'top' AS key, date, {R('sum(abs(d)) / 2', 9)} AS turnover FROM (SELECT date, industry, sum(d) AS d FROM ch GROUP BY 1, 2) GROUP BY date""")
def e4b(t):
    return rounded(E.turnover(sector_weights(t, sector_table(t))), turnover=9)


@query("e7_watchlists", f"""WITH h AS (SELECT code, volume * 1.0 AS value, (CAST(volume AS DOUBLE) % 200) / 1000 - 0.1 AS pnl_pct, CAST(volume % 11 AS INTEGER) AS hold_days FROM f_bars
      WHERE date = (SELECT max(date) FROM f_bars)),
    b AS (SELECT code, row_number() OVER (ORDER BY score DESC, code) AS rank FROM f_signals WHERE date = (SELECT max(date) FROM f_signals))
    SELECT 'buy' AS list, code, CAST(rank AS INTEGER) AS rank, CAST(NULL AS DOUBLE) AS value FROM b WHERE rank <= 3 UNION ALL
    SELECT 'due', code, 10 - hold_days, CAST(value AS DOUBLE) FROM h WHERE hold_days >= 8 UNION ALL
    SELECT 'risk', code, NULL, {R('d', 9)} FROM (SELECT code, 1 - 0.92 / ((1 + pnl_pct) * 1.0011) AS d FROM h) WHERE d BETWEEN 0 AND 0.02 UNION ALL
    SELECT 'holdings_share', NULL, NULL, {R('sum(value) / 5000', 9)} FROM h""")
def e7(t):
    last = t.bars.agg(F.max("date")).scalar()
    h = t.bars.filter(c("date") == last).select(
        "code", c("volume").cast("double").alias("value"), ((c("volume").cast("double") % 200) / 1000 - 0.1).alias("pnl_pct"), (c("volume") % 11).cast("int").alias("hold_days"))
    return rounded(E.watchlists(materialize(signal_table(t), "signals"), h, 5000.0), value=9)


@query("e8_rebase_window", f"""SELECT key, date, {R('nav / n0 * 1000000', 4)} AS equity, {R('bnav / b0 * 1000000', 4)} AS bench FROM (
    SELECT *, first_value(nav) OVER (PARTITION BY key ORDER BY date) AS n0, first_value(bnav) OVER (PARTITION BY key ORDER BY date) AS b0 FROM (
    SELECT e.key, e.date, e.nav, b.bnav FROM f_eq AS e ASOF LEFT JOIN (SELECT * FROM f_bn WHERE isodow(date) = 5) AS b ON e.date >= b.date) WHERE date >= DATE '1998-01-01')""")
def e8(t):
    return rounded(E.rebase_window(equity(t), bench(t).filter(F.weekday("date") == 4), "1998-01-01"), equity=4, bench=4)


@query("e9_thin_series", f"""WITH p AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY date) - 1 AS pos, count(*) OVER (PARTITION BY key) AS total,
      first_value(date) OVER (PARTITION BY key ORDER BY nav, date) AS lo, first_value(date) OVER (PARTITION BY key ORDER BY nav DESC, date) AS hi FROM f_eq)
    SELECT key, date, {R('nav', 9)} AS nav FROM p WHERE pos % greatest(1, total // 100) = 0 OR pos = total - 1 OR date = lo OR date = hi""")
def e9(t):
    return rounded(E.thin_series(equity(t), 100), nav=9)


GRID = [("rank_min", 0.7), ("rank_min", 0.8), ("rank_min", 0.9), ("ret20_max", 0.05), ("ret20_max", 0.6), ("amt20_min", 10_000.0), ("amt20_min", 20_000.0)]
PERIODS = [("1995-1996", "1995-01-01", "1996-12-31"), ("1997-1999", "1997-01-01", "1999-12-31"), ("2000-", "2000-01-01", None)]


@query("e10_param_sweep", f"""WITH g AS (SELECT * FROM (VALUES {', '.join(f"('{p}', CAST({v} AS DOUBLE))" for p, v in GRID)}) AS v(param, value)),
    d AS (SELECT *, CASE WHEN date <= DATE '1996-12-31' THEN '1995-1996' WHEN date <= DATE '1999-12-31' THEN '1997-1999' ELSE '2000-' END AS period FROM f_screen JOIN f_fut USING (code, date))
    SELECT param, value, period, count(*) AS n, {R('avg(fut)', 9)} AS avg_fut, {R('avg(CASE WHEN fut > 0 THEN 1 WHEN fut IS NOT NULL THEN 0 END)', 9)} AS win_rate FROM d, g
    WHERE f_close_ok AND rk >= CASE WHEN param = 'rank_min' THEN value ELSE 0.80 END AND ret20 < CASE WHEN param = 'ret20_max' THEN value ELSE 0.60 END
    AND amt20 >= CASE WHEN param = 'amt20_min' THEN value ELSE 10000 END GROUP BY 1, 2, 3""".replace("f_screen JOIN f_fut USING (code, date)", "f_screen JOIN (SELECT code, date, fut FROM f_fut) USING (code, date)").replace(
    "f_close_ok", "close - ma20 > 1e-9 AND ma20 - ma60 > 1e-9 AND ma60_rising AND ret120 > 0"))
def e10(t):
    ind = K.indicators(t.both_bases)
    ind = ind.withColumn("fut", F.try_divide(F.lead("raw_close", 5).over(W.by()), c("raw_close")) - 1)
    return rounded(E.screen_sweep(ind, "fut", GRID, PERIODS, K.ScreenParams(rank_min=0.80, amt20_min=10_000.0)), avg_fut=9, win_rate=9)


PERIOD_SQL = "CASE WHEN {d} < DATE '1995-01-01' THEN NULL WHEN {d} <= DATE '1996-12-31' THEN '1995-1996' WHEN {d} <= DATE '1999-12-31' THEN '1997-1999' ELSE '2000-' END"
TIMING_GRID = [("j_low", 15.0), ("j_low", 25.0), ("j_low", 40.0), ("rsi_os", 44.0), ("rsi_os", 48.0), ("rsi_os", 52.0), ("y_down", 0.5), ("y_down", 1.0), ("y_down", 2.0),
               ("j_high", 60.0), ("j_high", 70.0), ("j_high", 85.0), ("x_up", 0.5), ("x_up", 1.0), ("x_up", 3.0)]


def _grid_value(param, base):
    return f"CASE WHEN param = '{param}' THEN value ELSE {base} END"


@query("e10b_timing_sweep", f"""WITH g AS (SELECT * FROM (VALUES {', '.join(f"('{p}', CAST({v} AS DOUBLE))" for p, v in TIMING_GRID)}) AS v(param, value)),
    d AS (SELECT *, {PERIOD_SQL.format(d='date')} AS period, lead(px, 20) OVER (PARTITION BY series_id ORDER BY date) / px - 1 AS fut FROM f_timing),
    h AS (SELECT param, value, period, fut, CASE WHEN param IN ('j_high', 'x_up') THEN coalesce(wj > {_grid_value('j_high', 70)} AND px >= upper AND up63 >= {_grid_value('x_up', 1)}, false) ELSE
      CAST(coalesce(wj < {_grid_value('j_low', 25)}, false) AS INT) + CAST(coalesce(px <= lower, false) AS INT) + CAST(coalesce(dn63 <= -{_grid_value('y_down', 1)} AND dn10 <= dn63 * 0.6, false) AS INT)
      + CAST(coalesce(wrsi < {_grid_value('rsi_os', 48)}, false) AS INT) >= 2 AND coalesce(spread_pct >= 0.5, false) AND coalesce(px < ma250, false) END AS hit FROM d, g)
    SELECT param, value, period, count(*) AS n, {R('avg(fut)', 9)} AS avg_fut, {R('avg(CASE WHEN fut > 0 THEN 1 WHEN fut IS NOT NULL THEN 0 END)', 9)} AS win_rate
    FROM h WHERE hit AND period IS NOT NULL GROUP BY 1, 2, 3""")
def e10b(t):
    ind = I.timing_indicators(t.index_series, t.calendar, t.yields, PARAMS)
    return rounded(SW.timing_sweep(ind, PARAMS, TIMING_GRID, PERIODS), avg_fut=9, win_rate=9)


STOPS = [0.88, 0.92, 0.95, 0.98]


@query("e10c_stop_sweep", f"""WITH h AS (SELECT s.stop, x.code, x.date, x.entry_date, x.entry_px, x.hold, x.hrn,
      k.close <= x.entry_px * s.stop OR x.hold >= 10 OR (x.hold >= 2 AND k.shrink) AS ends FROM f_esh AS x JOIN f_esb AS k ON k.code = x.code AND k.rn = x.hrn,
      (VALUES {', '.join(f'(CAST({x} AS DOUBLE))' for x in STOPS)}) AS s(stop)),
    g AS (SELECT stop, code, date, any_value(entry_date) AS entry_date, any_value(entry_px) AS entry_px, min(hrn) FILTER (WHERE ends) AS trn FROM h GROUP BY stop, code, date),
    r AS (SELECT g.*, x.open * (1 - 0.001) * (1 - 0.0001 - 0.0005) / (entry_px * (1 + 0.001) * (1 + 0.0001)) - 1 AS ret FROM g
      LEFT JOIN LATERAL (SELECT min(k.rn) AS xrn FROM f_esb AS k WHERE k.code = g.code AND k.rn > g.trn AND NOT k.no_sell) AS m ON true LEFT JOIN f_esb AS x ON x.code = g.code AND x.rn = m.xrn)
    SELECT stop, {PERIOD_SQL.format(d='entry_date')} AS period, count(*) AS n, {R('avg(CASE WHEN ret > 0 THEN 1 ELSE 0 END)', 9)} AS win_rate, {R('avg(ret)', 9)} AS avg_ret
    FROM r WHERE ret IS NOT NULL GROUP BY 1, 2""")
def e10c(t):
    bars = K.indicators(t.both_bases).withColumn("shrink", K.volume_shrink())
    return rounded(SW.stop_sweep(signal_table(t).select("code", "date"), bars, STOPS, PERIODS), win_rate=9, avg_ret=9)


SLIPPAGES = [0.0, 0.0005, 0.001, 0.003]


@query("e10d_cost_sweep", f"""SELECT slippage, {PERIOD_SQL.format(d='entry_date')} AS period, count(*) AS n, {R('avg(CASE WHEN ret > 0 THEN 1 ELSE 0 END)', 9)} AS win_rate, {R('avg(ret)', 9)} AS avg_ret FROM (
    SELECT entry_date, slippage, exit_px * (1 - slippage) * (1 - 0.0001 - 0.0005) / (entry_px * (1 + slippage) * (1 + 0.0001)) - 1 AS ret
    FROM f_es, (VALUES {', '.join(f'(CAST({x} AS DOUBLE))' for x in SLIPPAGES)}) AS s(slippage) WHERE exit_px IS NOT NULL) GROUP BY 1, 2""")
def e10d(t):
    return rounded(SW.cost_sweep(study(t), SLIPPAGES, PERIODS), win_rate=9, avg_ret=9)


SIZES = [1, 2, 4, 8]


@query("e10e_top_n_sweep", f"""WITH d AS (SELECT *, CASE WHEN count(*) OVER w = 20 THEN exp(sum(ln(1 + coalesce(ret, 0))) OVER w) - 1 END AS fut FROM f_sector
      WINDOW w AS (PARTITION BY industry ORDER BY date ROWS BETWEEN 1 FOLLOWING AND 20 FOLLOWING)),
    r AS (SELECT *, row_number() OVER (PARTITION BY date ORDER BY score DESC, industry) AS rank FROM d SEMI JOIN f_mend USING (date) WHERE score IS NOT NULL)
    SELECT 'top_n' AS param, value, {PERIOD_SQL.format(d='date')} AS period, count(*) AS n, {R('avg(fut)', 9)} AS avg_fut,
    {R('avg(CASE WHEN fut > 0 THEN 1 WHEN fut IS NOT NULL THEN 0 END)', 9)} AS win_rate
    FROM r, (VALUES {', '.join(f'(CAST({x} AS DOUBLE))' for x in SIZES)}) AS s(value) WHERE rank <= value AND {PERIOD_SQL.format(d='date')} IS NOT NULL GROUP BY 1, 2, 3""")
def e10e(t):
    return rounded(SW.top_n_sweep(sector_table(t), SIZES, PERIODS), avg_fut=9, win_rate=9)


# A score both engines compute alike: a congruential mix of seed, day position and industry.
MIX_SQL = "((seed * 7919 + CAST(i AS BIGINT) * 104729 + ascii(industry) * 1299709 + length(industry) * 15485863) * 48271) % 2147483647"


@query("e11_random_control", f"""WITH r AS (SELECT industry, date, {MIX_SQL} AS s, seed FROM f_sector SEMI JOIN f_mend USING (date), (SELECT CAST(unnest(generate_series(1, 150)) AS BIGINT) AS seed) WHERE pooled),
    tp AS (SELECT seed, date, industry, 1.0 / count(*) OVER (PARTITION BY seed, date) AS weight FROM (SELECT *, row_number() OVER (PARTITION BY seed, date ORDER BY s DESC, industry) AS rk FROM r) WHERE rk <= 3),
    d AS (SELECT k.date, max(m.date) AS sd FROM f_pdays AS k JOIN (SELECT DISTINCT date FROM tp) AS m ON m.date < k.date GROUP BY k.date),
    n AS (SELECT tp.seed, d.date, sum(tp.weight * coalesce(x.ret, 0)) AS ret FROM d JOIN tp ON tp.date = d.sd LEFT JOIN f_sector AS x ON x.date = d.date AND x.industry = tp.industry GROUP BY 1, 2),
    v AS (SELECT *, exp(sum(ln(1 + ret)) OVER (PARTITION BY seed ORDER BY date ROWS UNBOUNDED PRECEDING)) AS nav FROM n),
    q AS (SELECT *, nav / lag(nav) OVER (PARTITION BY seed ORDER BY date) - 1 AS rr FROM v),
    p AS (SELECT seed, avg(rr) / stddev_pop(rr) * sqrt(CAST(252 AS DOUBLE)) AS sharpe FROM q GROUP BY seed),
    rn AS (SELECT date, ret / 1 AS r0, exp(sum(ln(1 + ret)) OVER (ORDER BY date ROWS UNBOUNDED PRECEDING)) AS nav FROM f_nw),
    rl AS (SELECT avg(rr) / stddev_pop(rr) * sqrt(CAST(252 AS DOUBLE)) AS target FROM (SELECT nav / lag(nav) OVER (ORDER BY date) - 1 AS rr FROM rn))
    SELECT count(*) AS n, {R('avg(sharpe)', 6)} AS sharpe_mean, {R('quantile_cont(sharpe, 0.5)', 6)} AS sharpe_p50, {R('quantile_cont(sharpe, 0.95)', 6)} AS sharpe_p95, {R('max(sharpe)', 6)} AS sharpe_max,
    {R('avg(CASE WHEN sharpe < (SELECT target FROM rl) THEN 1 ELSE 0 END)', 9)} AS percentile, {R('1 - avg(CASE WHEN sharpe < (SELECT target FROM rl) THEN 1 ELSE 0 END)', 9)} AS p_value FROM p""")
def e11(t):
    f = sector_table(t).select("industry", "date", "i", "ret", "pooled")
    pos = F.col("i").cast("bigint")
    ind = F.ascii("industry").cast("bigint") * 1299709 + F.length("industry").cast("bigint") * 15485863
    mix = ((c("key").cast("bigint") * 7919 + pos * 104729 + ind) * 48271) % 2147483647
    nav = E.nav_from_weights(sector_weights(t, sector_table(t)), f.select("date", c("industry").alias("member"), "ret"))
    real = E.performance(nav, ddof=0).select("sharpe")
    return rounded(E.random_control(f, 150, 3, real, score=mix), sharpe_mean=6, sharpe_p50=6, sharpe_p95=6, sharpe_max=6, percentile=9, p_value=9)


SIGMAS = [0.005, 0.01, 0.02, 0.05, 0.10, 0.20]
NOISE_SQL = "((seed * 7919 + CAST(i AS BIGINT) * 104729 + ascii(industry) * 1299709 + length(industry) * 15485863 + CAST(round(sigma * 1000) AS BIGINT) * 611953) * 48271) % 2147483647"


@query("e12_noise_neighbourhood", f"""WITH k AS (SELECT sigma, seed FROM (SELECT unnest({SIGMAS})::DOUBLE AS sigma), (SELECT CAST(unnest(generate_series(1, 5)) AS BIGINT) AS seed)),
    m AS (SELECT sigma, seed, date, industry, ret, {NOISE_SQL} AS m1 FROM f_sector, k WHERE ret IS NOT NULL),
    x AS (SELECT sigma, seed, date, industry, ret + sigma * sqrt(-2 * ln((m1 + 1) / CAST(2147483648 AS DOUBLE))) * cos(2 * pi() * (((m1 * 48271 + 11) % 2147483647) / CAST(2147483648 AS DOUBLE))) AS ret FROM m),
    d AS (SELECT r.date, max(t.date) AS sd FROM (SELECT DISTINCT date FROM x) AS r JOIN (SELECT DISTINCT date FROM f_targets) AS t ON t.date < r.date GROUP BY r.date),
    n AS (SELECT k.sigma, k.seed, d.date, sum(h.weight * coalesce(x.ret, 0)) AS ret FROM d JOIN f_targets AS h ON h.date = d.sd CROSS JOIN k
      LEFT JOIN x ON x.sigma = k.sigma AND x.seed = k.seed AND x.date = d.date AND x.industry = h.industry GROUP BY 1, 2, 3),
    v AS (SELECT *, exp(sum(ln(1 + ret)) OVER (PARTITION BY sigma, seed ORDER BY date ROWS UNBOUNDED PRECEDING)) AS nav FROM n),
    q AS (SELECT *, nav / lag(nav) OVER (PARTITION BY sigma, seed ORDER BY date) - 1 AS rr, nav / max(nav) OVER (PARTITION BY sigma, seed ORDER BY date ROWS UNBOUNDED PRECEDING) - 1 AS dd FROM v),
    p AS (SELECT sigma, seed, arg_max(nav, date) / arg_min(nav, date) - 1 AS total, avg(rr) / stddev_pop(rr) * sqrt(CAST(252 AS DOUBLE)) AS sharpe, min(dd) AS mdd FROM q GROUP BY 1, 2)
    SELECT sigma, count(*) AS n_seed, {', '.join(f"{R(f'quantile_cont({x}, {z})', 6)} AS {x}_p{int(z * 100)}" for x in ('total', 'sharpe', 'mdd') for z in (0.05, 0.5, 0.95))} FROM p GROUP BY sigma""")
def e12(t):
    f = sector_table(t)
    ind = F.ascii("member").cast("bigint") * 1299709 + F.length("member").cast("bigint") * 15485863
    m1 = ((c("seed").cast("bigint") * 7919 + c("i").cast("bigint") * 104729 + ind + F.round(c("sigma") * 1000).cast("bigint") * 611953) * 48271) % 2147483647
    u1, u2 = ((x + 1) / F.lit(2147483648.0) if k == 0 else x / F.lit(2147483648.0) for k, x in enumerate((m1, (m1 * 48271 + 11) % 2147483647)))
    returns = f.select("date", "i", c("industry").alias("member"), "ret").filter(c("ret").isNotNull())
    out = E.noise_neighbourhood(returns, sector_weights(t, f).drop("key"), SIGMAS, 5, uniforms=(u1, u2))
    return rounded(out, **{x: 6 for x in out.columns if x not in ("sigma", "n_seed")})


@query("a23_latest_factors", """SELECT code, round(c0, 2) AS close, round(c0 / c20 - 1, 4) AS mom_20, round(c0 / c60 - 1, 4) AS mom_60, round(sd * sqrt(CAST(252 AS DOUBLE)), 4) AS vol_20 FROM (
    SELECT code, max(close) FILTER (WHERE b = 0) AS c0, max(close) FILTER (WHERE b = 20) AS c20, max(close) FILTER (WHERE b = 60) AS c60, stddev_pop(r) FILTER (WHERE b < 20) AS sd FROM (
    SELECT code, close, row_number() OVER (PARTITION BY code ORDER BY date DESC) - 1 AS b, close / lead(close) OVER (PARTITION BY code ORDER BY date DESC) - 1 AS r FROM f_members) GROUP BY code)
    WHERE c20 IS NOT NULL""")
def a23(t):
    return E.latest_factors(t.members)


@query("a24_display_scores", f"""SELECT code, {R('greatest(5, least(98, 50 + mom * 160))', 6)} AS mom_score, {R('greatest(5, least(98, 95 - vol * 120))', 6)} AS vol_score FROM (
    SELECT code, round(c0 / c20 - 1, 4) AS mom, round(sd * sqrt(CAST(252 AS DOUBLE)), 4) AS vol FROM (
    SELECT code, max(close) FILTER (WHERE b = 0) AS c0, max(close) FILTER (WHERE b = 20) AS c20, stddev_pop(r) FILTER (WHERE b < 20) AS sd FROM (
    SELECT code, close, row_number() OVER (PARTITION BY code ORDER BY date DESC) - 1 AS b, close / lead(close) OVER (PARTITION BY code ORDER BY date DESC) - 1 AS r FROM f_ubars) GROUP BY code)
    WHERE c20 IS NOT NULL)""")
def a24(t):
    return rounded(E.display_scores(E.latest_factors(t.ubars)).select("code", "mom_score", "vol_score"), mom_score=6, vol_score=6)


# ---- walk-forward ------------------------------------------------------------------------------

cte("f_blocks", """SELECT CAST((lo - f) // 42 AS INTEGER) AS block, date AS block_start, lo, least(lo + 42, l + 1) AS hi, t0, t0 + greatest(CAST(floor((lo - t0 - 6) * CAST(0.85 AS DOUBLE)) AS BIGINT), 1) AS fit_end,
    t0 + lo - t0 - 6 AS train_end, lo - t0 - 6 AS n_train FROM (SELECT date, td_idx AS lo, (SELECT min(td_idx) FROM f_cal WHERE date >= DATE '1996-01-01') AS f,
    (SELECT max(td_idx) FROM f_cal) AS l, (SELECT min(td_idx) FROM f_cal WHERE date >= DATE '1995-06-01') AS t0 FROM f_cal WHERE date >= DATE '1996-01-01') WHERE (lo - f) % 42 = 0 AND lo - t0 > 46""")


def blocks(t, start="1996-01-01"):
    return E.walk_forward_blocks(t.settled("calendar").calendar, "1995-06-01", start)  # read four times


@query("w29_walk_forward_blocks", "SELECT * FROM f_blocks")
def w29(t):
    return blocks(t)


@query("j9_block_roles", """SELECT block, CASE WHEN td_idx < fit_end THEN 'fit' WHEN td_idx < train_end THEN 'valid' ELSE 'predict' END AS role, date FROM f_cal JOIN f_blocks ON td_idx >= t0 AND td_idx < hi
    WHERE td_idx < train_end OR td_idx >= lo""")
def j9(t):
    b = blocks(t)
    return E.block_roles(t.calendar, b)


def learning(t):
    t.settled("bars", "calendar")  # features, labels and blocks read them again and again
    f = K.features(t.both_bases).select("code", "date", *K.FEATURES)
    return f, K.quantile_labels(K.forward_return(t.bars, 5), "fut").select("code", "date", "label")


@query("e13_walk_forward_score")
def e13(t):
    return E.walk_forward_score(*learning(t), t.calendar, blocks(t), K.FEATURES)


@query("e13b_stored_models", """WITH last AS (SELECT max(block) AS n FROM f_blocks)
    SELECT b.code, b.date, f.block, CASE WHEN f.block = n THEN 2 ELSE 1 END AS fitted_in FROM f_bars AS b JOIN f_cal AS c USING (date)
    JOIN f_blocks AS f ON c.td_idx >= f.lo AND c.td_idx < f.hi, last""")
def e13b(t):
    """Two runs over one model store: the first one ends inside the block before the last, the second reads its scores, scores
    the rest of that block by its stored model and fits the last block only."""
    f, lab = (materialize(x, "learning") for x in learning(t))
    all_blocks = blocks(t)
    lo = sorted(r["lo"] for r in all_blocks.select("lo").collect())  # few blocks
    some_days = t.calendar.filter(c("td_idx") < lo[-2] + 20)
    some_blocks = all_blocks.filter(c("lo") < lo[-1])
    root = shared_dir(t.spark, "models")
    first, second = E.ModelStore(t.spark, root), None
    E.walk_forward_score(f.join(some_days.select("date"), "date", "left_semi"), lab, some_days, some_blocks, K.FEATURES, trees=2, depth=2, store=first)
    second = E.ModelStore(t.spark, root)
    out = E.walk_forward_score(f, lab, t.calendar, all_blocks, K.FEATURES, trees=2, depth=2, store=second)
    run = F.when(c("block").isin(second.fits), 2).when(c("block").isin(first.fits), 1)
    return out.filter(c("score").isNotNull()).select("code", "date", "block", run.alias("fitted_in"))


@query("e14_fill_missing_scores", f"""SELECT date, code, {R('coalesce(v.score, 0)', 9)} AS score, v.score IS NULL AS missing FROM (SELECT date, code FROM f_signals) LEFT JOIN (
    SELECT code, date, score FROM f_signals WHERE dayofmonth(date) % 3 <> 0) AS v USING (code, date)""")
def e14(t):
    s = materialize(signal_table(t), "signals")
    return rounded(E.fill_missing_scores(s.select("date", "code"), s.filter(F.dayofmonth("date") % 3 != 0)).select("date", "code", "score", "missing"), score=9)


@query("t2_sort_signals", "SELECT date, strategy, code, score FROM f_signals ORDER BY date, strategy, score DESC, code")
def t2(t):
    return signal_table(t).orderBy("date", "strategy", c("score").desc(), "code")


@query("t3_last_day_top", "SELECT date, code, score FROM f_signals WHERE date = (SELECT max(date) FROM f_signals) ORDER BY score DESC, code LIMIT 3")
def t3(t):
    s = materialize(signal_table(t), "signals")
    return s.filter(c("date") == s.agg(F.max("date")).scalar()).orderBy(c("score").desc(), "code").limit(3).select("date", "code", "score")


@query("a16b_signal_counts", "SELECT date, strategy, count(*) AS n FROM f_signals GROUP BY date, strategy")
def a16b(t):
    return signal_table(t).groupBy("date", "strategy").agg(F.count("*").alias("n"))


# ---- reconciliation and health -----------------------------------------------------------------

cte("f_snap", """SELECT p_type AS domain, code AS variant, CAST(regexp_extract(code, '(\\d+)', 1) AS INT) AS n, max(date) AS d, count(*) AS trades, sum(l_quantity) AS nav
    FROM f_lines GROUP BY p_type, code""")


def snapshots(t):
    """Two published copies of per-brand figures; the second one differs by known rules."""
    g = t.lines.groupBy(c("p_type").alias("domain"), c("code").alias("variant")).agg(
        F.max("date").alias("data_date"), F.count("*").alias("trades"), F.sum("l_quantity").alias("nav"))
    n = brand_number(c("variant"))

    def payload(nav, note, stamp):
        return F.to_json(F.struct(F.struct(nav.alias("nav"), c("trades").alias("trades"), F.lit(stamp).alias("generated_at")).alias("kpi"), note.alias("note"),
                                  F.lit(stamp).alias("run_id")))
    shadow = g.filter(n != 3).select("domain", "variant", "data_date", payload(c("nav"), F.lit("same"), "a").alias("payload"))
    legacy = g.filter(n != 4).select(
        "domain", "variant", F.when(n == 6, F.date_sub("data_date", 1)).otherwise(c("data_date")).alias("data_date"),
        payload(c("nav") + F.when(n % 5 == 0, 0.5).otherwise(0.0), F.when(n == 7, "other").otherwise("same"), "b").alias("payload"))
    return shadow, legacy


cte("f_verdict", """SELECT domain, variant, n, CASE WHEN n = 4 THEN 'MISSING' WHEN n = 3 THEN 'NOT-STARTED' WHEN n % 5 = 0 OR n IN (6, 7) THEN 'BLOCKED' ELSE 'PROMOTE-READY' END AS verdict FROM f_snap""")


@query("j10_reconcile", """SELECT domain, variant, CASE WHEN n NOT IN (3, 4) THEN CASE WHEN n % 5 = 0 THEN CAST(0.5 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END END AS max_kpi_delta, CASE WHEN n NOT IN (3, 4) THEN CAST(0 AS BIGINT) END AS missing_kpi,
    CASE WHEN n NOT IN (3, 4) THEN n <> 6 END AS data_date_equal, CASE WHEN n NOT IN (3, 4) THEN n % 5 <> 0 END AS kpi_equal, CASE WHEN n NOT IN (3, 4) THEN n % 5 <> 0 AND n <> 7 END AS sha_equal, verdict FROM f_verdict""")
def j10(t):
    return RC.reconcile(*snapshots(t))


@query("j10b_domain_verdict", """SELECT domain, arg_max(verdict, CASE verdict WHEN 'BLOCKED' THEN 3 WHEN 'MISSING' THEN 2 WHEN 'NOT-STARTED' THEN 1 ELSE 0 END) AS verdict FROM f_verdict GROUP BY domain""")
def j10b(t):
    return RC.domain_verdict(RC.reconcile(*snapshots(t)))


def deep(level, inner, list_at: int):
    """The JSON text ``inner`` under objects ``a`` to the given level (1 to 6), of which one is the member of a list."""
    open_ = close = F.lit("")
    for n in range(1, 7):
        steps = ['{"a":' if i != list_at else '{"a":[0,' for i in range(n, 0, -1)]
        open_ = F.when(level == n, F.lit("".join(steps))).otherwise(open_)
        close = F.when(level == n, F.lit("".join("}" if i != list_at else "]}" for i in range(1, n + 1)))).otherwise(close)
    return F.concat(open_, inner, close)


@query("j10c_nested_payloads", """SELECT domain, variant, CASE WHEN n % 7 = 3 THEN CAST(2.5 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS max_kpi_delta,
    CAST(CASE WHEN n % 7 = 4 THEN 1 ELSE 0 END AS BIGINT) AS missing_kpi, true AS data_date_equal, n % 7 NOT IN (3, 4) AS kpi_equal, n % 7 NOT IN (1, 2, 3, 4) AS sha_equal,
    CASE WHEN n % 7 IN (1, 2, 3, 4) THEN 'BLOCKED' ELSE 'PROMOTE-READY' END AS verdict FROM f_snap""")
def j10c(t):
    """Objects and lists of objects under volatile keys at depth 1 to 6, and changes beside them: a text in an object (1) or in a
    list (2), a KPI (3), a KPI that is gone (4), a number in a list, which is no KPI but the same (5)."""
    g = t.lines.groupBy(c("p_type").alias("domain"), c("code").alias("variant")).agg(F.max("date").alias("data_date"))
    n = brand_number(c("variant"))
    case, level = n % 7, n % 6 + 1

    def side(stamp: str, text: int, kpi: str):
        other = F.lit(f'"x{stamp}"')
        member = F.concat(F.lit('{"note":'), F.when(case == text, other).otherwise(F.lit('"x"')), F.lit(',"run_id":[{"nav":1,"by":"' + stamp + '"},[' + f'"{stamp}"' + "]]"),
                          F.lit(',"generated":{"by":{"host":"' + stamp + '","at":["' + stamp + '",{}]}},"e":{"timestamp":{"s":"' + stamp + '"}}'),
                          F.when(case == 4, F.lit("" if kpi else ',"nav":1')).otherwise(F.concat(F.lit(',"nav":'), F.when(case == 3, F.lit(kpi or "7.5")).otherwise(F.lit("5")))),
                          F.lit("}"))
        return F.concat(F.lit('{"top":'), deep(level, member, 0), F.lit(',"listed":'), deep(level, F.concat(F.lit('{"list":[{"v":'), F.when(
            case == 2, other).otherwise(F.lit("1")), F.lit(',"built_at":[{"x":"' + stamp + '"}]}]}')), 3), F.lit("}"))
    at = ["domain", "variant", "data_date"]
    return RC.reconcile(g.select(*at, side("a", 1, "10.0").alias("payload")), g.select(*at, side("b", 1, "").alias("payload")))


@query("a25_run_health", """SELECT domain, count(*) AS n_logs, CAST(sum(bad) AS BIGINT) AS bad_stages, 0 AS empty_logs, max(run_date) AS last_run, CASE WHEN count(*) < 5 THEN 'too_few' WHEN sum(bad) > 0 THEN 'issues' ELSE 'ok' END AS state FROM (
    SELECT *, row_number() OVER (PARTITION BY domain ORDER BY run_date DESC) AS rn FROM f_runs) WHERE rn <= 5 GROUP BY domain""".replace("0 AS empty_logs", "CAST(0 AS BIGINT) AS empty_logs"))
def a25(t):
    return RC.run_health(t.runs)


@query("a26_promotion_streak", """WITH d AS (SELECT o_orderpriority AS domain, CAST(o_orderdate AS DATE) AS day, arg_min(o_orderstatus, o_orderkey) AS st FROM orders GROUP BY 1, 2),
    g AS (SELECT *, sum(CASE WHEN st <> 'P' THEN 0 ELSE 1 END) OVER (PARTITION BY domain ORDER BY day ROWS UNBOUNDED PRECEDING) AS seg FROM d)
    SELECT domain, day, CASE WHEN st <> 'P' THEN 'PROMOTE-READY' ELSE 'BLOCKED' END AS verdict, n AS consecutive, n >= 3 AS promoted FROM (
    SELECT *, CAST(sum(CASE WHEN st <> 'P' THEN 1 ELSE 0 END) OVER (PARTITION BY domain, seg ORDER BY day ROWS UNBOUNDED PRECEDING) AS BIGINT) AS n FROM g)""")
def a26(t):
    v = t.raw("orders").select(c("o_orderpriority").alias("domain"), c("o_orderdate").cast("date").alias("day"), c("o_orderkey").alias("seq"),
                               F.when(c("o_orderstatus") != "P", "PROMOTE-READY").otherwise("BLOCKED").alias("verdict"))
    return RC.promotion_streak(v).select("domain", "day", "verdict", "consecutive", "promoted")


@query("a29_publication_health", """SELECT max(d) AS day, count(DISTINCT domain) FILTER (WHERE domain <> 'PROMO') / CAST(count(DISTINCT domain) + 1 AS DOUBLE) AS coverage FROM f_snap WHERE n <> 3""")
def a29(t):
    shadow, _ = snapshots(t)
    env = shadow.withColumn("payload", F.when(c("domain") == "PROMO", F.lit("{}")).otherwise(c("payload")))
    # The part types, and one domain that never publishes.
    return RC.publication_health(env, ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD", "ABSENT"])
