"""Queries over limit-ups, seats, sectors and index timing."""

from __future__ import annotations

from pyspark.sql import functions as F

from factorspark.functions import windows as W
from factorspark.operators import indices as I
from factorspark.operators import limits as L
from factorspark.operators import sectors as S
from factorspark.plans.ctes import cte
from factorspark.plans.data_plans import LIMIT3_SQL
from factorspark.plans.registry import R, query, rounded
from factorspark.session import materialize
from factorspark.plans.stock_plans import ewm_cte, sql_pct, sql_roll

c = F.col

# ---- limit-ups and seats -----------------------------------------------------------------------

cte("f_zt0", f"""SELECT *, CASE WHEN coalesce(close >= round_even((prev_close * (1 + threshold / 100) + 1e-9) * 100, 0) / 100 - 0.001, false) THEN 1 ELSE 0 END AS limit_up,
    (close / nullif(prev_close, 0) - 1) * 100 AS change_rate FROM (SELECT *, lag(close) OVER (PARTITION BY code ORDER BY date) AS prev_close, {LIMIT3_SQL} AS threshold FROM f_ubars)""")
cte("f_zt", f"""SELECT *, CAST(CASE WHEN limit_up = 1 THEN sum(limit_up) OVER (PARTITION BY code, seg ORDER BY date ROWS UNBOUNDED PRECEDING) ELSE 0 END AS BIGINT) AS limit_count,
    {', '.join(f'CAST(sum(limit_up) OVER (PARTITION BY code ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS BIGINT) AS m{n}' for n in (3, 5, 10))} FROM (
    SELECT *, sum(1 - limit_up) OVER (PARTITION BY code ORDER BY date ROWS UNBOUNDED PRECEDING) AS seg FROM f_zt0)""")
ZT = "date, code, close, change_rate, limit_up, limit_count, m3, m5, m10, threshold"


@query("w17_limit_up", f"""SELECT date, code, close, {R('change_rate', 6)} AS change_rate, CAST(limit_up AS BIGINT) AS limit_up, limit_count, m3, m5, m10, threshold FROM f_zt""")
def w17(t):
    return rounded(L.limit_up_daily(t.ubars), change_rate=6)


@query("w18_limit_up_day", f"""SELECT date, code, close, {R('change_rate', 6)} AS change_rate, CAST(limit_up AS BIGINT) AS limit_up, limit_count, m3, m5, m10, threshold
    FROM f_zt WHERE date = DATE '2024-01-24'""")
def w18(t):
    return rounded(L.limit_up_day(t.ubars, "2024-01-24"), change_rate=6)


cte("f_lad", 'SELECT date, limit_count AS lbc, count(*) AS n FROM f_zt WHERE limit_count > 0 GROUP BY 1, 2')
cte("f_ukal", "SELECT date, row_number() OVER (ORDER BY date) AS k FROM (SELECT DISTINCT date FROM f_ubars)")
cte("f_lkal", "SELECT date, row_number() OVER (ORDER BY date) AS k FROM (SELECT DISTINCT date FROM f_lad)")


def ladder_sql(kal, where=""):
    return f"""SELECT a.date, a.lbc, a.n AS "count", coalesce(p.n, 0) AS prev_count, CAST(a.n AS DOUBLE) / p.n AS promote_rate FROM f_lad AS a JOIN {kal} AS k USING (date)
    LEFT JOIN (SELECT x.lbc, x.n, y.k FROM f_lad AS x JOIN {kal} AS y USING (date)) AS p ON p.k = k.k - 1 AND p.lbc = a.lbc - 1 {where}"""


@query("a13_ladder", ladder_sql("f_ukal"))
def a13(t):
    days = S.day_index(t.ubars).select("date", c("i").cast("bigint").alias("td_idx"))
    return L.ladder(L.limit_up_daily(t.ubars), days)


@query("a13b_ladder_batch", ladder_sql("f_lkal", "WHERE k.k > 1"))
def a13b(t):
    return L.ladder(L.limit_up_daily(t.ubars))


@query("a14_pool_summary", """WITH d AS (SELECT date, lbc, n FROM f_lad), u AS (SELECT date, CAST(sum(n) AS BIGINT) AS zt_count, max(lbc) AS max_lb,
    '{' || string_agg('"' || lbc || '":' || n, ',' ORDER BY lbc) || '}' AS lb_dist FROM d GROUP BY date),
    z AS (SELECT date, count(*) AS zb_count FROM f_zt WHERE limit_up = 0 AND high >= round_even((prev_close * (1 + threshold / 100) + 1e-9) * 100, 0) / 100 - 0.001 GROUP BY date)
    SELECT date, coalesce(zt_count, 0) AS zt_count, coalesce(zb_count, 0) AS zb_count, coalesce(max_lb, 0) AS max_lb, lb_dist FROM u FULL JOIN z USING (date)""")
def a14(t):
    daily = L.limit_up_daily(t.ubars)
    touched = L.limit_up_flags(t.ubars.withColumn("high_", c("high")))
    limit = F.rint((c("prev_close") * (1 + c("threshold") / 100) + 1e-9) * 100) / 100
    return L.pool_summary(daily, touched.filter((c("limit_up") == 0) & (c("high_") >= limit - 0.001)))


@query("w20_rank_seats", """SELECT date, code, trade_id, side, seat_code, row_number() OVER (PARTITION BY date, code, trade_id, side
    ORDER BY CASE WHEN side = 'buy' THEN buy ELSE sell END DESC, seat_code) AS rank FROM f_seats""")
def w20(t):
    return L.rank_seats(t.seats).select("date", "code", "trade_id", "side", "seat_code", "rank")


@query("w20b_rank_seats_wide", """WITH h AS (SELECT CAST(seat_code AS INT) % 3 = 0 AS hot, * FROM f_seats),
    g AS (SELECT CASE WHEN hot THEN DATE '1998-01-01' ELSE date END AS date, CASE WHEN hot THEN 'hot' ELSE code END AS code,
      CASE WHEN hot THEN 0 ELSE trade_id END AS trade_id, side, seat_code, buy, sell FROM h)
    SELECT date, code, trade_id, side, seat_code, row_number() OVER (PARTITION BY date, code, trade_id, side
    ORDER BY CASE WHEN side = 'buy' THEN buy ELSE sell END DESC, seat_code) AS rank FROM g""")
def w20b(t):
    """Two groups hold a third of all seats; they are cut into many pieces."""
    hot = c("seat_code").cast("int") % 3 == 0
    seats = t.seats.withColumns({"date": F.when(hot, F.lit("1998-01-01").cast("date")).otherwise(c("date")), "code": F.when(hot, "hot").otherwise(c("code")),
                                 "trade_id": F.when(hot, F.lit(0).cast("bigint")).otherwise(c("trade_id"))})
    return L.rank_seats(seats, pieces=40).select("date", "code", "trade_id", "side", "seat_code", "rank")


@query("a15_seat_net", """SELECT seat_code, round(sum(buy) - sum(sell), 2) AS net, count(DISTINCT code) AS codes, count(*) AS "rows" FROM f_seats GROUP BY seat_code""")
def a15(t):
    return L.seat_net(t.seats)


@query("a15b_top_seats", """SELECT date, code, trade_id, side, seat_code, rank FROM (SELECT date, code, trade_id, side, seat_code, row_number() OVER (PARTITION BY date, code, trade_id, side
    ORDER BY CASE WHEN side = 'buy' THEN buy ELSE sell END DESC, seat_code) AS rank FROM f_seats) WHERE rank <= 5""")
def a15b(t):
    return L.top_seats(t.seats, 5).select("date", "code", "trade_id", "side", "seat_code", "rank")


@query("a15c_institutions", """SELECT date, code, round(sum(buy), 2) AS buy, round(sum(sell), 2) AS sell, round(sum(buy) - sum(sell), 2) AS net FROM f_seats
    WHERE seat_code IN ('1', '2', '3') GROUP BY date, code""")
def a15c(t):
    return L.institution_totals(t.seats, ["1", "2", "3"])


@query("s10_load_events", """SELECT date, code, trade_id, side, seat_code, buy + CASE WHEN code = 'Brand#2' THEN 1 ELSE 0 END AS buy FROM f_seats WHERE date >= DATE '1997-01-01'""")
def s10(t):
    from factorspark.sources.events import load_events
    incr = t.seats.filter(c("code") == "Brand#2").withColumn("buy", c("buy") + 1)
    return load_events("lhb_seat", [t.seats, incr], start="1997-01-01").select("date", "code", "trade_id", "side", "seat_code", "buy")


# ---- sectors -----------------------------------------------------------------------------------

cte("f_pan0", """SELECT industry, date, avg(ret) AS ret, sum(amount) AS amount, avg(turnover) AS turnover FROM (
    SELECT *, close / lag(close) OVER (PARTITION BY code ORDER BY date) - 1 AS ret, count(*) OVER (PARTITION BY code) AS n FROM f_members) WHERE n > 60 GROUP BY 1, 2""")
cte("f_pdays", "SELECT date, CAST(row_number() OVER (ORDER BY date) AS DOUBLE) AS i FROM (SELECT DISTINCT date FROM f_pan0)")
cte("f_panel", """SELECT g.industry, g.date, g.i, b.ret, b.amount, b.turnover, b.price, b.price IS NOT NULL AS active,
    sum(CAST(b.price IS NOT NULL AS INT)) OVER (PARTITION BY g.industry ORDER BY g.date ROWS UNBOUNDED PRECEDING) AS avail_days FROM (
    SELECT industry, date, i FROM (SELECT DISTINCT industry FROM f_pan0) AS x, f_pdays) AS g LEFT JOIN (
    SELECT *, exp(sum(ln(1 + coalesce(ret, 0))) OVER (PARTITION BY industry ORDER BY date ROWS UNBOUNDED PRECEDING)) * 100 AS price FROM f_pan0) AS b USING (industry, date)""")


@query("a12_industry_panel", f"""SELECT industry, date, {R('ret', 9)} AS ret, {R('amount', 3)} AS amount, {R('turnover', 6)} AS turnover, {R('price', 6)} AS price, active,
    CAST(avail_days AS BIGINT) AS avail_days FROM f_panel""")
def a12(t):
    return rounded(S.panel(t.members).select("industry", "date", "ret", "amount", "turnover", "price", "active", "avail_days"), ret=9, amount=3, turnover=6, price=6)


IW = "PARTITION BY industry ORDER BY date"


def mom_sql(n, span, skip):
    f = f"OVER ({IW} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    end = "price" if skip == 0 else f"lag(price, {skip}) OVER ({IW})"
    return (f"CASE WHEN count(price) {f} = {n} THEN (pow({end} / lag(price, {n}) OVER ({IW}), CAST(252 AS DOUBLE) / {span}) - 1) * pow(corr(ln(price), i) {f}, 2) END")


cte("f_sf1", f"""SELECT *, {mom_sql(20, 14, 6)} AS m20, {mom_sql(60, 60, 0)} AS m60, {mom_sql(120, 120, 0)} AS m120,
    {sql_roll('stddev_pop', 'ret', 20, 'industry')} * sqrt(CAST(252 AS DOUBLE)) AS vol20, {sql_roll('avg', 'turnover', 60, 'industry')} AS to_mean,
    amount / sum(amount) OVER (PARTITION BY date) AS share, price / lag(price, 5) OVER ({IW}) - 1 AS r5 FROM f_panel""")
cte("f_sf2", f"SELECT *, share / lag(share, 60) OVER ({IW}) - 1 AS share_chg, row_number() OVER ({IW}) AS rn FROM f_sf1")
cte("f_crowd", """SELECT a.industry, a.date, CAST(0.5 AS DOUBLE) * (CASE WHEN count(b.to_mean) = 756 AND a.to_mean IS NOT NULL THEN count(*) FILTER (WHERE b.to_mean <= a.to_mean) / CAST(756 AS DOUBLE) END)
    + CAST(0.5 AS DOUBLE) * (CASE WHEN count(b.share_chg) = 756 AND a.share_chg IS NOT NULL THEN count(*) FILTER (WHERE b.share_chg <= a.share_chg) / CAST(756 AS DOUBLE) END) AS crowd
    FROM f_sf2 AS a JOIN f_sf2 AS b ON a.industry = b.industry AND b.rn BETWEEN a.rn - 755 AND a.rn GROUP BY a.industry, a.date, a.to_mean, a.share_chg""")
cte("f_sf3", """SELECT s.industry, s.date, s.i, s.ret, p AS pooled, CASE WHEN p THEN (m20 + m60 + m120) / 3 END AS mom_raw, CASE WHEN p THEN vol20 END AS vol20,
    CASE WHEN p THEN k.crowd END AS crowd, CASE WHEN p THEN r5 END AS r5 FROM (SELECT *, avail_days >= 250 AS p FROM f_sf2) AS s JOIN f_crowd AS k USING (industry, date)""")
cte("f_sf4", f"""SELECT *, CASE WHEN mom_raw IS NOT NULL THEN CASE WHEN stddev_pop(mom_raw) OVER (PARTITION BY date) > 1e-12 THEN (mom_raw - avg(mom_raw) OVER (PARTITION BY date))
    / stddev_pop(mom_raw) OVER (PARTITION BY date) ELSE 0 END END AS mom_z, {sql_pct('vol20')} AS vol_pct, {sql_pct('crowd')} AS crowd_pct, {sql_pct('r5')} AS r5_pct,
    count(*) FILTER (WHERE pooled) OVER (PARTITION BY date) AS np FROM f_sf3""")
cte("f_sector", """SELECT *, CASE WHEN pooled THEN mom_z * vol_mult * crowd_mult + rev_bonus END AS score FROM (
    SELECT *, CASE WHEN vol_pct >= 0.70 THEN CAST(0.7 AS DOUBLE) ELSE 1.0 END AS vol_mult, CASE WHEN crowd_pct >= 0.80 THEN CAST(0.85 AS DOUBLE) ELSE 1.0 END AS crowd_mult,
    CASE WHEN r5_pct < greatest(0.10, 1 / CAST(nullif(np, 0) AS DOUBLE)) THEN CAST(0.15 AS DOUBLE) ELSE 0.0 END AS rev_bonus FROM f_sf4)""")
SEC = dict(mom_raw=6, mom_z=6, vol20=9, vol_pct=9, crowd=9, crowd_pct=9, r5=9, r5_pct=9, score=6)


@query("w23_sector_score", f"SELECT industry, date, pooled, rev_bonus, {', '.join(f'{R(k, n)} AS {k}' for k, n in SEC.items())} FROM f_sector")
def w23(t):
    return rounded(S.factors(S.panel(t.members)).select("industry", "date", "pooled", "rev_bonus", *SEC), **SEC)


def sector_table(t):
    """The factor table, written once where several branches of a query read it."""
    return materialize(S.factors(S.panel(t.members)), "sectors")


@query("w21_month_end", """SELECT date, coalesce(date_trunc('month', lead(date) OVER (ORDER BY date)) <> date_trunc('month', date), true) AS month_end FROM (SELECT DISTINCT date FROM f_bars)""")
def w21(t):
    return S.month_end(t.bars)


cte("f_mk", f"""SELECT *, CASE WHEN mk_pct > 0.90 THEN CAST(0.5 AS DOUBLE) WHEN mk_pct > 0.80 THEN CAST(0.7 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS mk_scale FROM (
    WITH v AS (SELECT series_id, date, row_number() OVER (PARTITION BY series_id ORDER BY date) AS rn, {sql_roll('stddev_pop', 'r', 60, 'series_id')} AS v FROM (
      SELECT series_id, date, coalesce(close / lag(close) OVER (PARTITION BY series_id ORDER BY date) - 1, 0) AS r FROM f_index))
    SELECT a.series_id, a.date, CASE WHEN count(b.v) = 193 THEN count(*) FILTER (WHERE b.v <= a.v + 1e-15) / CAST(193 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS mk_pct
    FROM v AS a JOIN v AS b ON a.series_id = b.series_id AND b.rn BETWEEN a.rn - 192 AND a.rn GROUP BY a.series_id, a.date)""")


@query("w24_market_cap_scale", f"SELECT series_id, date, {R('mk_pct', 9)} AS mk_pct, mk_scale FROM f_mk")
def w24(t):
    return rounded(S.market_cap_scale(t.index_series).select("series_id", "date", "mk_pct", "mk_scale"), mk_pct=9)


cte("f_ew", """SELECT date, ret, exp(sum(ln(1 + ret)) OVER (ORDER BY date ROWS UNBOUNDED PRECEDING)) AS nav FROM (
    SELECT date, sum(coalesce(ret, 0)) / count(*) AS ret FROM f_sector WHERE pooled GROUP BY date)""")


@query("a27_basket_nav", f"SELECT date, {R('ret', 9)} AS ret, {R('nav', 9)} AS nav FROM f_ew")
def a27(t):
    return rounded(S.basket_nav(S.factors(S.panel(t.members))).select("date", "ret", "nav"), ret=9, nav=9)


cte("f_allret", "SELECT date, close, close / lag(close) OVER (ORDER BY date) - 1 AS iret FROM f_index WHERE series_id = 'ALL'")


@query("w25_trailing_excess", f"""SELECT date, {R('p20', 9)} AS p20, {R('e', 9)} AS excess, {R('max(e) OVER (ORDER BY date ROWS BETWEEN 251 PRECEDING AND CURRENT ROW)', 9)} AS excess_max FROM (
    SELECT date, p20, p20 - i20 AS e FROM (SELECT date, count(*) OVER w AS n, CASE WHEN count(*) OVER w = 20 THEN exp(sum(ln(1 + ret)) OVER w) - 1 END AS p20,
    CASE WHEN count(*) OVER w = 20 THEN exp(sum(ln(1 + coalesce(iret, 0))) OVER w) - 1 END AS i20 FROM f_ew JOIN f_allret USING (date)
    WINDOW w AS (ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)))""")
def w25(t):
    ew = S.basket_nav(S.factors(S.panel(t.members)))
    idx = t.index_series.filter(c("series_id") == "ALL").withColumn("ret", W.ret(c("close"), 1, W.by("series_id")))
    return rounded(S.trailing_excess(ew, idx).select("date", "p20", "excess", "excess_max"), p20=9, excess=9, excess_max=9)


cte("f_rk", """SELECT industry, i, score, mom_z, row_number() OVER (PARTITION BY i ORDER BY score DESC, industry) AS rank FROM f_sector WHERE score IS NOT NULL""")


@query("w27_rank_snapshot", f"""SELECT n.industry, n.rank, {R('n.score', 6)} AS score, n.rank - coalesce(o.rank, n.rank) AS rank_chg FROM f_rk AS n
    LEFT JOIN f_rk AS o ON o.industry = n.industry AND o.i = n.i - 20 WHERE n.i = (SELECT i FROM f_pdays WHERE date = DATE '2001-06-29')""")
def w27(t):
    return rounded(S.rank_snapshot(sector_table(t), "2001-06-29").select("industry", "rank", "score", "rank_chg"), score=6)


cte("f_mend", "SELECT date FROM (SELECT date, lead(date) OVER (ORDER BY date) AS nx FROM f_pdays) WHERE nx IS NULL OR date_trunc('month', nx) <> date_trunc('month', date)")
cte("f_targets", """SELECT r.date, r.industry, r.rank, r.score, coalesce(m.mk_scale, 1) / count(*) OVER (PARTITION BY r.date) AS weight FROM (
    SELECT s.date, s.industry, s.score, row_number() OVER (PARTITION BY s.date ORDER BY s.score DESC, s.industry) AS rank FROM f_sector AS s SEMI JOIN f_mend USING (date)
    WHERE s.score IS NOT NULL) AS r LEFT JOIN (SELECT date, mk_scale FROM f_mk WHERE series_id = 'ALL') AS m USING (date) WHERE r.rank <= 4""")


def sector_targets(t, f=None):
    f = sector_table(t) if f is None else f
    return S.top_n_targets(f, S.market_cap_scale(t.index_series.filter(c("series_id") == "ALL")))


@query("e6_top_n_targets", f"SELECT date, industry, CAST(rank AS INTEGER) AS rank, {R('score', 6)} AS score, {R('weight', 9)} AS weight FROM f_targets")
def e6(t):
    return rounded(sector_targets(t), score=6, weight=9)


# ---- index timing ------------------------------------------------------------------------------

PARAMS = I.TimingParams(j_low=25.0, j_high=70.0, j_from=80.0, j_to=40.0, rsi_os=48.0, rsi_from=52.0, rsi_to=50.0, x_up=1.0, y_down=1.0, y_acc=True,
                        div_2of3=True, val_gate=True, ma250_gate=True)
SW = "PARTITION BY series_id ORDER BY date"


def sroll(fn, col, n):
    return sql_roll(fn, col, n, "series_id")


def sprior(fn, col, n):
    f = f"OVER ({SW} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    return f"CASE WHEN count({col}) {f} = {n} THEN {fn}({col}) {f} END"


WEEK = "CAST(isoyear(date) AS VARCHAR) || '-W' || lpad(CAST(week(date) AS VARCHAR), 2, '0')"
cte("f_wk0", f"""SELECT w.series_id, w.close, w.date, row_number() OVER (PARTITION BY w.series_id ORDER BY w.date) AS rn FROM (
    SELECT series_id, {WEEK} AS wk, arg_max(px, date) AS close, max(date) AS date, max(lastd) AS lastd FROM (SELECT *, max(date) OVER (PARTITION BY series_id) AS lastd FROM f_index) GROUP BY 1, 2) AS w
    LEFT JOIN (SELECT {WEEK} AS wk, max(date) AS pe FROM f_cal GROUP BY 1) AS e USING (wk) WHERE NOT coalesce(e.pe > w.lastd, false)""")
cte("f_wk1", f"""SELECT *, CASE WHEN rn = 1 THEN CAST(50 AS DOUBLE) ELSE coalesce((close - lo) / nullif(hi - lo, 0) * 100, 50) END AS rsv,
    CASE WHEN delta IS NOT NULL THEN greatest(delta, 0) END AS up, CASE WHEN delta IS NOT NULL THEN greatest(-delta, 0) END AS dn FROM (
    SELECT *, {sroll('min', 'close', 9)} AS lo, {sroll('max', 'close', 9)} AS hi, close - lag(close) OVER ({SW}) AS delta FROM f_wk0)""")
ewm_cte("f_wkk", "f_wk1", "series_id", "rsv", "1.0 / 3")
cte("f_wk2", "SELECT series_id, rn, y AS k FROM f_wkk")
ewm_cte("f_wkd", "f_wk2", "series_id", "k", "1.0 / 3")
ewm_cte("f_wkg", "f_wk1", "series_id", "up", "1.0 / 14")
ewm_cte("f_wkl", "f_wk1", "series_id", "dn", "1.0 / 14")
cte("f_week", """SELECT a.series_id, a.date, 3 * k.y - 2 * d.y AS wj, CASE WHEN a.rn < 15 OR (g.y = 0 AND l.y = 0) THEN CAST(50 AS DOUBLE) WHEN l.y = 0 THEN CAST(100 AS DOUBLE)
    ELSE 100 - 100 / (1 + g.y / l.y) END AS wrsi FROM f_wk1 AS a JOIN f_wkk AS k USING (series_id, rn) JOIN f_wkd AS d USING (series_id, rn)
    JOIN f_wkg AS g USING (series_id, rn) JOIN f_wkl AS l USING (series_id, rn)""")
cte("f_t0", f"""SELECT *, row_number() OVER ({SW}) AS rn, px - lag(px) OVER ({SW}) AS delta, {sroll('avg', 'px', 20)} AS ma20, {sroll('stddev_pop', 'px', 20)} AS std20,
    {sroll('avg', 'px', 200)} AS ma200, {sroll('avg', 'px', 250)} AS ma250, {sprior('min', 'px', 63)} AS lo63, {sprior('max', 'px', 63)} AS hi63, {sprior('max', 'px', 10)} AS hi10,
    ((close / px) / (lag(close / px, 252) OVER ({SW})) - 1) * 100 AS div_proxy, {sroll('avg', 'vol', 5)} AS vol5 FROM f_index""")
cte("f_t1", f"""SELECT t.*, ma20 + 2 * std20 AS upper, ma20 - 2 * std20 AS lower, (px / lo63 - 1) * 100 AS up63, (px / hi63 - 1) * 100 AS dn63, (px / hi10 - 1) * 100 AS dn10,
    CASE WHEN delta IS NOT NULL THEN greatest(delta, 0) END AS up, CASE WHEN delta IS NOT NULL THEN greatest(-delta, 0) END AS dn,
    last_value(w.wj IGNORE NULLS) OVER ({SW.replace('series_id', 't.series_id').replace('date', 't.date')} ROWS UNBOUNDED PRECEDING) AS wj,
    last_value(w.wrsi IGNORE NULLS) OVER ({SW.replace('series_id', 't.series_id').replace('date', 't.date')} ROWS UNBOUNDED PRECEDING) AS wrsi,
    last_value(y.y10 IGNORE NULLS) OVER ({SW.replace('series_id', 't.series_id').replace('date', 't.date')} ROWS UNBOUNDED PRECEDING) AS y10
    FROM f_t0 AS t LEFT JOIN f_week AS w ON w.series_id = t.series_id AND w.date = t.date LEFT JOIN f_yield AS y ON y.date = t.date""")
cte("f_t2", "SELECT *, div_proxy - y10 AS spread, round(div_proxy - y10, 9) AS sp FROM f_t1")
cte("f_t3", """SELECT a.series_id, a.rn, CASE WHEN a.sp IS NOT NULL AND count(b.sp) >= 604 THEN (count(*) FILTER (WHERE b.sp < a.sp) + (count(*) FILTER (WHERE b.sp = a.sp) + 1) / CAST(2 AS DOUBLE))
    / count(b.sp) END AS spread_pct FROM f_t2 AS a JOIN f_t2 AS b ON a.series_id = b.series_id AND b.rn BETWEEN a.rn - 755 AND a.rn GROUP BY a.series_id, a.rn, a.sp""")
for _n, _col, _a in (("f_ru", "up", "1.0 / 14"), ("f_rd", "dn", "1.0 / 14"), ("f_e1", "px", "2.0 / 13"), ("f_e2", "px", "2.0 / 27")):
    ewm_cte(_n, "f_t2", "series_id", _col, _a)
cte("f_dif", "SELECT series_id, rn, a.y - b.y AS dif FROM f_e1 AS a JOIN f_e2 AS b USING (series_id, rn)")
ewm_cte("f_dea", "f_dif", "series_id", "dif", "0.2")
cte("f_t4", """SELECT t.*, p.spread_pct, CASE WHEN d.y = 0 THEN CASE WHEN u.y > 0 THEN CAST(100 AS DOUBLE) END ELSE 100 - 100 / (1 + u.y / d.y) END AS rsi, 2 * (f.dif - e.y) AS macd_hist FROM f_t2 AS t
    JOIN f_t3 AS p USING (series_id, rn) JOIN f_ru AS u USING (series_id, rn) JOIN f_rd AS d USING (series_id, rn) JOIN f_dif AS f USING (series_id, rn) JOIN f_dea AS e USING (series_id, rn)""")
cte("f_timing", f"""SELECT *, {sprior('max', 'rsi', 10)} AS hi10rsi, {sprior('max', 'macd_hist', 10)} AS hi10macd, {sroll('max', 'wj', 10)} AS j10, {sroll('max', 'wrsi', 10)} AS r10 FROM f_t4""")
TIM = dict(upper=6, lower=6, ma200=6, ma250=6, up63=6, dn63=6, dn10=6, wj=5, wrsi=5, rsi=5, div_proxy=6, y10=6, spread=6, spread_pct=9, hi10rsi=5, macd_hist=6, hi10macd=6)


@query("w7_timing_indicators", f"SELECT series_id, date, lo63, hi63, hi10, {', '.join(f'{R(k, n)} AS {k}' for k, n in TIM.items())} FROM f_timing")
def w7(t):
    df = I.timing_indicators(t.index_series, t.calendar, t.yields)
    return rounded(df.select("series_id", "date", "lo63", "hi63", "hi10", *TIM), **TIM)


cte("f_flags", """SELECT *, j_cross OR rsi_cross OR diverg AS momentum_lost FROM (SELECT *, coalesce(spread_pct BETWEEN 0.5 AND 0.8, false) AS os_half,
    (CAST(coalesce(wj < 25, false) AS INT) + CAST(coalesce(px <= lower, false) AS INT) + CAST(coalesce(dn63 <= -1 AND dn10 <= dn63 * 0.6, false) AS INT)
      + CAST(coalesce(wrsi < 48, false) AS INT)) >= 2 AND coalesce(spread_pct >= 0.5, false) AND coalesce(px < ma250, false) AS oversold,
    coalesce(wj > 70 AND px >= upper AND up63 >= 1, false) AS overbought,
    (CAST(coalesce(px > hi10 AND rsi < hi10rsi, false) AS INT) + CAST(coalesce(px > hi10 AND macd_hist < hi10macd, false) AS INT)
      + CAST(coalesce(px > hi10 AND vol < vol5, false) AS INT)) >= 2 AS diverg,
    coalesce(j10 > 80 AND wj <= 40, false) AS j_cross, coalesce(r10 > 52 AND wrsi <= 50, false) AS rsi_cross FROM f_timing)""")
FLAGS = ["os_half", "oversold", "overbought", "diverg", "j_cross", "rsi_cross", "momentum_lost"]


def timing(t):
    return I.timing_flags(I.timing_indicators(t.index_series, t.calendar, t.yields, PARAMS), PARAMS)


@query("p19_timing_flags", f"SELECT series_id, date, {', '.join(FLAGS)} FROM f_flags")
def p19(t):
    return timing(t).select("series_id", "date", *FLAGS)


GAPS = ["band_gap", "dn63_gap", "band_up_gap", "up63_gap", "j_need_drop", "rsi_need_drop"]


@query("p20_trigger_gaps", f"""WITH l AS (SELECT * FROM f_timing AS x WHERE date = (SELECT max(date) FROM f_timing AS y WHERE y.series_id = x.series_id)),
    h AS (SELECT *, CAST(coalesce(wj < 25, false) AS INT) + CAST(coalesce(px <= lower, false) AS INT) + CAST(coalesce(dn63 <= -1, false) AS INT) + CAST(coalesce(wrsi < 48, false) AS INT) AS hits,
      greatest(hi63, px) AS hi63_next FROM l)
    SELECT series_id, date, hits, greatest(0, 2 - hits) AS need, hi63_next, {R('greatest(0, (px / lower - 1) * 100)', 6)} AS band_gap,
    {R('greatest(0, (1 - hi63_next * (1 - 1 / 100.0) / px) * 100)', 6)} AS dn63_gap, {R('greatest(0, (upper / px - 1) * 100)', 6)} AS band_up_gap,
    {R('greatest(0, (lo63 * (1 + 1 / 100.0) / px - 1) * 100)', 6)} AS up63_gap, {R('greatest(0, wj - 40)', 5)} AS j_need_drop, {R('greatest(0, wrsi - 50)', 5)} AS rsi_need_drop FROM h""")
def p20(t):
    df = I.trigger_gaps(I.timing_indicators(t.index_series, t.calendar, t.yields, PARAMS), PARAMS)
    return rounded(df.select("series_id", "date", "hits", "need", "hi63_next", *GAPS), **{g: 6 for g in GAPS[:4]}, j_need_drop=5, rsi_need_drop=5)
