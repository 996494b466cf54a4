"""Queries over the data layer: codes, loading, calendar, periods, adjustment, joins and audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from factorspark.functions import columns as C
from factorspark.operators import bars as B
from factorspark.operators import calendar as cal
from factorspark.operators import joins as J
from factorspark.operators import quality as Q
from factorspark.plans.ctes import cte
from factorspark.plans.registry import R, query, rounded
from factorspark.sources.tables import brand_number

c = F.col


def day(s):
    return F.lit(s).cast("date")


# ---- codes -------------------------------------------------------------------------------------

MARKET_SQL = """CASE WHEN NOT regexp_matches(code, '^[0-9]+$') THEN 'other' WHEN substr(code, 1, 1) IN ('6', '9') THEN 'sh'
    WHEN substr(code, 1, 1) IN ('0', '2', '3') THEN 'sz' WHEN substr(code, 1, 1) IN ('4', '8') THEN 'bj' ELSE 'other' END"""
PREFIX_SQL = "CASE WHEN substr(code, 1, 1) IN ('6','9') THEN 'sh' WHEN substr(code, 1, 1) IN ('4','8') THEN 'bj' ELSE 'sz' END"
cte("f_codes", "SELECT DISTINCT code FROM f_ubars")
cte("f_forms", f"""SELECT code, unnest([{PREFIX_SQL} || '.' || code, CASE WHEN substr(code, 1, 1) IN ('6', '9') THEN '1.' ELSE '0.' END || code,
    upper({PREFIX_SQL}) || code, code, ' ' || code, 'h' || code, CAST(CAST(code AS BIGINT) AS VARCHAR)]) AS form FROM f_codes""")


def forms(t):
    code = c("code")
    u = t.ubars.select("code").distinct()
    pre = C.market_prefix(code)
    sec = F.when(F.substring(code, 1, 1).isin("6", "9"), F.lit("1.")).otherwise(F.lit("0."))
    return u.select("code", F.explode(F.array(
        F.concat(pre, F.lit("."), code), F.concat(sec, code), F.concat(F.upper(pre), code), code, F.concat(F.lit(" "), code),
        F.concat(F.lit("h"), code), code.cast("bigint").cast("string"))).alias("form"))


@query("p1_normalize_code", """SELECT form, CASE WHEN form LIKE 'h%' THEN upper(form) ELSE code END AS norm FROM f_forms""")
def p1(t):
    n = C.normalize_code(c("form"))
    return forms(t).select("form", n.alias("norm")).filter(C.normalize_code(c("norm")) == c("norm"))


@query("p2_secid_symbol", """SELECT code, s || code AS secid, CASE WHEN s = '1.' THEN 'sh' ELSE 'sz' END || code AS symbol FROM (
    SELECT code, CASE WHEN substr(code, 1, 1) IN ('6', '9') THEN '1.' ELSE '0.' END AS s FROM f_codes)""")
def p2(t):
    return t.ubars.select("code").distinct().select("code", C.code_to_secid(c("code")).alias("secid"), C.code_to_symbol(c("code")).alias("symbol"))


@query("p3_market", f"SELECT code, {MARKET_SQL} AS market, {PREFIX_SQL} AS prefix FROM f_codes UNION ALL SELECT DISTINCT code, 'other', 'sz' FROM f_bars")
def p3(t):
    codes = t.ubars.select("code").distinct().unionByName(t.bars.select("code").distinct())
    return codes.select("code", C.market_of(c("code")).alias("market"), C.market_prefix(c("code")).alias("prefix"))


LIMIT3_SQL = """CASE WHEN substr(code, 1, 3) IN ('688', '689', '300', '301', '302') THEN CAST(20 AS DOUBLE)
    WHEN substr(code, 1, 1) IN ('4', '8') THEN CAST(30 AS DOUBLE) ELSE CAST(10 AS DOUBLE) END"""


@query("p4_limit_rate", f"""SELECT code, CASE WHEN substr(code, 1, 2) IN ('30', '68') THEN CAST(0.2 AS DOUBLE) ELSE CAST(0.1 AS DOUBLE) END AS rate,
    {LIMIT3_SQL} AS threshold FROM f_codes""")
def p4(t):
    return t.ubars.select("code").distinct().select("code", C.limit_rate(c("code")).alias("rate"), C.limit_threshold(c("code")).alias("threshold"))


@query("p5_coerce", """SELECT code, date, open, high, low, CASE WHEN substr(code, 6) = '7' THEN NULL ELSE close END AS close,
    CASE WHEN substr(code, 6) = '3' THEN 0 ELSE volume END AS volume, amount FROM f_ubars""")
def p5(t):
    k = F.substring("code", 6, 10)
    messy = t.ubars.select(
        F.concat(F.lit("SH."), c("code")).alias("code"), c("date").cast("string").alias("date"), "open", "high", "low",
        F.when(k == "7", F.lit("n/a")).otherwise(c("close").cast("string")).alias("close"),
        F.when(k == "3", F.lit("-")).otherwise(c("volume").cast("string")).alias("volume"), c("amount").cast("string").alias("amount"))
    return B.coerce(messy, B.BAR)


# ---- units and adjustment ----------------------------------------------------------------------

@query("p6_reconcile_units", f"""SELECT code, date, open, high, low, close, CAST(round_even(a / close, 0) AS BIGINT) AS volume, {R('a', 4)} AS amount
    FROM (SELECT *, CASE WHEN n % 3 <> 0 THEN amount WHEN volume % 2 = 0 THEN close * volume * 100 ELSE close * volume * 100 END AS a FROM (
    SELECT *, CAST(regexp_extract(code, '(\\d+)', 1) AS INT) AS n FROM f_bars))""")
def p6(t):
    n = brand_number(c("code"))
    src = t.bars.withColumn("amount", F.when(n % 3 != 0, c("amount")).when(c("volume") % 2 == 0, F.lit(0.0)))
    return rounded(B.reconcile_units(src), amount=4)


@query("p7b_join_bases", f"""SELECT h.code, h.date, {R('h.close', 6)} AS close, r.volume, r.open AS raw_open, r.close AS raw_close FROM f_hfq AS h LEFT JOIN f_bars AS r USING (code, date)""")
def p7b(t):
    from factorspark.operators.stocks import join_bases
    return rounded(join_bases(t.bars_hfq, t.bars).select("code", "date", "close", "volume", "raw_open", "raw_close"), close=6)


@query("p7_attach_volume", f"""SELECT h.code, h.date, {R('h.close', 6)} AS close,
    CASE WHEN r.amount IS NULL THEN 0 ELSE r.volume END AS volume, coalesce(r.amount, 0) AS amount FROM f_hfq AS h LEFT JOIN (
    SELECT * FROM f_bars WHERE dayofmonth(date) <> 15) AS r USING (code, date)""")
def p7(t):
    raw = t.bars.filter(F.dayofmonth("date") != 15)
    return rounded(B.attach_volume(t.bars_hfq, raw).select("code", "date", "close", "volume", "amount"), close=6)


@query("p8_adjust_ratio", f"""WITH lastday AS (SELECT code, max(date) AS date FROM f_bars GROUP BY code),
    ratio AS (SELECT h.code, arg_max(h.close, h.date) / (SELECT arg_max(b.close, b.date) FROM f_bars AS b WHERE b.code = h.code) AS ratio FROM f_hfq AS h GROUP BY h.code)
    SELECT b.code, b.date, {R('b.close * CASE WHEN b.code = $$Brand#7$$ THEN 2 ELSE r.ratio END', 6)} AS close, {R('r.ratio', 9)} AS ratio
    FROM f_bars AS b JOIN lastday USING (code, date) JOIN ratio AS r USING (code)""")
def p8(t):
    ratio = B.adjust_ratio(t.bars_hfq, t.bars)
    days = B.last_row(t.bars, ["code"])
    fixed = days.filter(c("code") == "Brand#7").select("code", "date", *[(c(p) * 2).alias(p) for p in B.PRICES], "volume", "amount")
    out = B.frame_hfq(days, ratio, fixed).join(ratio, "code")
    return rounded(out.select("code", "date", "close", "ratio"), close=6, ratio=9)


@query("p9_repair_hfq", f"""WITH a AS (SELECT code, arg_max(close, date) AS anchor, max(date) AS date FROM f_hfq WHERE date < DATE '2001-06-01' GROUP BY code),
    k AS (SELECT a.code, a.anchor / (b.close * 0.9) AS k FROM a JOIN f_bars AS b USING (code, date))
    SELECT b.code, b.date, {R('b.open * 0.9 * k.k', 6)} AS open, {R('b.high * 0.9 * k.k', 6)} AS high, {R('b.low * 0.9 * k.k', 6)} AS low,
    {R('b.close * 0.9 * k.k', 6)} AS close, volume, amount FROM f_bars AS b JOIN k USING (code)""")
def p9(t):
    fwd = t.bars.select("code", "date", *[(c(p) * 0.9).alias(p) for p in B.PRICES])
    out = B.repair_hfq(fwd, t.bars_hfq.filter(c("date") < day("2001-06-01")), t.bars)
    return rounded(out, open=6, high=6, low=6, close=6)


@query("p10_dividends", f"""WITH s AS (SELECT code, arg_max(close, date) AS lastc, max(date) AS d FROM f_bars WHERE date < DATE '2001-09-01' GROUP BY code),
    q AS (SELECT code, lastc * CASE WHEN CAST(regexp_extract(code, '(\\d+)', 1) AS INT) % 5 = 0 THEN 0.98 ELSE 1.004 END AS pc, lastc FROM s)
    SELECT code, {R('pc', 6)} AS prev_close, lastc AS last_close, {R('abs(pc / lastc - 1)', 9)} AS gap FROM q WHERE abs(pc / lastc - 1) > 0.005""")
def p10(t):
    stored = t.bars.filter(c("date") < day("2001-09-01"))
    snap = B.last_row(stored, ["code"]).select("code", (c("close") * F.when(brand_number(c("code")) % 5 == 0, 0.98).otherwise(1.004)).alias("prev_close"))
    return rounded(B.detect_dividends(snap, stored), prev_close=6, gap=9)


@query("p11_overlap", f"""WITH o AS (SELECT code, max(date) AS d, arg_max(close, date) AS pc FROM f_bars WHERE date <= DATE '2000-06-05' GROUP BY code),
    n AS (SELECT code, date, close * CASE WHEN CAST(regexp_extract(code, '(\\d+)', 1) AS INT) % 4 = 0 THEN 0.85 ELSE 1 END AS close FROM f_bars
      WHERE date >= DATE '2000-06-05')
    SELECT o.code, CAST(date_diff('day', o.d, s.ns) AS INTEGER) AS gap_days, {R('abs(n.close / o.pc - 1)', 9)} AS scale,
    coalesce(abs(n.close / o.pc - 1) >= 0.005, false) AS rebased FROM o JOIN (SELECT code, min(date) AS ns FROM n GROUP BY code) AS s USING (code)
    LEFT JOIN n ON n.code = o.code AND n.date = o.d""")
def p11(t):
    k = F.when(brand_number(c("code")) % 4 == 0, 0.85).otherwise(1.0)
    new = t.bars.filter(c("date") >= day("2000-06-05")).withColumn("close", c("close") * k)
    return rounded(B.overlap_check(t.bars.filter(c("date") <= day("2000-06-05")), new), scale=9)


@query("p12_trading_days_only", "SELECT code, date, close FROM f_bars SEMI JOIN f_cal USING (date)")
def p12(t):
    return B.drop_phantom_days(t.bars, t.calendar).select("code", "date", "close")


@query("p13_unfinished_bar", """SELECT code, date, close FROM f_bars WHERE date <= (SELECT max(date) FROM f_cal WHERE date < DATE '2001-10-24')""")
def p13(t):
    return B.drop_unfinished(t.bars, cal.closed_cutoff(t.calendar, "2001-10-24 14:20")).select("code", "date", "close")


@query("p13b_half_day", """SELECT code, date, close FROM f_bars WHERE date <= (SELECT max(date) FROM f_cal WHERE date <= DATE '2001-10-24')""")
def p13b(t):
    return B.drop_unfinished(t.bars, cal.closed_cutoff(t.calendar, "2001-10-24 14:20", half_days=("2001-10-24",))).select("code", "date", "close")


# Broken bars: wrong signs, wrong order and copies, at fixed days of the month.
cte("f_bad", """SELECT code, date, open, high, CASE WHEN n % 8 = 0 AND dom = 9 THEN high + 1 ELSE low END AS low,
    CASE WHEN n % 9 = 0 AND dom = 7 THEN -close ELSE close END AS close, volume, amount FROM (
    SELECT *, CAST(regexp_extract(code, '(\\d+)', 1) AS INT) AS n, dayofmonth(date) AS dom FROM f_bars) AS b,
    (SELECT unnest([1, 2]) AS copy) AS k WHERE copy = 1 OR (n % 10 = 0 AND dom = 11)""")


def broken(t):
    n, dom = brand_number(c("code")), F.dayofmonth("date")
    df = t.bars.withColumns({
        "copies": F.when((n % 10 == 0) & (dom == 11), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))),
        "low": F.when((n % 8 == 0) & (dom == 9), c("high") + 1).otherwise(c("low")),
        "close": F.when((n % 9 == 0) & (dom == 7), -c("close")).otherwise(c("close"))})
    return df.withColumn("copy", F.explode("copies")).drop("copies", "copy")


@query("p14_clean_series", """SELECT DISTINCT code, date, close FROM f_bad SEMI JOIN f_cal USING (date) WHERE close > 0""")
def p14(t):
    return B.clean_series(broken(t), t.calendar).select("code", "date", "close")


# ---- loading -----------------------------------------------------------------------------------

cte("f_loaded", """SELECT code, date, open, high, low, CASE WHEN fixed THEN close * 2 WHEN date >= DATE '2024-01-22' THEN close + 1 ELSE close END AS close,
    volume, amount FROM (SELECT *, substr(code, 1, 2) = '83' AND substr(code, 6) IN ('4', '9') AS fixed FROM f_ubars) WHERE NOT fixed OR date < DATE '2024-01-15'""")


def shards(t):
    """Sealed shards in one code style, increments that overlap them in another, and a repair table."""
    u = t.ubars
    pre = C.market_prefix(c("code"))
    sealed = u.filter(c("date") < day("2024-01-25")).withColumn("code", F.concat(pre, F.lit("."), c("code")))
    incr = u.filter(c("date") >= day("2024-01-22")).withColumns({"code": F.concat(F.lit("1."), c("code")), "close": c("close") + 1})
    fix = u.filter((F.substring("code", 1, 2) == "83") & F.substring("code", 6, 10).isin("4", "9") & (c("date") < day("2024-01-15"))).withColumn(
        "close", c("close") * 2)
    return sealed, incr, fix


@query("s1_load_bars", "SELECT code, date, open, high, low, close, volume, amount FROM f_loaded")
def s1(t):
    sealed, incr, fix = shards(t)
    return B.load_bars([sealed, incr], fix).select("code", "date", "open", "high", "low", "close", "volume", "amount")


@query("s4_overlay", """SELECT code, date, CASE WHEN substr(code, 1, 2) = '83' THEN close * 2 ELSE close END AS close FROM f_ubars
    WHERE substr(code, 1, 2) <> '83' OR date < DATE '2024-01-15'""")
def s4(t):
    fix = t.ubars.filter((F.substring("code", 1, 2) == "83") & (c("date") < day("2024-01-15"))).withColumn("close", c("close") * 2)
    return B.overlay(t.ubars, fix).select("code", "date", "close")


@query("s6_select_columns", "SELECT code, date, close, amount, CAST(NULL AS DOUBLE) AS turnover FROM f_bars")
def s6(t):
    return B.select_columns(t.bars, ["close", "amount", "turnover"])


@query("s7_filter_rows", """SELECT code, date, close FROM f_bars WHERE code IN ('Brand#1', 'Brand#2', 'Brand#3') AND date >= DATE '1999-01-01' AND date <= DATE '2000-12-31'
    AND date IN (SELECT DISTINCT date FROM f_bars WHERE code IN ('Brand#1', 'Brand#2', 'Brand#3') AND date <= DATE '2000-12-31' ORDER BY date DESC LIMIT 30)""")
def s7(t):
    return B.filter_rows(t.bars, ["Brand#1", "Brand#2", "Brand#3"], "1999-01-01", "2000-12-31", last_n=30).select("code", "date", "close")


@query("s11_keep_first", "SELECT code, date, close FROM f_ubars")
def s11(t):
    sealed, _, _ = shards(t)
    incr = t.ubars.filter(c("date") >= day("2024-01-22")).withColumn("close", c("close") + F.when(c("date") < day("2024-01-25"), 5.0).otherwise(0.0))
    return B.load_bars([sealed, incr], keep="first").select("code", "date", "close")


@query("s12_last_write_wins", """SELECT code, date, close + CASE WHEN date >= DATE '2024-01-20' THEN 3 WHEN date >= DATE '2024-01-10' THEN 2 ELSE 1 END AS close
    FROM f_ubars""")
def s12(t):
    parts = [t.ubars.withColumn("close", c("close") + 1), t.ubars.filter(c("date") >= day("2024-01-10")).withColumn("close", c("close") + 2),
             t.ubars.filter(c("date") >= day("2024-01-20")).withColumn("close", c("close") + 3)]
    return B.load_bars(parts).select("code", "date", "close")


@query("s32_query_bars", """SELECT code, date, close, (SELECT count(*) FROM f_bars WHERE code = 'Brand#12' AND date >= DATE '1999-01-01') AS total, true AS truncated
    FROM f_bars WHERE code = 'Brand#12' ORDER BY date DESC LIMIT 40""")
def s32(t):
    df = B.query_bars(t.bars, "Brand#12", start="1999-01-01").select("code", "date", "close")
    return B.bounded(df, 40, side="tail")


@query("s32b_query_events", """WITH e AS (SELECT * FROM f_seats WHERE date BETWEEN DATE '1996-01-01' AND DATE '1996-06-30' AND code IN ('Brand#1', 'Brand#4'))
    SELECT date, code, seat_code, trade_id, side, (SELECT count(*) FROM e) AS total, (SELECT count(*) > 50 FROM e) AS truncated FROM e
    ORDER BY date, code, trade_id, side, seat_code LIMIT 50""")
def s32b(t):
    df = B.query_events(t.seats, start="1996-01-01", end="1996-06-30", codes=["Brand#1", "Brand#4"], columns=["date", "code", "seat_code", "trade_id", "side"])
    return B.bounded(df, 50, tie=("code", "trade_id", "side", "seat_code"))


# ---- calendar and periods ----------------------------------------------------------------------

@query("w28_calendar_bounds", """WITH d AS (SELECT CAST(unnest(generate_series((SELECT min(date) FROM f_cal), (SELECT max(date) FROM f_cal), INTERVAL 1 DAY)) AS DATE) AS date)
    SELECT d.date, EXISTS (SELECT 1 FROM f_cal WHERE f_cal.date = d.date) AS is_trading_day,
    (SELECT max(k.date) FROM f_cal AS k WHERE k.date <= d.date) AS last_day, (SELECT min(k.date) FROM f_cal AS k WHERE k.date > d.date) AS next_day FROM d""")
def w28(t):
    return cal.day_bounds(all_days(t), t.calendar).select("date", "is_trading_day", "last_day", "next_day")


def all_days(t):
    return t.calendar.agg(F.explode(F.sequence(F.min("date"), F.max("date"))).alias("date"))


@query("w28b_calendar_shift", """SELECT d.date, (SELECT k.date FROM f_cal AS k WHERE k.td_idx = (SELECT max(x.td_idx) FROM f_cal AS x WHERE x.date <= d.date) - 5) AS back5,
    (SELECT k.date FROM f_cal AS k WHERE k.td_idx = (SELECT min(x.td_idx) FROM f_cal AS x WHERE x.date >= d.date) + 3) AS fwd3
    FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem) AS d""")
def w28b(t):
    d = t.raw("lineitem").select(c("l_shipdate").cast("date").alias("date")).distinct()
    out = cal.shift(d, t.calendar, -5, "back5")
    return cal.shift(out, t.calendar, 3, "fwd3").select("date", "back5", "fwd3")


@query("w28c_days_between", """SELECT a, b, (SELECT count(*) FROM f_cal WHERE date > a AND date <= b) AS n_days FROM (
    SELECT DISTINCT CAST(o_orderdate AS DATE) AS a, CAST(o_orderdate AS DATE) + 45 AS b FROM orders)""")
def w28c(t):
    pairs = t.raw("orders").select(c("o_orderdate").cast("date").alias("a")).distinct().withColumn("b", F.date_add("a", 45))
    return cal.trading_days_between(pairs, t.calendar).select("a", "b", c("n_days").cast("bigint").alias("n_days"))


@query("a5_data_lag", """SELECT code, date, lag_days, CASE WHEN lag_days > 3 THEN 'red' WHEN lag_days > 1 THEN 'yellow' ELSE 'ok' END AS level FROM (
    SELECT code, date, CASE WHEN date >= DATE '2001-10-29' THEN 0 ELSE
    greatest(0, (SELECT count(*) FROM f_cal AS k WHERE k.date >= l.date AND k.date < DATE '2001-10-29') - 1) END AS lag_days
    FROM (SELECT code, max(date) AS date FROM f_bars WHERE date < DATE '2001-10-27' GROUP BY code) AS l)""")
def a5(t):
    last = t.bars.filter(c("date") < day("2001-10-27")).groupBy("code").agg(F.max("date").alias("date"))
    return cal.data_lag(last, t.calendar, "2001-10-29").select("code", "date", "lag_days", "level")


@query("a5b_calendar_health", """SELECT min(date) AS min_date, max(date) AS max_date, count(*) AS n_days, CASE WHEN max(date) < DATE '2001-09-01' THEN 'error'
    WHEN max(date) < DATE '2001-11-30' THEN 'warning' ELSE 'ok' END AS level FROM f_cal""")
def a5b(t):
    return cal.health(t.calendar, "2001-09-01")


WEEK_SQL = "CAST(isoyear(date) AS VARCHAR) || '-W' || lpad(CAST(week(date) AS VARCHAR), 2, '0')"


def period_cte(name, key, asof):
    return f"""SELECT p.*, coalesce(e.pe > DATE '{asof}', false) AS is_partial FROM (
    SELECT code, {key} AS period_key, max(date) AS date, arg_min(open, date) AS open, max(high) AS high, min(low) AS low, arg_max(close, date) AS close,
    CAST(sum(volume) AS BIGINT) AS volume, sum(amount) AS amount FROM f_bars WHERE date <= DATE '{asof}' GROUP BY 1, 2) AS p
    LEFT JOIN (SELECT {key} AS period_key, max(date) AS pe FROM f_cal GROUP BY 1) AS e USING (period_key)"""


cte("f_weekly", period_cte("f_weekly", WEEK_SQL, "2001-10-24"))
cte("f_monthly", period_cte("f_monthly", "strftime(date, '%Y-%m')", "2001-10-24"))
PERIOD_COLS = ["code", "period_key", "date", "open", "high", "low", "close", "volume", "amount", "is_partial"]


def weekly(t, freq="weekly"):
    return B.aggregate_period(t.bars.filter(c("date") <= day("2001-10-24")), freq, t.calendar, asof="2001-10-24")


@query("a1_weekly_bars", f"SELECT code, period_key, date, open, high, low, close, volume, {R('amount', 3)} AS amount, is_partial FROM f_weekly")
def a1(t):
    return rounded(weekly(t).select(*PERIOD_COLS), amount=3)


@query("a1b_monthly_bars", f"SELECT code, period_key, date, open, high, low, close, volume, {R('amount', 3)} AS amount, is_partial FROM f_monthly")
def a1b(t):
    return rounded(weekly(t, "monthly").select(*PERIOD_COLS), amount=3)


@query("s5_load_derived", "SELECT code, period_key, close FROM f_weekly WHERE NOT is_partial")
def s5(t):
    return B.load_derived(weekly(t)).select("code", "period_key", "close")


# ---- joins, sets, sorts ------------------------------------------------------------------------

@query("j1_inner", "SELECT b.code, b.date, b.close, h.volume FROM f_bars AS b JOIN f_ubars_d AS h USING (date)".replace("f_ubars_d", "f_idx1"))
def j1(t):
    i = t.index_series.filter(c("series_id") == "ALL").select("date", c("vol").alias("volume"))
    return t.bars.select("code", "date", "close").join(i, "date").select("code", "date", "close", "volume")


cte("f_idx1", "SELECT date, vol AS volume FROM f_index WHERE series_id = 'ALL'")


@query("j2_left", "SELECT b.code, b.date, b.close, s.is_st FROM f_bars AS b LEFT JOIN f_st AS s USING (code, date)")
def j2(t):
    return t.bars.select("code", "date", "close").join(t.st_history.withColumn("is_st", c("is_st").cast("int")), ["code", "date"], "left")


@query("j3_anti", "SELECT code, date FROM f_bars ANTI JOIN f_st USING (code, date)")
def j3(t):
    return t.bars.select("code", "date").join(t.st_history, ["code", "date"], "left_anti")


@query("j4_semi", "SELECT code, date FROM f_bars SEMI JOIN f_st USING (code, date)")
def j4(t):
    return t.bars.select("code", "date").join(t.st_history, ["code", "date"], "left_semi")


@query("j5_dimension_map", "SELECT b.code, b.date, u.name, u.out_date FROM f_bars AS b LEFT JOIN f_uni AS u USING (code)")
def j5(t):
    return t.bars.select("code", "date").join(t.universe.select("code", "name", "out_date"), "code", "left")


@query("j6_asof_series", "SELECT b.code, b.date, y.y10 FROM f_bars AS b ASOF LEFT JOIN f_yield AS y ON b.date >= y.date")
def j6(t):
    return J.asof_by_date(t.bars.select("code", "date"), t.yields, ["y10"])


@query("j6b_asof_keyed", """SELECT b.code, b.date, s.net FROM f_bars AS b ASOF LEFT JOIN (SELECT code, date, round(sum(buy) - sum(sell), 2) AS net FROM f_seats
    WHERE month(date) % 5 = 0 GROUP BY code, date) AS s ON b.code = s.code AND b.date >= s.date""")
def j6b(t):
    net = t.seats.filter(F.month("date") % 5 == 0).groupBy("code", "date").agg(F.round(F.sum("buy") - F.sum("sell"), 2).alias("net"))
    return J.asof_join(t.bars.select("code", "date"), net, ["code"], ["net"])


@query("j7_reindex", """SELECT k.code, d.date, b.close FROM (SELECT DISTINCT code FROM f_bars) AS k, (SELECT DISTINCT date FROM f_bars) AS d
    LEFT JOIN f_bars AS b ON b.code = k.code AND b.date = d.date""")
def j7(t):
    return J.reindex(t.bars.select("code", "date", "close"), t.bars, ["code"])


@query("j8_previous_day", """SELECT b.code, b.date, b.close, p.close AS prev_close FROM f_bars AS b JOIN f_cal AS k USING (date)
    LEFT JOIN (SELECT b2.code, b2.close, k2.td_idx FROM f_bars AS b2 JOIN f_cal AS k2 USING (date)) AS p ON p.code = b.code AND p.td_idx = k.td_idx - 1""")
def j8(t):
    return J.previous_day(t.bars.select("code", "date", "close"), t.calendar, ["code"], ["close"]).select("code", "date", "close", "prev_close")


@query("u1_union_all", "SELECT code, date, close, CAST(NULL AS DOUBLE) AS turnover FROM f_bars UNION ALL SELECT code, date, close, turnover FROM f_members")
def u1(t):
    return t.bars.select("code", "date", "close").unionByName(t.members.select("code", "date", "close", "turnover"), allowMissingColumns=True)


@query("u2_intersect", "SELECT DISTINCT date FROM f_bars INTERSECT SELECT date FROM f_cal")
def u2(t):
    return t.bars.select("date").intersect(t.calendar.select("date"))


@query("u3_except", """SELECT code FROM (SELECT code FROM f_codes EXCEPT SELECT code FROM f_ubars WHERE date = DATE '2024-01-10') ORDER BY code LIMIT 20""")
def u3(t):
    return Q.missing_codes(t.ubars.filter(c("date") == day("2024-01-10")), t.ubars, 20)


@query("u4_distinct", "SELECT DISTINCT code, CAST(date_trunc('month', date) AS DATE) AS month FROM f_bars")
def u4(t):
    return t.bars.select("code", F.trunc("date", "month").alias("month")).distinct()


@query("t1_sort", "SELECT code, date, close FROM f_bars ORDER BY code, date")
def t1(t):
    return t.bars.select("code", "date", "close").orderBy("code", "date")


@query("t4_top_n", """SELECT date, code, seat_code, v, rank FROM (SELECT date, code, seat_code, buy + sell AS v,
    CAST(row_number() OVER (PARTITION BY date, code ORDER BY buy + sell DESC, seat_code, side, trade_id) AS INTEGER) AS rank FROM f_seats) WHERE rank <= 3""")
def t4(t):
    df = t.seats.withColumn("v", c("buy") + c("sell"))
    return B.top_n_per_group(df, ["date", "code"], [c("v").desc(), c("seat_code"), c("side"), c("trade_id")], 3).select("date", "code", "seat_code", "v", "rank")


@query("t5_head_tail", """SELECT * FROM (SELECT date, code, close, (SELECT count(*) FROM f_bars) AS total, true AS truncated, 'head' AS side FROM f_bars ORDER BY date, code LIMIT 25)
    UNION ALL SELECT * FROM (SELECT date, code, close, (SELECT count(*) FROM f_bars), true, 'tail' FROM f_bars ORDER BY date DESC, code LIMIT 25)""")
def t5(t):
    df = t.bars.select("date", "code", "close")
    head, tail = (B.bounded(df, 25, side=s, tie=("code",)).withColumn("side", F.lit(s)) for s in ("head", "tail"))
    return head.unionByName(tail)


@query("t6_best_per_key", """SELECT code, year, amount, date FROM (SELECT *, row_number() OVER (PARTITION BY code, year ORDER BY amount DESC, date DESC) AS rn FROM (
    SELECT code, CAST(date_trunc('year', date) AS DATE) AS year, amount, date FROM f_bars)) WHERE rn = 1""")
def t6(t):
    df = t.bars.select("code", F.trunc("date", "year").alias("year"), "amount", "date")
    return B.best_per_key(df, ["code", "year"], ["amount", "date"]).select("code", "year", "amount", "date")


# ---- gates and audits --------------------------------------------------------------------------

@query("a2_stale_derived", """SELECT DISTINCT code, CAST(regexp_extract(code, '(\\d+)', 1) AS INT) % 6 = 0 AS stale FROM f_bars""")
def a2(t):
    stored = Q.fingerprint(t.bars.withColumn("close", F.when(brand_number(c("code")) % 6 == 0, c("close") + 1).otherwise(c("close"))), ["code"])
    return Q.stale_derived(t.bars, stored)


COVER = f"""SELECT unnest([market, 'ALL']) AS market, hit FROM (SELECT code, {MARKET_SQL} AS market,
    EXISTS (SELECT 1 FROM f_ubars AS g WHERE g.code = e.code AND g.date = DATE '2024-01-10') AS hit FROM f_codes AS e)"""
cte("f_cover", f"SELECT market, count(*) AS expected, count(*) FILTER (WHERE hit) AS got, count(*) FILTER (WHERE hit) / count(*) AS rate FROM ({COVER}) GROUP BY market")


@query("a3_coverage_market", f"SELECT market, expected, got, {R('rate', 9)} AS rate FROM f_cover")
def a3m(t):
    return rounded(Q.coverage_by_market(t.ubars.filter(c("date") == day("2024-01-10")), t.ubars), rate=9)


@query("a3b_coverage_gate", f"""SELECT expected, got, {R('o', 9)} AS overall, {R('w', 9)} AS worst, CASE WHEN least(o, w) < 0.8 THEN 'red' WHEN least(o, w) < 0.95 THEN 'yellow'
    ELSE 'green' END AS level FROM (SELECT max(expected) FILTER (WHERE market = 'ALL') AS expected, max(got) FILTER (WHERE market = 'ALL') AS got,
    max(rate) FILTER (WHERE market = 'ALL') AS o, min(rate) FILTER (WHERE market <> 'ALL') AS w FROM f_cover)""")
def a3(t):
    return rounded(Q.coverage(t.ubars.filter(c("date") == day("2024-01-10")), t.ubars), overall=9, worst=9)


@query("a4_freshness", """SELECT code, last_date, CASE WHEN last_date IS NULL THEN 'absent' WHEN last_date < DATE '2001-10-31' THEN 'behind' ELSE 'ok' END AS state FROM (
    SELECT DISTINCT p_brand AS code FROM part) AS r LEFT JOIN (SELECT code, max(date) AS last_date FROM f_bars WHERE code <> 'Brand#3' GROUP BY code) USING (code)""")
def a4(t):
    need = t.raw("part").select(c("p_brand").alias("code"))
    return Q.freshness(t.bars.filter(c("code") != "Brand#3"), need, "2001-10-31")


@query("a6_audit_bars", """SELECT 'close_not_positive' AS rule, count(*) FILTER (WHERE NOT close > 0) AS n_bad FROM f_bad UNION ALL
    SELECT 'duplicate_key', count(*) - count(DISTINCT (code, date)) FROM f_bad UNION ALL
    SELECT 'ohlc_order', count(*) FILTER (WHERE NOT (low <= least(open, close) AND greatest(open, close) <= high)) FROM f_bad UNION ALL
    SELECT 'missing_key', count(*) FILTER (WHERE code IS NULL OR date IS NULL) FROM f_bad UNION ALL
    SELECT 'off_calendar', count(DISTINCT date) FROM f_bad ANTI JOIN f_cal USING (date) UNION ALL SELECT 'unknown_columns', 0""")
def a6(t):
    return Q.audit_bars(broken(t), t.calendar)


@query("a6b_audit_events", """WITH e AS (SELECT date, code, trade_id, side, CASE WHEN seat_code = '7' THEN NULL ELSE seat_code END AS seat_code FROM f_seats UNION ALL
    SELECT date, code, trade_id, side, seat_code FROM f_seats WHERE code = 'Brand#5' AND seat_code <> '7')
    SELECT 'duplicate_key' AS rule, CAST(sum(n - 1) AS BIGINT) AS n_bad FROM (SELECT count(*) AS n FROM e GROUP BY date, code, trade_id, side, seat_code) UNION ALL
    SELECT 'missing_key', count(*) FILTER (WHERE seat_code IS NULL) FROM e UNION ALL SELECT 'unknown_columns', 0""")
def a6b(t):
    from factorspark.schema import EVENTS
    keys, schema = EVENTS["lhb_seat"]
    e = t.seats.withColumn("seat_code", F.when(c("seat_code") != "7", c("seat_code")))
    e = e.unionByName(t.seats.filter((c("code") == "Brand#5") & (c("seat_code") != "7")))
    return Q.audit_events(e, keys, schema.fieldNames())


cte("f_fam", """SELECT 'raw' AS family, code, date FROM f_bad UNION ALL SELECT 'hfq', code, date FROM f_hfq UNION ALL
    SELECT 'old', code, date FROM f_bars WHERE date < DATE '2001-09-01'""")


@query("a7_audit_store", """SELECT family, "rows", codes, duplicates, last_date, ahead, CASE WHEN duplicates > 0 THEN 'fail' WHEN ahead > 0 THEN 'warn' WHEN ahead < -4 THEN 'fail'
    ELSE 'pass' END AS state FROM (SELECT family, count(*) AS "rows", count(DISTINCT code) AS codes, count(*) - count(DISTINCT (code, date)) AS duplicates,
    max(date) AS last_date, CAST(date_diff('day', (SELECT max(date) FROM f_index), max(date)) AS INTEGER) AS ahead FROM f_fam GROUP BY family)""")
def a7(t):
    fam = lambda df, n: df.select(F.lit(n).alias("family"), "code", "date")
    f = fam(broken(t), "raw").unionByName(fam(t.bars_hfq, "hfq")).unionByName(fam(t.bars.filter(c("date") < day("2001-09-01")), "old"))
    return Q.audit_store(f, t.index_series.agg(F.max("date")).scalar())


@query("a8_frame_quality", f"""SELECT code, count(*) FILTER (WHERE NOT (turnover > 0 AND turnover < 1)) AS turnover_bad, count(*) FILTER (WHERE amount <= 0) AS amount_zero,
    {R('avg(amount) FILTER (WHERE rn <= 60)', 3)} AS mean_amount, count(*) FILTER (WHERE rn <= 60) AS n_recent,
    count(*) FILTER (WHERE rn <= 60) >= 20 AND avg(amount) FILTER (WHERE rn <= 60) < 26000 AS low_liquidity FROM (
    SELECT code, turnover / 1 AS turnover, amount, row_number() OVER (PARTITION BY code ORDER BY date DESC) AS rn FROM f_members) GROUP BY code""")
def a8(t):
    df = t.members.withColumn("turnover", F.when(c("turnover") < 1, c("turnover")).otherwise(c("turnover") + 100))
    return rounded(Q.frame_quality(df, min_amount=26000.0), mean_amount=3)


@query("a9_manifest", """SELECT strftime(date, '%Y-%m') AS ym, count(*) AS "rows", count(DISTINCT code) AS codes, min(date) AS date_min, max(date) AS date_max FROM f_bars
    WHERE date < DATE '2000-01-01' GROUP BY 1""")
def a9(t):
    m = Q.manifest(t.bars.withColumn("ym", C.month_key(c("date"))), ["ym"])
    alive = t.bars.filter(c("date") < day("2000-01-01")).select(C.month_key(c("date")).alias("ym"))
    return Q.prune_manifest(m, alive, ["ym"]).drop("fingerprint")


@query("a10_validate_series", """WITH s AS (SELECT series_id, date, CASE WHEN dayofyear(date) = 100 THEN close * 1.4 ELSE close END AS close, px FROM f_index),
    g AS (SELECT s.*, abs(close / lag(close) OVER (PARTITION BY series_id ORDER BY date) - 1) AS chg FROM s),
    a AS (SELECT series_id, count(*) FILTER (WHERE NOT (close > 0 AND px > 0)) AS bad_close, 0 AS duplicate_date, count(*) FILTER (WHERE chg > 0.25) AS jump,
      CASE WHEN max(date) IN (SELECT date FROM f_cal) THEN 0 ELSE 1 END AS last_not_trading, CASE WHEN max(date) > DATE '2001-11-20' THEN 1 ELSE 0 END AS last_in_future,
      CASE WHEN date_diff('day', max(date), (SELECT max(date) FROM f_cal WHERE date <= DATE '2001-11-20')) > 10 THEN 1 ELSE 0 END AS stale FROM g GROUP BY series_id)
    SELECT series_id, 'bad_close' AS rule, CAST(bad_close AS BIGINT) AS n_bad FROM a UNION ALL SELECT series_id, 'duplicate_date', duplicate_date FROM a UNION ALL
    SELECT series_id, 'jump', jump FROM a UNION ALL SELECT series_id, 'last_not_trading', last_not_trading FROM a UNION ALL
    SELECT series_id, 'last_in_future', last_in_future FROM a UNION ALL SELECT series_id, 'stale', stale FROM a""")
def a10(t):
    s = t.index_series.withColumn("close", F.when(F.dayofyear("date") == 100, c("close") * 1.4).otherwise(c("close")))
    return Q.validate_series(s, t.calendar, "2001-11-20")


@query("a11_validate_panel", f"""WITH p AS (SELECT industry, code, count(*) AS n, max(date) AS lastd FROM f_members WHERE code NOT LIKE 'Brand#9/%' GROUP BY 1, 2),
    b AS (SELECT e.industry, coalesce(max(n), 0) AS best, count(*) FILTER (WHERE n IS NULL) AS missing, count(*) FILTER (WHERE lastd > DATE '2001-10-20') AS late
      FROM (SELECT DISTINCT p_type AS industry, p_brand || '/' || p_type AS code FROM part) AS e LEFT JOIN p USING (industry, code) GROUP BY 1),
    o AS (SELECT count(*) FILTER (WHERE best >= 250) AS ok_industries, count(*) AS industries, CAST(sum(missing) AS BIGINT) AS missing, CAST(sum(late) AS BIGINT) AS late FROM b)
    SELECT ok_industries, industries, missing, late, {R('ok_industries / industries', 9)} AS ratio,
    ok_industries / industries >= 0.8 AND missing <= 2 AND late = 0 AS passed FROM o""")
def a11(t):
    expected = t.raw("part").select(c("p_type").alias("industry"), F.concat("p_brand", F.lit("/"), "p_type").alias("code")).distinct()
    return rounded(Q.validate_panel(t.members.filter(~c("code").startswith("Brand#9/")), expected, "2001-10-20"), ratio=9)


@query("a28_side_table_staleness", """SELECT last_date, CAST(lag_days AS INTEGER) AS lag_days, CASE WHEN lag_days > 20 THEN 'fail' WHEN lag_days > 10 THEN 'warn' WHEN lag_days > 7 THEN 'banner'
    ELSE 'ok' END AS level FROM (SELECT max(date) AS last_date, date_diff('day', max(date), DATE '2001-11-15') AS lag_days FROM f_st)""")
def a28(t):
    return Q.side_table_staleness(t.st_history, "2001-11-15")


@query("a6c_validate_increment", """WITH d AS (SELECT * FROM f_bad WHERE date IN (DATE '2001-05-11', DATE '2001-05-07', DATE '2001-05-09'))
    SELECT 'empty_frame' AS rule, CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS n_bad FROM d UNION ALL SELECT 'close_not_positive', count(*) FILTER (WHERE NOT close > 0) FROM d UNION ALL
    SELECT 'other_day', count(*) FILTER (WHERE date <> DATE '2001-05-11') FROM d UNION ALL SELECT 'duplicate_key', count(*) - count(DISTINCT (code, date)) FROM d""")
def a6c(t):
    d = broken(t).filter(c("date").isin(*[F.lit(x).cast("date") for x in ("2001-05-11", "2001-05-07", "2001-05-09")]))
    return Q.validate_increment(d, "2001-05-11")
