"""Queries over sources, sinks and streams. File-based ones write into the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from factorspark.functions import columns as C
from factorspark.operators import limits as L
from factorspark.plans.ctes import cte
from factorspark.plans.data_plans import PREFIX_SQL, day, shards
from factorspark.plans.registry import R, query, rounded
from factorspark.schema import BAR
from factorspark.session import materialize, shared_dir
from factorspark.sources import ingest as G
from factorspark.sources.store import (BarStore, EventStore, envelopes, export_layout, gap_backfill, load_meta, read_legacy, retention_plan, seed_meta,
                                       split_variants, trim_rolling, write_reports)
from factorspark.sources.tables import brand_number

c = F.col
BARS = "code, date, open, high, low, close, volume, amount"
COLS = BAR.fieldNames()


def brand_code(x):
    """Brand names as six-digit codes, so that they pass through the code normaliser as stocks."""
    return F.lpad((600000 + brand_number(x)).cast("string"), 6, "0")


BRAND_SQL = "CAST(600000 + CAST(regexp_extract(code, '(\\d+)', 1) AS INT) AS VARCHAR)"
cte("f_sbars", f"SELECT {BRAND_SQL} AS code, date, open, high, low, close, volume, amount FROM f_bars")


def sbars(t):
    return t.bars.withColumn("code", brand_code(c("code")))


# ---- store -------------------------------------------------------------------------------------

@query("s2_sealed_scan", f"SELECT {BARS} FROM f_sbars WHERE date >= DATE '1998-01-01' AND date <= DATE '1998-12-31'")
def s2(t):
    st = BarStore(t.spark, shared_dir(t.spark, "store"))
    st.write_sealed(sbars(t))
    return st.load(start="1998-01-01", end="1998-12-31").select(*COLS)


@query("s3_incremental_scan", f"SELECT {BARS} FROM f_ubars")
def s3(t):
    st = BarStore(t.spark, shared_dir(t.spark, "store"))
    st.append_days(t.ubars)
    return st.increments().select(*COLS)


@query("s1b_load_store", "SELECT code, date, open, high, low, close, volume, amount FROM f_loaded")
def s1b(t):
    st = BarStore(t.spark, shared_dir(t.spark, "store"))
    sealed, incr, fix = shards(t)
    st.write_sealed(sealed)
    st._with_month(incr.select(*COLS)).write.partitionBy("ym").parquet(st.incr_path)
    st._with_month(fix.select(*COLS)).write.partitionBy("ym").parquet(st.fixup_path)
    return st.load().select(*COLS)


@query("s2b_legacy_layout", """SELECT code, date, CASE WHEN date >= DATE '2024-01-21' THEN close + 2 WHEN date >= DATE '2024-01-16' THEN close + 1 ELSE close END AS close FROM f_ubars""")
def s2b(t):
    """The older layout: month folders, flat sealed files over them, increments by day over both."""
    root = shared_dir(t.spark, "legacy")
    b = materialize(t.ubars.select(*COLS), "bars")
    plus = lambda lo, k: b.filter(c("date") >= day(lo)).withColumn("close", c("close") + k)
    b.filter(c("date") < day("2024-01-16")).write.mode("append").parquet(root)
    plus("2024-01-11", 1).write.parquet(f"{root}/year=2024/month=01")
    plus("2024-01-21", 2).write.parquet(f"{root}/_incr/20240130")
    return read_legacy(t.spark, root).select("code", "date", "close")


@query("s3b_increment_order", """SELECT code, date, close - CASE CAST(code AS BIGINT) % 6 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 3 WHEN 4 THEN 4 ELSE 5 END AS close
    FROM f_ubars""")
def s3b(t):
    """One key in up to six places, with lower closes in the later ones: month folder, flat sealed file, three increment folders
    (one of whose names extends another) and a flat increment. The last place that holds a key counts, not the greatest row."""
    root = shared_dir(t.spark, "legacy")
    b = materialize(t.ubars.select(*COLS), "bars")
    kind = c("code").cast("long") % 6

    def at(k: int):
        return b.filter(kind >= k).withColumn("close", c("close") - k)
    # Written out of order: neither the time of writing nor the order of listing counts.
    at(4).write.parquet(f"{root}/_incr/20240111")
    at(3).write.parquet(f"{root}/_incr/20240110-b")
    at(2).write.parquet(f"{root}/_incr/20240110")
    at(1).write.mode("append").parquet(root)
    at(0).write.parquet(f"{root}/year=2024/month=01")
    at(5).write.mode("append").parquet(f"{root}/_incr")
    return read_legacy(t.spark, root).select("code", "date", "close")


@query("s5b_stored_weekly", "SELECT code, period_key, date, close FROM f_weekly WHERE NOT is_partial")
def s5b(t):
    st = BarStore(t.spark, shared_dir(t.spark, "store"), "index")
    st.write_sealed(t.bars.withColumn("code", brand_code(c("code"))))
    st.write_derived("weekly", t.calendar, "2001-10-24")
    names = t.bars.select(c("code").alias("name"), brand_code(c("code")).alias("code")).distinct()
    return st.load(freq="weekly").join(names, "code").select(c("name").alias("code"), "period_key", "date", "close")


@query("a9b_manifest_states", """SELECT 'sealed' AS kind, ym, CASE WHEN ym = '1999-03' THEN 'changed' WHEN ym = '1999-04' THEN 'gone' WHEN ym = '1999-05' THEN 'unlisted' ELSE 'ok' END AS state
    FROM (SELECT DISTINCT strftime(date, '%Y-%m') AS ym FROM f_sbars)""")
def a9b(t):
    """The writers' notes tell a month changed behind their back, one removed and one added."""
    st = BarStore(t.spark, shared_dir(t.spark, "store"))
    b = materialize(sbars(t).select(*COLS), "bars")
    st.write_sealed(b.filter(C.month_key(c("date")) != "1999-05"))
    behind = b.filter(C.month_key(c("date")).isin("1999-03", "1999-05")).withColumn("close", c("close") + 1)
    st._spread(st._with_month(behind)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("ym").parquet(st.sealed_path)
    st._clear(st.sealed_path, "1999-04")
    return st.verify()


@query("s27b_retention_applied", """WITH gone AS (SELECT DISTINCT strftime(date, '%Y-%m') AS ym FROM f_sbars WHERE CAST(last_day(date) AS DATE) <
      (SELECT min(date) FROM (SELECT date FROM f_cal WHERE date <= DATE '2001-10-26' ORDER BY date DESC LIMIT 1251)))
    SELECT CASE WHEN strftime(date, '%Y-%m') IN (SELECT ym FROM gone) THEN 'archive' ELSE 'store' END AS place, strftime(date, '%Y-%m') AS ym, count(*) AS n FROM f_sbars GROUP BY 1, 2""")
def s27b(t):
    root = shared_dir(t.spark, "store")
    st = BarStore(t.spark, root, "stock")
    st.write_sealed(sbars(t).select(*COLS))
    st.expire(t.calendar, "2001-10-26", 1250, archive=f"{root}/archive", dry_run=False)
    left = st.manifest().select(F.lit("store").alias("place"), "ym", c("rows").alias("n"))
    kept = t.spark.read.parquet(f"{root}/archive/stock/raw").groupBy("ym").agg(F.count("*").alias("n"))
    return left.unionByName(kept.select(F.lit("archive").alias("place"), "ym", "n"))


@query("s8_read_month", f"SELECT {BARS} FROM f_sbars WHERE strftime(date, '%Y-%m') = '1999-03'")
def s8(t):
    st = BarStore(t.spark, shared_dir(t.spark, "store"))
    st.write_sealed(sbars(t).filter(c("date") < day("1999-03-16")))
    st.rebuild_months(sbars(t).filter(c("date").between(day("1999-03-10"), day("1999-04-15"))))
    return st.month("1999-03").select(*COLS)


@query("s9_load_meta", "SELECT code, name, status FROM f_uni")
def s9(t):
    root = shared_dir(t.spark, "meta")
    t.universe.select("code", "name", "status").write.option("header", True).csv(f"{root}/meta/universe.csv")
    return load_meta(t.spark, root, "universe")


@query("s23_append_day", f"SELECT {BARS} FROM f_ubars")
def s23(t):
    st = BarStore(t.spark, shared_dir(t.spark, "store"))
    b = materialize(t.ubars.select(*COLS), "bars")
    st.append_day(b, "2024-01-10")
    st.append_days(b)
    st.append_day(b, "2024-01-11")
    return st.load().select(*COLS)


@query("s23b_append_states", """SELECT date, count(*) AS n, CASE WHEN date < DATE '2024-01-11' THEN 'skipped' WHEN date < DATE '2024-01-21' THEN 'differs' ELSE 'written' END AS state
    FROM f_ubars GROUP BY date""")
def s23b(t):
    st = BarStore(t.spark, shared_dir(t.spark, "store"))
    b = materialize(t.ubars.select(*COLS), "bars")
    st.append_days(b.filter(c("date") < day("2024-01-21")))
    return st.append_days(b.withColumn("close", F.when(c("date") < day("2024-01-11"), c("close")).otherwise(c("close") + 1)))


@query("s24_event_upsert", """SELECT date, code, trade_id, side, seat_code, CASE WHEN code = 'Brand#2' AND date >= DATE '1997-01-01' THEN buy + 1 ELSE buy END AS buy, sell FROM f_seats""")
def s24(t):
    st = EventStore(t.spark, shared_dir(t.spark, "events"), "lhb_seat")
    s = materialize(t.seats, "seats")
    st.write_month(s)
    st.upsert(s.filter((c("code") == "Brand#2") & (c("date") >= day("1997-01-01"))).withColumn("buy", c("buy") + 1))
    return st.load().select("date", "code", "trade_id", "side", "seat_code", "buy", "sell")


@query("s24b_event_month", """SELECT date, code, trade_id, side, seat_code, CASE WHEN strftime(date, '%Y-%m') = '1997-03' THEN buy + 2 ELSE buy END AS buy, sell FROM f_seats
    WHERE strftime(date, '%Y-%m') <> '1997-03' OR code <> 'Brand#11'""")
def s24b(t):
    st = EventStore(t.spark, shared_dir(t.spark, "events"), "lhb_seat")
    s = materialize(t.seats, "seats")
    st.write_month(s)
    month = s.filter((C.month_key(c("date")) == "1997-03") & (c("code") != "Brand#11"))
    # The month comes anew without one code, with every key twice; the greater amount counts.
    st.write_month(month.withColumn("buy", c("buy") + 1).unionByName(month.withColumn("buy", c("buy") + 2)))
    return st.load().select("date", "code", "trade_id", "side", "seat_code", "buy", "sell")


@query("s25_seal_month", f"SELECT {BARS} FROM f_ubars")
def s25(t):
    st = BarStore(t.spark, shared_dir(t.spark, "store"))
    st.append_days(t.ubars)
    st.seal("2024-01", codes_per_file=50)
    return st.load().select(*COLS)


STEPS = """SELECT 'before' AS step, code, date, close FROM f_ubars WHERE date < DATE '2024-01-16' UNION ALL
    SELECT 'sealed', code, date, CASE WHEN date < DATE '2024-01-11' THEN close - 1 ELSE close END FROM f_ubars"""


@query("s25b_seal_overlap", STEPS)
def s25b(t):
    """Sealed rows are corrected by increments of lower prices: loading before and after the seal gives the corrections."""
    st = BarStore(t.spark, shared_dir(t.spark, "store"))
    b = materialize(t.ubars.select(*COLS), "bars")
    st.append_days(b.filter(c("date") < day("2024-01-16")))
    st.seal("2024-01", codes_per_file=50)
    before = materialize(st.load().select(F.lit("before").alias("step"), "code", "date", "close"), "step")
    lower = b.filter(c("date") < day("2024-01-11")).withColumn("close", c("close") - 1)
    st.append_days(lower.unionByName(b.filter(c("date") >= day("2024-01-16"))))
    loaded = materialize(st.load().select(F.lit("sealed").alias("step"), "code", "date", "close"), "step")
    st.seal("2024-01", codes_per_file=50)
    sealed = st.sealed().select(F.lit("sealed").alias("step"), "code", "date", "close")
    # Both readings of the second state must be one and the same, row by row.
    return before.unionByName(sealed.join(loaded, ["step", "code", "date", "close"], "left_semi"))


@query("s26_rebuild_months", """SELECT code, date, CASE WHEN code = '600003' AND date BETWEEN DATE '1999-03-10' AND DATE '1999-04-15' THEN close + 1 ELSE close END AS close FROM f_sbars""")
def s26(t):
    st = BarStore(t.spark, shared_dir(t.spark, "store"))
    b = materialize(sbars(t).select(*COLS), "bars")
    st.write_sealed(b)
    new = b.filter((c("code") == "600003") & c("date").between(day("1999-03-10"), day("1999-04-15")))
    st.rebuild_months(new.withColumns({"code": F.concat(F.lit("sh."), c("code")), "close": c("close") + 1}))
    return st.load().select("code", "date", "close")


@query("s26b_rebuild_over_increments", """SELECT code, date, CASE WHEN date < DATE '2024-01-06' THEN close + 2 WHEN date < DATE '2024-01-16' THEN close + 1 ELSE close END AS close FROM f_ubars""")
def s26b(t):
    """Sealed rows, increments over half of them and a rebuild over a third: each wins over those before."""
    st = BarStore(t.spark, shared_dir(t.spark, "store"))
    b = materialize(t.ubars.select(*COLS), "bars")
    st.write_sealed(b)
    st.append_days(b.filter(c("date") < day("2024-01-16")).withColumn("close", c("close") + 1))
    st.rebuild_months(b.filter(c("date") < day("2024-01-06")).withColumn("close", c("close") + 2))
    return st.load().select("code", "date", "close")


@query("s27_retention_plan", """SELECT ym, last_day FROM (SELECT DISTINCT strftime(date, '%Y-%m') AS ym, CAST(last_day(date) AS DATE) AS last_day FROM f_bars)
    WHERE last_day < (SELECT min(date) FROM (SELECT date FROM f_cal WHERE date <= DATE '2001-10-26' ORDER BY date DESC LIMIT 1251))""")
def s27(t):
    months = t.bars.select(C.month_key(c("date")).alias("ym")).distinct()
    return retention_plan(months, t.calendar, "2001-10-26", 1250)


@query("s28_trim_rolling", "SELECT code, date, close FROM f_bars WHERE date >= (SELECT min(date) FROM (SELECT DISTINCT date FROM f_index ORDER BY date DESC LIMIT 250))")
def s28(t):
    return trim_rolling(t.bars.select("code", "date", "close"), t.index_series, 250)


@query("s29_export_layout", f"""SELECT CASE WHEN substr(code, 1, 1) IN ('6', '9') THEN '1.' ELSE '0.' END || code AS code, date, open, high, low, close, volume, amount,
    CASE WHEN substr(code, 1, 1) IN ('6', '9') THEN 'b0' ELSE 'b1' END AS mkt FROM f_ubars""")
def s29(t):
    path = shared_dir(t.spark, "export")
    export_layout(t.ubars, "raw").write.partitionBy("mkt").parquet(path)
    return t.spark.read.parquet(path)


@query("s30_gap_backfill", "SELECT code, date, close FROM f_bars WHERE date < DATE '1999-01-01' AND NOT (date >= DATE '1998-03-01' OR code IN ('Brand#1', 'Brand#2'))")
def s30(t):
    stored = t.bars.filter((c("date") >= day("1998-03-01")) | c("code").isin("Brand#1", "Brand#2"))
    return gap_backfill(stored, t.bars, "1999-01-01").select("code", "date", "close")


@query("s30b_seed_meta", "SELECT code, name, ipo_date, out_date, status FROM f_uni")
def s30b(t):
    return seed_meta(t.universe, ["code", "name", "ipo_date", "out_date", "status"])


@query("s33_report_sink", """SELECT p_type AS domain, code AS variant, CAST(max(date) AS VARCHAR) AS data_date, '{"lines":' || count(*) || ',"days":' || count(DISTINCT date) || '}' AS payload, 0 AS n_warnings
    FROM f_lines GROUP BY p_type, code""")
def s33(t):
    g = t.lines.groupBy(c("p_type").alias("domain"), c("code").alias("variant")).agg(
        F.max("date").alias("data_date"), F.count("*").alias("lines"), F.countDistinct("date").alias("days"))
    env = envelopes(g.select("domain", "variant", "data_date", F.struct("lines", "days").alias("payload")), "2026-01-01T00:00:00")
    path = shared_dir(t.spark, "reports")
    write_reports(env.repartitionByRange("domain", "variant"), path)
    back = t.spark.read.schema("domain string, variant string, data_date string, payload string, warnings array<string>").json(path)
    return back.select("domain", "variant", "data_date", "payload", F.coalesce(F.size("warnings"), F.lit(0)).alias("n_warnings"))


@query("s33b_split_variants", """SELECT 'etf' AS domain, v.variant, d AS data_date, k AS n_sections FROM (SELECT code, max(date) AS d FROM f_bars GROUP BY code),
    (VALUES ('dividend', 2), ('sector', 1)) AS v(variant, k) WHERE code = 'Brand#1' OR v.variant <> 'sector'""")
def s33b(t):
    rep = t.bars.groupBy("code").agg(F.max("date").alias("data_date"))
    rep = rep.withColumn("sections", F.map_from_arrays(
        F.when(c("code") == "Brand#1", F.array(F.lit("snapshot"), F.lit("backtest"), F.lit("sector"))).otherwise(F.array(F.lit("snapshot"), F.lit("backtest"))),
        F.when(c("code") == "Brand#1", F.array(F.lit("1"), F.lit("2"), F.lit("3"))).otherwise(F.array(F.lit("1"), F.lit("2")))))
    out = split_variants(rep, "etf", {"dividend": ["snapshot", "backtest"], "sector": ["sector"], "hs300": ["hs300"]})
    return out.select("domain", "variant", "data_date", F.size("payload").alias("n_sections"))


# ---- ingest ------------------------------------------------------------------------------------

@query("s13_price_pair", f"SELECT date, {R('close', 9)} AS close, CAST(vol AS DOUBLE) AS vol, px FROM f_index WHERE series_id = 'ALL' AND isodow(date) <> 2 AND date <= DATE '2001-06-29'")
def s13(t):
    root = shared_dir(t.spark, "csv")
    s = t.index_series.filter(c("series_id") == "ALL")
    s.select("date", "close", c("vol").cast("double").alias("trading_vol")).write.option("header", True).csv(f"{root}/tr")
    s.filter(F.weekday("date") != 1).select("date", c("px").alias("close")).write.option("header", True).csv(f"{root}/px")
    return rounded(G.read_price_pair(t.spark, f"{root}/tr", f"{root}/px", end="2001-06-29"), close=9)


@query("s14_calendar_source", """SELECT d.date, k.date IS NOT NULL AS is_trading_day, k.date IS NOT NULL AND isodow(d.date) = 5 AS half_day, CASE WHEN k.date IS NULL THEN 'closed' END AS holiday_name
    FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem) AS d LEFT JOIN f_cal AS k USING (date)""")
def s14(t):
    path = shared_dir(t.spark, "calendar")
    d = t.raw("lineitem").select(c("l_shipdate").cast("date").alias("date")).distinct().join(t.calendar, "date", "left")
    rows = d.select(F.date_format("date", "yyyyMMdd").alias("日期"), F.when(c("td_idx").isNull(), "0").otherwise("1").alias("IsOpen"),
                    F.when(c("td_idx").isNull(), "closed").alias("name"), (F.weekday("date") == 4).cast("int").alias("half_day"))
    rows.write.option("header", True).csv(path)
    return G.read_calendar(t.spark, path)


@query("s15_archive_rebuild", """SELECT code, CAST(date AS VARCHAR) AS "tradeDate", close + CASE WHEN date >= DATE '2001-06-20' THEN 3 WHEN date >= DATE '2001-06-10' THEN 2 ELSE 1 END AS close FROM f_bars""")
def s15(t):
    root = shared_dir(t.spark, "archive")
    b = materialize(t.bars.select("code", "date", "close"), "bars")
    rows = lambda lo, hi, k: b.filter(c("date").between(day(lo), day(hi))).select("code", c("date").cast("string").alias("tradeDate"), (c("close") + k).alias("close"))
    for name, df in (("week-20010601", rows("1990-01-01", "2001-06-01", 9)), ("week-20010615", rows("1990-01-01", "2001-06-15", 1)), ("incr-20010612", rows("2001-06-05", "2001-06-12", 8)),
                     ("incr-20010620", rows("2001-06-10", "2001-06-20", 2)), ("incr-20010630", rows("2001-06-20", "2099-12-31", 3))):
        df.write.option("compression", "gzip").json(f"{root}/bars-{name}.json")
    return G.rebuild_archive(G.read_archives(t.spark, f"{root}/*", "code string, tradeDate string, close double"))


@query("s16_bars_from_arrays", """SELECT code, date, open, high, low, close, volume, CAST(NULL AS DOUBLE) AS amount FROM f_ubars WHERE substr(code, 6) <> '4' AND NOT (close <= 0)""")
def s16(t):
    s = lambda x: c(x).cast("string")
    bar = F.array(s("date"), s("open"), s("close"), s("high"), s("low"), s("volume"))
    bar = F.when(F.substring("code", 6, 10) == "4", F.slice(bar, 1, 5)).otherwise(bar)
    return G.bars_from_arrays(t.ubars.groupBy("code").agg(F.collect_list(bar).alias("bars")))


@query("s17_index_rows", """SELECT code, date, CASE WHEN k = '2' THEN close ELSE open END AS open, CASE WHEN k = '2' THEN close ELSE greatest(high - 1, open, close) END AS high, CASE WHEN k = '2' THEN close ELSE low END AS low,
    close, volume, CASE WHEN k = '3' THEN NULL ELSE volume * CAST(1e8 AS DOUBLE) END AS amount FROM (SELECT *, substr(code, 6) AS k FROM f_ubars)""")
def s17(t):
    k = F.substring("code", 6, 10)
    gone = lambda x: F.when(k == "2", F.lit("null")).otherwise(x.cast("string"))
    rows = t.ubars.select("code", c("date").cast("string").alias("tradeDate"), gone(c("open")).alias("open"), gone(c("high") - 1).alias("high"), gone(c("low")).alias("low"),
                          c("close").cast("string").alias("close"), c("volume").cast("string").alias("tradingVol"), F.when(k != "3", c("volume").cast("string")).alias("tradingValue"))
    return G.bars_from_index_rows(rows)


@query("s18_kline_lines", "SELECT industry, code, date, close, amount, turnover FROM f_members WHERE code NOT LIKE 'Brand#8/%'")
def s18(t):
    s = lambda x: c(x).cast("string")
    parts = [s("date"), s("open"), s("close"), s("high"), s("low"), s("volume"), s("amount"), F.lit("0"), F.lit("0"), F.lit("0")]
    line = F.when(c("code").startswith("Brand#8/"), F.concat_ws(",", *parts)).otherwise(F.concat_ws(",", *parts, s("turnover")))
    m = t.members.select("industry", "code", line.alias("line"))
    return G.members_from_lines(m.unionByName(m.filter(c("code").startswith("Brand#5/"))))


cte("f_q", f"""SELECT code, date, open, high, low, close, volume, amount, substr(code, length(code)) AS k, {PREFIX_SQL} AS mkt FROM f_ubars""")


@query("s19_quote_text", """SELECT code, date, k = '3' AS degraded, open, close, CASE WHEN k = '3' THEN close ELSE high END AS high, CASE WHEN k = '3' THEN close ELSE low END AS low,
    CASE WHEN k = '3' THEN 0 ELSE volume END AS volume, CASE WHEN k = '3' THEN CAST(0 AS DOUBLE) ELSE round(amount, 2) * 10000 END AS amount FROM f_q
    WHERE k NOT IN ('5', '7', '8', '9') AND close > 0 AND (open > 0 OR k = '3')""")
def s19(t):
    return G.quote_rows(G.parse_quotes(t.quote_lines, t.known_symbols)).select("code", "date", "degraded", "open", "close", "high", "low", "volume", "amount")


@query("s19b_drop_ledger", """SELECT reason, count(*) AS n FROM (SELECT CASE WHEN k = '9' THEN 'other' WHEN k IN ('5', '3') THEN 'short_format' WHEN k = '8' THEN 'unknown_code' WHEN k = '7' OR close <= 0 OR open <= 0 THEN 'parse_error' END AS reason
    FROM f_q UNION ALL SELECT 'parse_error' FROM f_q WHERE k = '3' AND close <= 0) WHERE reason IS NOT NULL GROUP BY reason""")
def s19b(t):
    return G.drop_ledger(G.parse_quotes(t.quote_lines, t.known_symbols))


@query("s20_seat_records", """SELECT date, code, trade_id, side, seat_code, 'seat ' || seat_code AS seat_name, buy, sell, CAST(NULL AS DOUBLE) AS net,
    row_number() OVER (PARTITION BY date, code, trade_id, side ORDER BY CASE WHEN side = 'buy' THEN buy ELSE sell END DESC, seat_code) AS rank FROM f_seats""")
def s20(t):
    rec = F.to_json(F.struct(F.concat(c("date").cast("string"), F.lit(" 00:00:00")).alias("TRADE_DATE"), c("code").alias("SECURITY_CODE"), c("trade_id").alias("TRADE_ID"),
                             c("side").alias("_side"), c("seat_code").alias("OPERATEDEPT_CODE"), F.concat(F.lit("seat "), "seat_code").alias("OPERATEDEPT_NAME"), c("buy").alias("BUY"), c("sell").alias("SELL")))
    return L.rank_seats(G.from_records(t.seats.select(rec.alias("value")), G.SEAT_FIELDS))


@query("s20b_detail_records", """SELECT date, code, CAST(sum(trade_id) AS BIGINT) AS trade_id, 'up' AS reason, round(sum(buy), 2) AS buy_amount FROM f_seats GROUP BY date, code""")
def s20b(t):
    g = t.seats.groupBy("date", "code").agg(F.sum("trade_id").alias("tid"), F.round(F.sum("buy"), 2).alias("b"))
    rec = F.to_json(F.struct(c("date").cast("string").alias("TRADE_DATE"), c("code").alias("SECURITY_CODE"), c("tid").alias("TRADE_ID"), F.lit("up").alias("EXPLANATION"), c("b").alias("BILLBOARD_BUY_AMT")))
    return G.from_records(g.select(rec.alias("value")), G.DETAIL_FIELDS).select("date", "code", "trade_id", "reason", "buy_amount")


@query("s21_pool_json", """SELECT date, code, CASE WHEN v <> 0 THEN v / CAST(1000 AS DOUBLE) END AS price, volume AS limit_board_count, CASE WHEN v % 2 = 0 THEN volume END AS zt_days FROM (
    SELECT *, CAST(round(close * 100) AS BIGINT) AS v FROM f_ubars)""")
def s21(t):
    v = F.round(c("close") * 100).cast("bigint")
    stat = F.when(v % 2 == 0, F.struct(c("volume").alias("days"), F.lit(1).alias("ct")))
    one = F.struct(c("code").alias("c"), v.alias("p"), c("volume").alias("lbc"), stat.alias("zttj"))
    body = F.to_json(F.struct(F.lit(0).alias("rc"), F.struct(F.array(one).alias("pool")).alias("data")))
    return G.pool_from_json(t.ubars.select("date", body.alias("value"))).select("date", "code", "price", "limit_board_count", "zt_days")


@query("s22_st_merge", """SELECT code, date, CASE WHEN date >= DATE '2000-01-01' AND dayofmonth(date) % 2 = 0 THEN 0 ELSE 1 END AS is_st FROM f_st""")
def s22(t):
    incr = t.st_history.filter((c("date") >= day("2000-01-01")) & (F.dayofmonth("date") % 2 == 0)).select("code", "date", F.lit(0).alias("isST"))
    return G.merge_st(t.st_history, incr).withColumn("is_st", c("is_st").cast("int"))


@query("s22b_st_backfill", "SELECT code, min(date) AS first_date FROM f_bars WHERE code NOT IN (SELECT code FROM f_st WHERE code <> 'Brand#4' AND code <> 'Brand#9') GROUP BY code")
def s22b(t):
    return G.st_backfill_starts(t.bars, t.st_history.filter(~c("code").isin("Brand#4", "Brand#9")))


@query("s31_append_arrays", "SELECT code, CAST(len(list(date)) AS INTEGER) AS n, max(date) AS last_date, arg_max(close, date) AS last_close, arg_min(close, date) AS first_close FROM f_bars GROUP BY code")
def s31(t):
    old = t.bars.filter(c("date") < day("2000-01-01")).groupBy("code").agg(F.array_sort(F.collect_list(F.struct("date", "close"))).alias("s")).select(
        "code", F.transform("s", lambda x: x["date"]).alias("dates"), F.transform("s", lambda x: x["close"]).alias("closes"))
    out = G.append_arrays(old, t.bars.filter(c("date") >= day("1999-06-01")).withColumn("close", F.when(c("date") < day("1999-12-31"), c("close") + 7).otherwise(c("close"))))
    return out.select("code", F.size("dates").alias("n"), F.element_at("dates", -1).alias("last_date"), F.element_at("closes", -1).alias("last_close"), F.get("closes", F.lit(0)).alias("first_close"))
