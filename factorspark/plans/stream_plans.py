"""Streaming queries: each runs over all rows that are there and returns its output table."""

from __future__ import annotations

from pyspark.sql import functions as F

from factorspark.plans.data_plans import day
from factorspark.plans.registry import R, query, rounded
from factorspark.session import materialize
from factorspark.sources.tables import Tables
from factorspark.streaming import jobs as J

c = F.col


def ticks(t):
    schema = t.raw("events").schema
    s = J.file_stream(t.spark, t.sf_dir, schema, glob="events.parquet")
    return s.select(Tables.user_code().alias("code"), "ts", c("event_id").alias("seq"), "value")


def staged(t, df, path, cuts, arrived=lambda: None):
    """Write bars as files in date order, cut by cut, as they would arrive; ``arrived`` is called after each cut."""
    lo = None
    for hi in [*cuts, None]:
        part = df
        if lo is not None:
            part = part.filter(c("date") >= day(lo))
        if hi is not None:
            part = part.filter(c("date") < day(hi))
        part.repartitionByRange("date").write.mode("append").parquet(path)
        arrived()
        lo = hi


@query("x1_append_once", "SELECT code, date, close, volume FROM f_ubars")
def x1(t):
    src, sink, ck = J.work_paths(t.spark, "append-once")
    b = t.ubars.select("code", "date", "close", "volume")
    # New keys come late too: the first days of some codes after all the rest.
    late = (c("date") < day("2024-01-06")) & (F.crc32("code") % 4 == 0)
    staged(t, b.filter(~late), src, ["2024-01-11", "2024-01-21"])
    staged(t, b.filter(late), src, [])
    run = lambda: J.finish(J.append_once(J.file_stream(t.spark, src, b.schema, per_trigger=8), sink, ck))
    run()
    # Late copies with other values.
    staged(t, b.filter(c("date") < day("2024-01-21")).withColumn("close", c("close") + 1), src, [])
    run()
    return t.spark.read.parquet(sink).select(*b.columns)


SQL_BARS = """SELECT code, {start} AS date, first(value ORDER BY ts, event_id) AS open, max(value) AS high, min(value) AS low, last(value ORDER BY ts, event_id) AS close, count(*) AS volume,
    {amount} AS amount FROM (SELECT *, ['60','00','30','68','83'][CAST(user_id % 5 + 1 AS INT)] || CASE WHEN user_id < 10000 THEN lpad(CAST(user_id AS VARCHAR), 4, '0') ELSE CAST(user_id AS VARCHAR) END AS code
    FROM events) WHERE {start} < (SELECT max({start_of_last}) FROM events) GROUP BY 1, 2"""


@query("x2_closed_weeks", SQL_BARS.format(start="CAST(date_trunc('week', ts) AS DATE)", start_of_last="CAST(date_trunc('week', ts) AS DATE)", amount=R("sum(value)", 4)))
def x2(t):
    _, root, ck = J.work_paths(t.spark, "weeks")
    J.finish(J.emit_closed(ticks(t), root, ck, "week"))
    return rounded(J.read_emitted(t.spark, root).drop("revision"), amount=4)


@query("x2b_amended_weeks", f"""WITH t AS (SELECT *, event_id % 7 = 0 AS late, CAST(date_trunc('week', ts) AS DATE) AS date, ['60','00','30','68','83'][CAST(user_id % 5 + 1 AS INT)] ||
      CASE WHEN user_id < 10000 THEN lpad(CAST(user_id AS VARCHAR), 4, '0') ELSE CAST(user_id AS VARCHAR) END AS code FROM events),
    a AS (SELECT code, date, CAST(0 AS BIGINT) AS revision, first(value ORDER BY ts, event_id) AS open, last(value ORDER BY ts, event_id) AS close, count(*) AS volume, {R('sum(value)', 4)} AS amount
      FROM t WHERE NOT late AND date < (SELECT max(date) FROM t WHERE NOT late) GROUP BY code, date),
    b AS (SELECT code, date, CAST(1 AS BIGINT) AS revision, first(value ORDER BY ts, event_id) AS open, last(value ORDER BY ts, event_id) AS close, count(*) AS volume, {R('sum(value)', 4)} AS amount
      FROM t WHERE date < (SELECT max(date) FROM t WHERE NOT late) OR date < (SELECT max(date) FROM t) GROUP BY code, date
      HAVING bool_or(late) OR date >= (SELECT max(date) FROM t WHERE NOT late))
    SELECT * FROM a UNION ALL SELECT * FROM b""")
def x2b(t):
    """A seventh of the ticks comes when all weeks but the last are closed: their weeks are emitted again with all ticks."""
    src, root, ck = J.work_paths(t.spark, "amended")
    all_ticks = t.raw("events").select(Tables.user_code().alias("code"), "ts", c("event_id").alias("seq"), "value")
    for late in (False, True):
        all_ticks.filter((c("seq") % 7 == 0) == late).write.mode("append").parquet(src)
        J.finish(J.emit_closed(J.file_stream(t.spark, src, all_ticks.schema, per_trigger=1000), root, ck, "week"))
    out = J.read_emitted(t.spark, root).select("code", "date", "revision", "open", "close", "volume", "amount")
    return rounded(out, amount=4)


@query("x3_stream_daily_bars", SQL_BARS.format(start="CAST(ts AS DATE)", start_of_last="CAST(ts AS DATE)", amount=R("sum(value)", 4)))
def x3(t):
    _, sink, ck = J.work_paths(t.spark, "days")
    J.finish(J.partial_bars(ticks(t), sink, ck, "day"))
    return rounded(J.read_bars(t.spark, sink), amount=4)


@query("x4_limit_streak", "SELECT code, date, close, CAST(limit_up AS BIGINT) AS limit_up, limit_count, m3, m5, m10 FROM f_zt")
def x4(t):
    """The stream runs after each cut and takes it whole: the files of a cut have no order, the cuts have."""
    src, root, ck = J.work_paths(t.spark, "streak")
    b = materialize(t.ubars.select("code", "date", "close"), "bars")
    staged(t, b, src, ["2024-01-09", "2024-01-20"],
           lambda: J.finish(J.limit_streak(J.file_stream(t.spark, src, b.schema, per_trigger=None), root, ck)))
    return J.read_streaks(t.spark, root)


@query("x5_drop_ledger", """SELECT reason, count(*) AS n FROM (SELECT CASE WHEN k = '9' THEN 'other' WHEN k IN ('5', '3') THEN 'short_format' WHEN k = '8' THEN 'unknown_code' WHEN k = '7' OR close <= 0 OR open <= 0 THEN 'parse_error' END AS reason
    FROM f_q UNION ALL SELECT 'parse_error' FROM f_q WHERE k = '3' AND close <= 0) WHERE reason IS NOT NULL GROUP BY reason""")
def x5(t):
    src, sink, ck = J.work_paths(t.spark, "ledger")
    lines = t.quote_lines
    staged(t, lines, src, ["2024-01-16"])
    J.finish(J.drop_ledger(J.file_stream(t.spark, src, lines.schema), t.known_symbols, sink, ck))
    return J.read_ledger(t.spark, sink)


@query("x5b_unfinished_bars", """WITH d AS (SELECT code, date, close, CASE WHEN date < DATE '2024-01-20' THEN 'first run' WHEN date = DATE '2024-01-20' THEN 'after the close' ELSE 'day to come' END AS state FROM f_ubars)
    SELECT code, date, close, state, CASE WHEN state = 'after the close' THEN 'session open until 15:00' END AS was FROM d""")
def x5b(t):
    """Bars arrive in the middle of a session that would be over on a half day; they wait in the rejected table until a run after the close."""
    src, root, ck = J.work_paths(t.spark, "gate")
    b = t.ubars.select("code", "date", "close")
    calendar = t.ubars.select("date", (F.dayofmonth("date") % 2 == 1).alias("half_day")).distinct()
    staged(t, b, src, ["2024-01-20"])
    J.finish(J.gate_bars(J.file_stream(t.spark, src, b.schema, per_trigger=8), calendar, "2024-01-20 12:00", root, ck))
    for _ in range(2):  # the second call changes nothing
        J.accept_closed(t.spark, b.schema, calendar, "2024-01-20 15:00", root)
    bars = t.spark.read.schema("code string, date date, close double, batch string").parquet(f"{root}/bars")
    rejected = t.spark.read.schema("code string, date date, close double, reason string").parquet(f"{root}/rejected")
    state = F.when(c("batch").isNull(), c("reason")).when(c("batch").startswith("r"), "after the close").otherwise("first run")
    out = bars.join(rejected.select("code", "date", "reason", c("close").alias("waiting")), ["code", "date"], "full_outer")
    return out.select("code", "date", F.coalesce("close", "waiting").alias("close"), state.alias("state"), F.when(c("batch").isNotNull(), c("reason")).alias("was"))
