"""Data-quality gates, audits and manifests. All are aggregations with map-side combine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factorspark.functions import columns as C
from factorspark.schema import BAR, OPTIONAL, PARTIAL_FLAG

c = F.col

# Coverage thresholds.
WARN, FAIL = 0.95, 0.80


def _rows(df: DataFrame, columns: Sequence[str], name: str = "rule", value: str = "n_bad") -> DataFrame:
    """One-row frame of counters to rows (name, value)."""
    pairs = F.array(*[F.struct(F.lit(x).alias(name), c(x).cast("bigint").alias(value)) for x in columns])
    return df.select(F.explode(pairs).alias("r")).select("r.*")


def coverage_by_market(got: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected, got and rate per market and over all (market ALL)."""
    e = expected.select("code").distinct().withColumn("market", C.market_of(c("code")))
    g = got.select("code").distinct().withColumn("hit", F.lit(1))
    j = e.join(g, "code", "left").select(F.explode(F.array("market", F.lit("ALL"))).alias("market"), "hit")
    return j.groupBy("market").agg(F.count("*").alias("expected"), F.count("hit").alias("got")).withColumn(
        "rate", c("got") / c("expected"))


def coverage(got: DataFrame, expected: DataFrame, warn: float = WARN, fail: float = FAIL) -> DataFrame:
    """One row: overall and worst rate and the level. An empty universe is red."""
    m = coverage_by_market(got, expected)
    one = m.agg(
        F.coalesce(F.max(F.when(c("market") == "ALL", c("expected"))), F.lit(0)).alias("expected"),
        F.coalesce(F.max(F.when(c("market") == "ALL", c("got"))), F.lit(0)).alias("got"),
        F.max(F.when(c("market") == "ALL", c("rate"))).alias("overall"),
        F.min(F.when(c("market") != "ALL", c("rate"))).alias("worst"))
    low = F.least("overall", "worst")
    return one.withColumn("level", F.when(c("expected") == 0, "red").when(low < fail, "red").when(low < warn, "yellow").otherwise("green"))


def missing_codes(got: DataFrame, expected: DataFrame, sample: int = 20) -> DataFrame:
    """First missing codes in order."""
    return expected.select("code").distinct().exceptAll(got.select("code").distinct().intersect(expected.select("code"))) \
        .orderBy("code").limit(sample)


def freshness(bars: DataFrame, required: DataFrame, last_closed: str) -> DataFrame:
    """Required codes that are absent or behind the last closed trading day."""
    last = bars.groupBy("code").agg(F.max("date").alias("last_date"))
    out = required.select("code").distinct().join(last, "code", "left")
    state = F.when(c("last_date").isNull(), "absent").when(c("last_date") < F.lit(last_closed).cast("date"), "behind").otherwise("ok")
    return out.withColumn("state", state)


def audit_bars(df: DataFrame, calendar: DataFrame) -> DataFrame:
    """Rule -> number of offending rows (off-calendar: dates inside the calendar range; rows without a key are missing
    keys, not duplicates; unknown columns are those of no contract table)."""
    per_key = df.groupBy("code", "date").agg(
        F.count("*").alias("n"), F.count_if(~F.coalesce(c("close") > 0, F.lit(False))).alias("bad_close"),
        F.count_if(~((c("low") <= F.least("open", "close")) & (F.greatest("open", "close") <= c("high")))).alias("bad_ohlc"))
    keyed = c("code").isNotNull() & c("date").isNotNull()
    counts = per_key.agg(F.coalesce(F.sum("bad_close"), F.lit(0)).alias("close_not_positive"), F.coalesce(F.sum(F.when(keyed, c("n") - 1)), F.lit(0)).alias("duplicate_key"),
                         F.coalesce(F.sum("bad_ohlc"), F.lit(0)).alias("ohlc_order"), F.coalesce(F.sum(F.when(~keyed, c("n"))), F.lit(0)).alias("missing_key"))
    span = calendar.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    off = df.select("date").distinct().join(F.broadcast(calendar.select("date")), "date", "left_anti")
    off = off.filter(c("date").between(span.select("lo").scalar(), span.select("hi").scalar())).agg(F.count("*")).scalar()
    known = {*BAR.fieldNames(), *OPTIONAL.fieldNames(), PARTIAL_FLAG}
    counts = counts.withColumns({"off_calendar": off, "unknown_columns": F.lit(len([x for x in df.columns if x not in known]))})
    return _rows(counts, ["close_not_positive", "duplicate_key", "ohlc_order", "missing_key", "off_calendar", "unknown_columns"])


def audit_events(df: DataFrame, keys: Sequence[str], allowed: Sequence[str]) -> DataFrame:
    """Rule -> count for an event table: duplicate and missing keys (rows without a key are no duplicates), unknown columns."""
    missing = F.lit(False)
    for k in keys:
        missing = missing | c(k).isNull()
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"))
    counts = per_key.agg(F.coalesce(F.sum(F.when(~missing, c("n") - 1)), F.lit(0)).alias("duplicate_key"),
                         F.coalesce(F.sum(F.when(missing, c("n"))), F.lit(0)).alias("missing_key"))
    counts = counts.withColumn("unknown_columns", F.lit(len([x for x in df.columns if x not in allowed])))
    return _rows(counts, ["duplicate_key", "missing_key", "unknown_columns"])


def audit_store(families: DataFrame, index_last: Column) -> DataFrame:
    """Rows, codes, duplicates and lag against the index per family of shards."""
    per_key = families.groupBy("family", "code", "date").agg(F.count("*").alias("n"))
    f = per_key.groupBy("family").agg(F.sum("n").alias("rows"), F.countDistinct("code").alias("codes"),
                                      F.sum(c("n") - 1).alias("duplicates"), F.max("date").alias("last_date"))
    f = f.withColumn("ahead", F.datediff("last_date", index_last))
    return f.withColumn("state", F.when(c("duplicates") > 0, "fail").when(c("ahead") > 0, "warn").when(c("ahead") < -4, "fail").otherwise("pass"))


def frame_quality(df: DataFrame, min_amount: float = 5e7, rows: int = 60, min_rows: int = 20) -> DataFrame:
    """Per code: turnover out of (0, 100), amount <= 0 and the mean amount of the last rows."""
    w = Window.partitionBy("code").orderBy(c("date").desc())
    d = df.withColumn("rn", F.row_number().over(w))
    recent = c("rn") <= rows
    return d.groupBy("code").agg(
        F.count_if(~((c("turnover") > 0) & (c("turnover") < 100))).alias("turnover_bad"),
        F.count_if(c("amount") <= 0).alias("amount_zero"),
        F.avg(F.when(recent, c("amount"))).alias("mean_amount"), F.count_if(recent).alias("n_recent"),
    ).withColumn("low_liquidity", (c("n_recent") >= min_rows) & (c("mean_amount") < min_amount))


def fingerprint(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Order-free content hash per key."""
    return df.groupBy(*keys).agg(F.bit_xor(F.xxhash64(*sorted(df.columns))).alias("fingerprint"), F.count("*").alias("rows"))


def stale_derived(daily: DataFrame, manifest: DataFrame) -> DataFrame:
    """Codes whose stored fingerprint is not that of today's daily bars."""
    now = fingerprint(daily, ["code"]).select("code", c("fingerprint").alias("fp"), c("rows").alias("n"))
    was = manifest.select("code", "fingerprint", "rows")
    same = F.coalesce((c("fp") == c("fingerprint")) & (c("n") == c("rows")), F.lit(False))
    return now.join(was, "code", "full_outer").select("code", (~same).alias("stale"))


def manifest(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, codes, first and last date and fingerprint per partition."""
    return df.groupBy(*keys).agg(
        F.count("*").alias("rows"), F.countDistinct("code").alias("codes"), F.min("date").alias("date_min"), F.max("date").alias("date_max"),
        F.bit_xor(F.xxhash64("code", "date", "open", "high", "low", "close", "volume", "amount")).alias("fingerprint"))


def prune_manifest(entries: DataFrame, partitions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop entries whose partition is gone."""
    return entries.join(partitions.select(*keys).distinct(), list(keys), "left_semi")


def validate_series(df: DataFrame, calendar: DataFrame, today: str, jump: float = 0.25, max_stale: int = 10) -> DataFrame:
    """Hard rules and jump warnings per series: (series_id, rule, n_bad)."""
    t = F.lit(today).cast("date")
    w = Window.partitionBy("series_id").orderBy("date", "close")
    d = df.join(F.broadcast(calendar.select("date", F.lit(True).alias("open_day"))), "date", "left")
    d = d.withColumns({"chg": F.abs(C.div(c("close"), F.lag("close").over(w)) - 1),
                       "dup": (F.lag("date").over(w) == c("date"))})
    recent = calendar.filter(c("date") <= t).agg(F.max("date")).scalar()
    g = d.groupBy("series_id").agg(
        F.count_if(~F.coalesce((c("close") > 0) & (c("px") > 0), F.lit(False))).alias("bad_close"),
        F.count_if("dup").alias("duplicate_date"), F.count_if(c("chg") > jump).alias("jump"),
        F.max("date").alias("last"), F.max_by(F.coalesce("open_day", F.lit(False)), "date").alias("last_open"))
    g = g.withColumns({"last_not_trading": (~c("last_open")).cast("int"), "last_in_future": (c("last") > t).cast("int"),
                       "stale": (F.datediff(recent, c("last")) > max_stale).cast("int")})
    rules = ["bad_close", "duplicate_date", "jump", "last_not_trading", "last_in_future", "stale"]
    pairs = F.array(*[F.struct(F.lit(x).alias("rule"), c(x).cast("bigint").alias("n_bad")) for x in rules])
    return g.select("series_id", F.explode(pairs).alias("r")).select("series_id", "r.*")


def validate_panel(members: DataFrame, expected: DataFrame, last_closed: str, min_history: int = 250, min_ratio: float = 0.8,
                   max_missing: int = 2) -> DataFrame:
    """One row: industries with enough history, missing members, members beyond the last closed day."""
    per = members.groupBy("industry", "code").agg(F.count("*").alias("n"), F.max("date").alias("last"))
    ind = expected.select("industry", "code").join(per, ["industry", "code"], "left")
    best = ind.groupBy("industry").agg(
        F.coalesce(F.max("n"), F.lit(0)).alias("best"), F.count_if(c("n").isNull()).alias("missing"),
        F.count_if(c("last") > F.lit(last_closed).cast("date")).alias("late"))
    one = best.agg(F.count_if(c("best") >= min_history).alias("ok_industries"), F.count("*").alias("industries"),
                   F.sum("missing").alias("missing"), F.sum("late").alias("late"))
    ratio = c("ok_industries") / c("industries")
    return one.withColumns({"ratio": ratio, "passed": (ratio >= min_ratio) & (c("missing") <= max_missing) & (c("late") == 0)})


def side_table_staleness(df: DataFrame, asof: str, banner: int = 7, warn: int = 10, fail: int = 20) -> DataFrame:
    one = df.agg(F.max("date").alias("last_date"))
    lag = F.datediff(F.lit(asof).cast("date"), c("last_date"))
    return one.withColumn("lag_days", lag).withColumn(
        "level", F.when(c("lag_days") > fail, "fail").when(c("lag_days") > warn, "warn").when(c("lag_days") > banner, "banner").otherwise("ok"))


def validate_increment(df: DataFrame, day: str) -> DataFrame:
    """Checks of one day's frame before it is written: (rule, n_bad)."""
    t = F.lit(day).cast("date")
    per_key = df.groupBy("code", "date").agg(F.count("*").alias("n"), F.count_if(~F.coalesce(c("close") > 0, F.lit(False))).alias("bad"))
    one = per_key.agg((F.count("*") == 0).cast("int").alias("empty_frame"), F.coalesce(F.sum("bad"), F.lit(0)).alias("close_not_positive"),
                      F.coalesce(F.sum(F.when(c("date") != t, c("n"))), F.lit(0)).alias("other_day"), F.coalesce(F.sum(c("n") - 1), F.lit(0)).alias("duplicate_key"))
    return _rows(one, ["empty_frame", "close_not_positive", "other_day", "duplicate_key"])
