"""Vendor texts, arrays, JSON and CSV files to contract frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factorspark.functions import columns as C
from factorspark.operators import bars as B

c = F.col


def num(x: Column) -> Column:
    """Text to double; anything else than a finite number is null."""
    d = x.cast("string").try_cast("double")
    return F.when(~F.isnan(d), d)


def whole(x: Column) -> Column:
    """Text to whole number, cut towards zero; missing or bad gives 0."""
    d = num(x)
    return F.coalesce(F.when(d >= 0, F.floor(d)).otherwise(F.ceil(d)), F.lit(0)).cast("bigint")


# ---- price pairs and calendars -----------------------------------------------------------------

TR_SCHEMA = "date date, close double, trading_vol double"
PX_SCHEMA = "date date, close double"


def join_price_pair(tr: DataFrame, px: DataFrame, keys: Sequence[str] = (), end: str | None = None) -> DataFrame:
    """Total-return close with its volume, and price close, on the dates both series have."""
    k = list(keys)
    vol = c("trading_vol") if "trading_vol" in tr.columns else F.lit(None).cast("double")
    out = tr.select(*k, "date", "close", vol.alias("vol")).join(px.select(*k, "date", c("close").alias("px")), [*k, "date"])
    return out if end is None else out.filter(c("date") <= F.lit(end).cast("date"))


def read_price_pair(spark: SparkSession, tr_path: str, px_path: str, end: str | None = None) -> DataFrame:
    tr = spark.read.schema(TR_SCHEMA).option("header", True).csv(tr_path)
    px = spark.read.schema(PX_SCHEMA).option("header", True).csv(px_path)
    return join_price_pair(tr, px, end=end)


# Accepted header names of a calendar file and the texts that mean "closed".
CALENDAR_ALIASES = {
    "date": ("date", "trade_date", "day", "日期"),
    "flag": ("is_trading_day", "is_trading", "trading", "isopen", "交易日"),
    "name": ("holiday_name", "name", "holiday", "名称"),
    "half": ("half_day", "halfday", "半天"),
}
CLOSED = ("0", "false", "no", "n", "f", "")


def parse_calendar(df: DataFrame) -> DataFrame:
    """Rows of a calendar file to (date, is_trading_day, half_day, holiday_name). Files list either trading
    days only or all days with a flag."""
    head = {x.strip().lower(): x for x in df.columns}

    def pick(what: str) -> Column | None:
        for a in CALENDAR_ALIASES[what]:
            if a in head:
                return c(f"`{head[a]}`").cast("string")
        return None
    date = pick("date")
    if date is None:
        raise ValueError(f"no date column among {df.columns}")
    flag, name, half = pick("flag"), pick("name"), pick("half")
    iso = F.regexp_replace(F.trim(date), r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")
    is_open = F.lit(True) if flag is None else ~F.lower(F.trim(F.coalesce(flag, F.lit("")))).isin(*CLOSED)
    is_half = F.lit(False) if half is None else F.coalesce(F.trim(half).isin("1", "true", "True"), F.lit(False))
    out = df.select(iso.try_cast("date").alias("date"), is_open.alias("is_trading_day"), is_half.alias("half_day"),
                    (F.lit(None).cast("string") if name is None else F.nullif(F.trim(name), F.lit(""))).alias("holiday_name"))
    out = out.filter(c("date").isNotNull())
    return out.withColumns({"half_day": c("half_day") & c("is_trading_day"), "holiday_name": F.when(~c("is_trading_day"), c("holiday_name"))})


def read_calendar(spark: SparkSession, path: str) -> DataFrame:
    return parse_calendar(spark.read.option("header", True).csv(path))


# ---- archives ----------------------------------------------------------------------------------

def tag_archives(df: DataFrame, path: Column) -> DataFrame:
    """Kind (week = full, incr) and date of an archive from its file or folder name."""
    mark = F.regexp_extract(path, r"-(week|incr)-(\d{8})\.json", 0)
    return df.withColumns({"kind": F.regexp_extract(mark, r"-(week|incr)-", 1),
                           "archive_date": F.to_date(F.regexp_extract(mark, r"(\d{8})", 1), "yyyyMMdd")})


def read_archives(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Archived JSON rows (gzip too) with kind and date from their names."""
    return tag_archives(spark.read.schema(schema).json(path).withColumn("__f", F.input_file_name()), c("__f")).drop("__f")


def rebuild_archive(rows: DataFrame, key: str = "code", day: str = "tradeDate") -> DataFrame:
    """Rows of the newest full archive per code, overwritten by the later increments day by day."""
    full = rows.filter(c("kind") == "week").groupBy(key).agg(F.max("archive_date").alias("__base"))
    use = rows.join(full, key).filter(
        ((c("kind") == "week") & (c("archive_date") == c("__base"))) | ((c("kind") == "incr") & (c("archive_date") > c("__base")))).drop("__base")
    rest = [x for x in use.columns if x not in (key, day, "archive_date")]
    return B.keep_last(use, [key, day], ["archive_date", *rest]).drop("kind", "archive_date")


# ---- arrays, index rows, k-line strings --------------------------------------------------------

def bars_from_arrays(df: DataFrame) -> DataFrame:
    """code, bars ARRAY<ARRAY<STRING>> as [date, open, close, high, low, volume]; short or bad bars and
    closes that are not positive are left out, the amount is unknown."""
    b = df.select("code", F.explode("bars").alias("b")).filter(F.size("b") >= 6)
    g = lambda i: F.get("b", F.lit(i))
    out = b.select("code", g(0).try_cast("date").alias("date"), num(g(1)).alias("open"), num(g(3)).alias("high"), num(g(4)).alias("low"),
                   num(g(2)).alias("close"), whole(g(5)).alias("volume"), F.lit(None).cast("double").alias("amount"))
    return out.filter((c("close") > 0) & c("open").isNotNull() & c("high").isNotNull() & c("low").isNotNull())


def bars_from_index_rows(df: DataFrame) -> DataFrame:
    """code, tradeDate, open, high, low, close, tradingVol, tradingValue as text. Missing prices take the
    close, high and low are widened to hold open and close, the value comes in 10^8."""
    d = df.select("code", c("tradeDate").try_cast("date").alias("date"), *[num(c(x)).alias(x) for x in ("open", "high", "low", "close")],
                  whole(c("tradingVol")).alias("volume"), (num(c("tradingValue")) * 1e8).alias("amount")).filter(c("close") > 0)
    d = d.withColumns({x: F.coalesce(x, "close") for x in ("open", "high", "low")})
    return d.withColumns({"high": F.greatest("high", "open", "close"), "low": F.least("low", "open", "close")})


def members_from_lines(df: DataFrame) -> DataFrame:
    """industry, code, line: comma-separated text with at least 11 fields to date, close, amount, turnover.
    One row per code and day."""
    p = F.split("line", ",")
    d = df.filter(F.size(p) >= 11).select(
        "industry", "code", F.get(p, F.lit(0)).try_cast("date").alias("date"), num(F.get(p, F.lit(2))).alias("close"),
        num(F.get(p, F.lit(6))).alias("amount"), num(F.get(p, F.lit(10))).alias("turnover"))
    return B.keep_first(d, ["industry", "code", "date"], ["close", "amount", "turnover"])


# ---- quote text --------------------------------------------------------------------------------

# Field numbers and minimum lengths of the quote text.
FULL_FIELDS, SHORT_FIELDS = 40, 5
F_PRICE, F_PREV, F_OPEN, F_VOLUME, F_HIGH, F_LOW, F_AMOUNT = 3, 4, 5, 6, 33, 34, 37


def parse_quotes(df: DataFrame, symbols: DataFrame) -> DataFrame:
    """Text rows (value, plus any other columns) to one row per quote line with a ``reason`` where the line
    is dropped. symbols: symbol, code. Degraded lines carry no range, volume or amount; they are kept with
    their price as range and flagged."""
    keep = [x for x in df.columns if x != "value"]
    lines = df.select(*keep, F.explode(F.split("value", ";")).alias("line")).withColumn("line", F.trim("line"))
    lines = lines.filter((c("line") != "") & F.contains("line", F.lit("=")))
    head = F.trim(F.substring_index("line", "=", 1))
    pattern = r"^v_(s_)?(sh|sz|bj)(\d{6,})$"
    lines = lines.withColumns({
        "symbol": F.concat(F.regexp_extract(head, pattern, 2), F.regexp_extract(head, pattern, 3)),
        "degraded": F.regexp_extract(head, pattern, 1) != "",
        "p": F.split(F.regexp_replace(F.trim(F.regexp_replace("line", r"^[^=]*=", "")), r'^"|"$', ""), "~")})
    # The symbol map is a dimension; Spark broadcasts it while it is below the session's size limit.
    d = lines.join(symbols, "symbol", "left")
    f = lambda i: F.get("p", F.lit(i))
    blank = lambda i: F.coalesce(f(i), F.lit("")) == ""
    price, prev, opn = num(f(F_PRICE)), num(f(F_PREV)), num(f(F_OPEN))
    vol = F.when(blank(F_VOLUME), F.lit(0.0)).otherwise(num(f(F_VOLUME)))
    amt = F.when(blank(F_AMOUNT), F.lit(0.0)).otherwise(num(f(F_AMOUNT)) * 1e4)
    full_bad = (price.isNull() | prev.isNull() | opn.isNull() | num(f(F_HIGH)).isNull() | num(f(F_LOW)).isNull() | vol.isNull() | amt.isNull()
                | (price <= 0) | (opn <= 0))
    s_prev = F.when(blank(F_PREV), F.lit(0.0)).otherwise(prev)
    s_open = F.when(blank(F_OPEN), price).otherwise(opn)
    short_bad = price.isNull() | s_prev.isNull() | s_open.isNull() | (price <= 0)
    reason = (
        F.when(c("symbol") == "", "other")
        .when(c("degraded") & c("code").isNull(), "unknown_code")
        .when(c("degraded") & (F.size("p") < SHORT_FIELDS), "other")
        .when(c("degraded") & short_bad, "parse_error")
        .when(c("degraded"), F.lit(None))
        .when(F.size("p") < FULL_FIELDS, "short_format")
        .when(c("code").isNull(), "unknown_code")
        .when(full_bad, "parse_error"))
    deg = c("degraded")
    return d.select(
        *keep, "symbol", "code", "degraded", reason.alias("reason"), F.when(deg, s_open).otherwise(opn).alias("open"), price.alias("close"),
        F.when(deg, price).otherwise(num(f(F_HIGH))).alias("high"), F.when(deg, price).otherwise(num(f(F_LOW))).alias("low"),
        F.when(deg, F.lit(0)).otherwise(whole(f(F_VOLUME))).cast("bigint").alias("volume"), F.when(deg, F.lit(0.0)).otherwise(amt).alias("amount"),
        F.when(deg, s_prev).otherwise(prev).alias("prev_close"))


def quote_rows(parsed: DataFrame) -> DataFrame:
    return parsed.filter(c("reason").isNull()).drop("reason", "symbol")


def drop_ledger(parsed: DataFrame) -> DataFrame:
    """Dropped lines by reason; degraded lines also count as short_format, which marks the throttling."""
    marks = F.array_compact(F.array(c("reason"), F.when(c("degraded"), F.lit("short_format"))))
    return parsed.select(F.explode(marks).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


# ---- JSON records ------------------------------------------------------------------------------

# Contract column -> vendor field and type.
DETAIL_FIELDS = {
    "date": ("TRADE_DATE", "date"), "code": ("SECURITY_CODE", "string"), "name": ("SECURITY_NAME_ABBR", "string"), "market": ("MARKET", "string"),
    "trade_id": ("TRADE_ID", "bigint"), "reason": ("EXPLANATION", "string"), "reason_tag": ("EXPLAIN", "string"),
    "change_type": ("CHANGE_TYPE", "string"), "close": ("CLOSE_PRICE", "double"), "change_rate": ("CHANGE_RATE", "double"),
    "turnover_rate": ("TURNOVERRATE", "double"), "free_market_cap": ("FREE_MARKET_CAP", "double"), "acc_amount": ("ACCUM_AMOUNT", "double"),
    "buy_amount": ("BILLBOARD_BUY_AMT", "double"), "sell_amount": ("BILLBOARD_SELL_AMT", "double"), "net_amount": ("BILLBOARD_NET_AMT", "double"),
}
SEAT_FIELDS = {
    "date": ("TRADE_DATE", "date"), "code": ("SECURITY_CODE", "string"), "trade_id": ("TRADE_ID", "bigint"), "side": ("_side", "string"),
    "seat_code": ("OPERATEDEPT_CODE", "string"), "seat_name": ("OPERATEDEPT_NAME", "string"), "buy": ("BUY", "double"), "sell": ("SELL", "double"),
    "net": ("NET", "double"),
}


def from_records(df: DataFrame, fields: dict[str, tuple[str, str]]) -> DataFrame:
    """JSON text (column value) to contract columns; a missing field is null, a missing code empty."""
    schema = T.StructType([T.StructField(v, T.StringType()) for v, _ in fields.values()])
    r = df.select(F.from_json("value", schema).alias("r"))
    out = []
    for name, (field, kind) in fields.items():
        x = c(f"r.`{field}`")
        if kind == "date":
            x = F.substring(x, 1, 10)
        if kind != "string":
            x = x.try_cast(kind)
        if name in ("code", "seat_code"):
            x = F.coalesce(x, F.lit(""))
        out.append(x.alias(name))
    return r.select(*out)


# The fields of a limit-up pool row.
POOL_FIELDS = (
    ("c", "string"), ("n", "string"), ("p", "double"), ("zdp", "double"), ("amount", "double"), ("ltsz", "double"), ("tshare", "double"),
    ("hs", "double"), ("fund", "double"), ("fbt", "bigint"), ("lbt", "bigint"), ("zbc", "bigint"), ("lbc", "bigint"),
    ("zttj", "struct<days: bigint, ct: bigint>"), ("hybk", "string"),
)


def pool_from_json(df: DataFrame) -> DataFrame:
    """(date, value): answer with data.pool array to limit-up pool rows; prices come in 1/1000."""
    row = ", ".join(f"{name}: {kind}" for name, kind in POOL_FIELDS)
    body = F.from_json("value", f"rc bigint, data struct<pool: array<struct<{row}>>>")
    r = df.select("date", body.alias("j")).filter(c("j.rc") == 0).select("date", F.explode("j.data.pool").alias("p"))
    return r.select(
        "date", F.coalesce("p.c", F.lit("")).alias("code"), c("p.n").alias("name"), F.when(c("p.p") != 0, c("p.p") / 1000.0).alias("price"),
        c("p.zdp").alias("change_rate"), "p.amount", c("p.ltsz").alias("free_market_cap"), c("p.tshare").alias("total_market_cap"),
        c("p.hs").alias("turnover_rate"), c("p.fund").alias("seal_amount"), c("p.fbt").alias("first_seal_time"), c("p.lbt").alias("last_seal_time"),
        c("p.zbc").alias("break_count"), c("p.lbc").alias("limit_board_count"), c("p.zttj.days").alias("zt_days"), c("p.zttj.ct").alias("zt_count"),
        c("p.hybk").alias("industry"))


# ---- special-treatment history and array stores ------------------------------------------------

def merge_st(history: DataFrame, increment: DataFrame) -> DataFrame:
    """History (is_st) and increment (isST) to one flag per (code, date); the increment wins."""
    h = history.select("code", "date", c("is_st").cast("int").alias("is_st"), F.lit(0).alias("__p"))
    i = increment.select("code", "date", c("isST").cast("int").alias("is_st"), F.lit(1).alias("__p"))
    u = h.unionByName(i).withColumn("code", C.normalize_code(c("code"))).filter(c("is_st").isNotNull())
    return B.keep_last(u, ["code", "date"], ["__p", "is_st"]).drop("__p").withColumn("is_st", c("is_st").cast("tinyint"))


def st_backfill_starts(bars: DataFrame, history: DataFrame) -> DataFrame:
    """Codes without any history, with their first bar as the day to fill from."""
    new = bars.groupBy("code").agg(F.min("date").alias("first_date"))
    return new.join(history.select("code").distinct(), "code", "left_anti")


def append_arrays(store: DataFrame, new: DataFrame) -> DataFrame:
    """Per-stock arrays (code, dates, closes) extended by later rows (code, date, close). Rows on or before
    the last stored date are ignored. Arrays hold one entry per trading day."""
    last = store.select("code", F.array_max("dates").alias("__last"))
    add = new.join(last, "code", "left").filter(c("__last").isNull() | (c("date") > c("__last"))).select("code", "date", "close")
    old = store.select("code", F.explode(F.arrays_zip("dates", "closes")).alias("z")).select("code", "z.dates", "z.closes").toDF("code", "date", "close")
    g = old.unionByName(add).groupBy("code").agg(F.array_sort(F.collect_list(F.struct("date", "close"))).alias("s"))
    return g.select("code", F.transform("s", lambda x: x["date"]).alias("dates"), F.transform("s", lambda x: x["close"]).alias("closes"))
