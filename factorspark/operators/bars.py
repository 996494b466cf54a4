"""Bar-level operators: last rows, dedupe, period aggregation and price adjustment."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factorspark.functions import columns as C
from factorspark.operators import calendar as cal
from factorspark.schema import BAR, BAR_KEY, OPTIONAL, PARTIAL_FLAG, PRICES, ContractError

c = F.col


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the one with the greatest order. An aggregation, not a window, so copies of
    one key combine before the shuffle however many there are."""
    rest = [x for x in df.columns if x not in keys]
    pick = F.max_by(F.struct(*rest), F.struct(*order)).alias("__r")
    return df.groupBy(*keys).agg(pick).select(*keys, "__r.*").select(*df.columns)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    rest = [x for x in df.columns if x not in keys]
    pick = F.min_by(F.struct(*rest), F.struct(*order)).alias("__r")
    return df.groupBy(*keys).agg(pick).select(*keys, "__r.*").select(*df.columns)


def last_row(df: DataFrame, keys: Sequence[str], before: str | None = None) -> DataFrame:
    """Latest row per key, optionally before a day."""
    if before is not None:
        df = df.filter(c("date") < F.lit(before).cast("date"))
    return keep_last(df, keys, ["date"])


def overlay(base: DataFrame, fix: DataFrame) -> DataFrame:
    """Replace all rows of every code that the repair table holds. Codes must be normalised before."""
    keep = base.join(fix.select("code").distinct(), "code", "left_anti")
    return keep.unionByName(fix.select(*base.columns))


def load_bars(parts: Sequence[DataFrame], fix: DataFrame | None = None, keep: str = "last", origin: str | None = None) -> DataFrame:
    """Union of shards in rising priority: normalise codes, then repair, then one row per key. Inside a shard the column
    ``origin``, if one is named, ranks the rows by where they were read from; it is dropped in the end."""
    frames = [p.withColumns({"code": C.normalize_code(c("code")), "__prio": F.lit(i)}) for i, p in enumerate(parts)]
    df = frames[0]
    for f in frames[1:]:
        df = df.unionByName(f, allowMissingColumns=True)
    if fix is not None:
        cols = [x for x in df.columns if x not in ("__prio", origin)]
        absent = {x: F.lit(None).cast(df.schema[x].dataType) for x in cols if x not in fix.columns}
        fixed = fix.withColumn("code", C.normalize_code(c("code"))).withColumns(absent).select(*cols).withColumn("__prio", F.lit(len(parts)))
        if origin is not None:
            fixed = fixed.withColumn(origin, F.lit(None).cast(df.schema[origin].dataType))
        df = overlay(df, fixed)
    pick = keep_last if keep == "last" else keep_first
    # Equal priorities are told apart by the row itself, so the pick does not depend on row order.
    above = ["__prio"] if origin is None else ["__prio", origin]
    rest = [x for x in df.columns if x not in ("code", "date", *above)]
    return pick(df, BAR_KEY, [*above, *rest]).drop(*above)


def select_columns(df: DataFrame, columns: Sequence[str] | None) -> DataFrame:
    """Key plus the asked columns; absent optional columns come as null, unknown ones are an error."""
    if not columns or list(columns) == ["*"]:
        return df
    valid = set(BAR.fieldNames()) | set(OPTIONAL.fieldNames()) | {PARTIAL_FLAG}
    unknown = [x for x in columns if x not in valid]
    if unknown:
        raise ContractError(f"unknown columns {unknown}")
    types = {f.name: f.dataType for f in [*BAR.fields, *OPTIONAL.fields]}
    wanted = [x for x in columns if x not in BAR_KEY]
    return df.select(*BAR_KEY, *[c(x) if x in df.columns else F.lit(None).cast(types.get(x, "boolean")).alias(x) for x in wanted])


def filter_rows(df: DataFrame, codes: Sequence[str] | None = None, start: str | None = None, end: str | None = None,
                last_n: int | None = None) -> DataFrame:
    """Codes, date range and the last n distinct dates of the whole frame."""
    if codes:
        df = df.filter(c("code").isin([short_code(x) for x in codes]))
    if start is not None:
        df = df.filter(c("date") >= F.lit(start).cast("date"))
    if end is not None:
        df = df.filter(c("date") <= F.lit(end).cast("date"))
    if last_n:
        days = df.select("date").distinct().orderBy(c("date").desc()).limit(last_n)
        df = df.join(F.broadcast(days), "date", "left_semi")
    return df


def short_code(text: str) -> str:
    """Driver-side twin of the code expression, for a handful of parameters."""
    s = text.strip()
    if not s:
        raise ContractError("empty code")
    if re.match(r"^[Hh]\d", s):
        return s.upper()
    m = re.match(r"^(?:(?:sh|sz|bj|0|1|2)\.|sh|sz|bj)?(\d+)$", s, re.I)
    return m.group(1).zfill(6) if m else s


def query_events(df: DataFrame, dates: Sequence[str] | None = None, start: str | None = None, end: str | None = None,
                 codes: Sequence[str] | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """Event rows by dates, range and codes; the date always stays among the columns."""
    if dates:
        df = df.filter(c("date").isin([F.lit(d).cast("date") for d in dates]))
    df = filter_rows(df, codes if "code" in df.columns else None, start, end)
    if columns:
        have = [x for x in columns if x in df.columns]
        df = df.select(*(["date"] if "date" not in have else []), *have)
    return df


def query_bars(df: DataFrame, code: str, start: str | None = None, end: str | None = None, last_n: int | None = None) -> DataFrame:
    """Bars of one code; last_n counts this code's rows."""
    df = filter_rows(df, [code], start, end)
    if last_n:
        df = df.orderBy(c("date").desc()).limit(last_n)
    return df


def bounded(df: DataFrame, max_rows: int, order: str = "date", side: str = "head", tie: Sequence[str] = ()) -> DataFrame:
    """First or last max_rows rows with the total count and a truncation flag."""
    total = df.agg(F.count("*")).scalar()
    key = [c(order).asc() if side == "head" else c(order).desc(), *[c(x) for x in tie]]
    return df.orderBy(*key).limit(max_rows).withColumns({"total": total, "truncated": total > max_rows})


def aggregate_period(df: DataFrame, freq: str, calendar: DataFrame, asof: str | None = None,
                     how: dict[str, str] | None = None, warmup_days: int | None = None) -> DataFrame:
    """Weekly (ISO) or monthly bars per code with the partial flag of the trading calendar.

    A period is partial while the calendar shows one of its days after ``asof`` (default: the last date
    of the frame). Sums stay null where all inputs are null.
    """
    cols = [x for x in df.columns if x not in BAR_KEY]
    if "close" not in cols:
        raise ContractError("close is missing")
    rule = {**{x: "last" for x in cols}, **{x: DEFAULT_AGG[x] for x in cols if x in DEFAULT_AGG}, **(how or {})}
    if warmup_days is not None:
        need = {"weekly": 5, "monthly": 21}[freq] + warmup_days
        have = df.select("date").distinct().count()
        if have < need:
            raise ContractError(f"{freq} needs {need} trading days, got {have}")
    fn = {"first": lambda x: F.min_by(x, "date"), "last": lambda x: F.max_by(x, "date"), "max": F.max, "min": F.min, "sum": F.sum}
    out = df.withColumn("period_key", cal.period_key(c("date"), freq)).groupBy("code", "period_key").agg(
        F.max("date").alias("date"), *[fn[rule[x]](x).alias(x) for x in cols])
    day = F.lit(asof).cast("date") if asof is not None else df.agg(F.max("date")).scalar()
    ends = F.broadcast(cal.period_ends(calendar, freq))
    flag = F.coalesce(c("period_end") > day, F.lit(False))
    return out.join(ends, "period_key", "left").withColumn(PARTIAL_FLAG, flag).drop("period_end")


# How each column of a bar is aggregated.
DEFAULT_AGG = {"open": "first", "high": "max", "low": "min", "close": "last", "volume": "sum", "amount": "sum"}


def load_derived(df: DataFrame, closed_only: bool = True) -> DataFrame:
    """Derived bars, by default without unfinished periods; the flag must be there."""
    if PARTIAL_FLAG not in df.columns:
        raise ContractError("derived bars carry no partial flag")
    return df.filter(~c(PARTIAL_FLAG)) if closed_only else df


def coerce(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast to a contract schema: bad integers become 0, bad floats null, text stays text."""
    out = []
    for f in schema.fields:
        x = c(f.name) if f.name in df.columns else F.lit(None).cast("string")
        if f.name == "code":
            out.append(C.normalize_code(x).alias(f.name))
        elif isinstance(f.dataType, T.LongType):
            n = F.coalesce(x.cast("string").try_cast("bigint"), F.floor(x.cast("string").try_cast("double")), F.lit(0))
            out.append(n.cast("bigint").alias(f.name))
        elif isinstance(f.dataType, T.DoubleType):
            d = x.cast("string").try_cast("double")
            out.append(F.when(~F.isnan(d), d).alias(f.name))
        else:
            out.append(x.try_cast(f.dataType.simpleString()).alias(f.name))
    return df.select(*out)


def reconcile_units(df: DataFrame) -> DataFrame:
    """Amount from the source or close·volume·100 where it is missing; volume in shares from both."""
    amount = F.when(c("amount") > 0, c("amount")).otherwise(c("close") * c("volume") * 100.0)
    safe = F.when(c("close") > 0, c("close"))
    shares = F.when(safe.isNotNull(), F.rint(C.div(amount, safe))).otherwise(c("volume") * 100)
    return df.select("code", "date", *PRICES, F.coalesce(shares, F.lit(0)).cast("bigint").alias("volume"), amount.alias("amount"))


def attach_volume(hfq: DataFrame, raw: DataFrame) -> DataFrame:
    """Traded volume and amount of the raw bars on back-adjusted prices; rows without a partner get zero."""
    r = raw.select("code", "date", "volume", "amount")
    out = hfq.select("code", "date", *PRICES).join(r, ["code", "date"], "left")
    return out.withColumns({
        "amount": F.coalesce(c("amount"), c("close") * F.coalesce(c("volume"), F.lit(0)) * 100.0),
        "volume": F.when(c("amount").isNull(), F.lit(0)).otherwise(F.coalesce(c("volume"), F.lit(0))).cast("bigint")})


def adjust_ratio(hfq: DataFrame, raw: DataFrame) -> DataFrame:
    """Back-adjustment ratio per code from the latest rows of both bases."""
    h = last_row(hfq.select("code", "date", "close"), ["code"]).select("code", c("close").alias("h"))
    r = last_row(raw.select("code", "date", "close"), ["code"]).select("code", c("close").alias("r"))
    return h.join(r, "code").select("code", C.div(c("h"), c("r")).alias("ratio"))


def frame_hfq(raw_day: DataFrame, ratio: DataFrame, repaired: DataFrame | None = None) -> DataFrame:
    """Day rows on the back-adjusted base; codes with a repaired series take its last row."""
    out = raw_day.join(ratio, "code", "left")
    k = F.coalesce(c("ratio"), F.lit(1.0))
    out = out.select("code", "date", *[(c(p) * k).alias(p) for p in PRICES], "volume", "amount")
    return out if repaired is None else overlay(out, last_row(repaired, ["code"]))


def repair_hfq(forward: DataFrame, stored: DataFrame, raw: DataFrame) -> DataFrame:
    """Forward-adjusted history scaled so that it meets the last stored back-adjusted close."""
    anchor = last_row(stored.select("code", "date", c("close").alias("anchor")), ["code"])
    same = forward.select("code", "date", c("close").alias("q"))
    k = anchor.join(same, ["code", "date"]).select("code", C.div(c("anchor"), c("q")).alias("k")).filter(c("k").isNotNull())
    out = forward.join(k, "code").select("code", "date", *[(c(p) * c("k")).alias(p) for p in PRICES])
    vol = raw.select("code", "date", "volume", "amount")
    return out.join(vol, ["code", "date"], "left").withColumns(
        {"volume": F.coalesce("volume", F.lit(0)), "amount": F.coalesce("amount", F.lit(0.0))})


def detect_dividends(snapshot: DataFrame, stored: DataFrame, tolerance: float = 0.005, fuse_min: int = 50, fuse_share: float = 0.3,
                     enforce: bool = True) -> DataFrame:
    """Codes whose quoted previous close differs from the stored last close. Too many hits mean that the
    days are misaligned: the job stops instead of repairing everything."""
    last = last_row(stored.select("code", "date", c("close").alias("last_close")), ["code"]).select("code", "last_close")
    snap = snapshot.join(last, "code", "left")
    gap = F.abs(C.div(c("prev_close"), F.nullif(c("last_close"), F.lit(0.0))) - 1)
    flag = F.coalesce(gap > tolerance, F.lit(False)) & (c("prev_close") != 0)
    hits = snap.withColumns({"gap": gap, "flag": flag})
    if enforce:
        fuse = hits.agg(F.when(F.count_if("flag") > F.greatest(F.lit(fuse_min), F.floor(F.count("*") * fuse_share)), F.raise_error(
            F.lit("too many price gaps, trading days look misaligned")).cast("boolean")).otherwise(F.lit(True))).scalar()
        hits = hits.filter(fuse)
    return hits.filter("flag").select("code", "prev_close", "last_close", "gap")


def overlap_check(old: DataFrame, new: DataFrame, tolerance: float = 0.005) -> DataFrame:
    """Per code: gap in days from the old end to the new start, and whether the shared day was re-based."""
    o = old.groupBy("code").agg(F.max("date").alias("old_end"), F.max_by("close", "date").alias("old_close"))
    n = new.groupBy("code").agg(F.min("date").alias("new_start"))
    same = new.select("code", c("date").alias("old_end"), c("close").alias("new_close"))
    out = o.join(n, "code", "left").join(same, ["code", "old_end"], "left")
    scale = F.when(c("old_close") > 0, F.abs(C.div(c("new_close"), c("old_close")) - 1))
    return out.select("code", F.coalesce(F.datediff("new_start", "old_end"), F.lit(0)).alias("gap_days"), scale.alias("scale"),
                      F.coalesce(scale >= tolerance, F.lit(False)).alias("rebased"))


def drop_phantom_days(df: DataFrame, calendar: DataFrame) -> DataFrame:
    """Keep rows on trading days."""
    return df.join(F.broadcast(calendar.select("date")), "date", "left_semi").select(*df.columns)


def drop_unfinished(df: DataFrame, cutoff: Column) -> DataFrame:
    """Keep rows whose session was over at the cutoff day (see calendar.closed_cutoff)."""
    return df.filter(c("date") <= cutoff)


def clean_series(df: DataFrame, calendar: DataFrame) -> DataFrame:
    """Positive closes on trading days, one row per code and day (the last by close wins)."""
    df = drop_phantom_days(df.filter(c("close") > 0), calendar)
    rest = [x for x in df.columns if x not in BAR_KEY]
    return keep_last(df, BAR_KEY, rest)


def top_n_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """First n rows per group; Spark limits every group inside each partition before the shuffle."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).filter(c("rank") <= n)


def best_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return keep_last(df, keys, order)
