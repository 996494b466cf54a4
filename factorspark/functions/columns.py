"""Column expressions: codes, markets, price limits and safe arithmetic. No Python UDFs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPS = 1e-9


def div(a, b) -> Column:
    """a / b, null where b is zero or null."""
    return F.try_divide(a, b)


def gt(a, b) -> Column:
    """a > b by more than a share EPS of the larger one, so that averages summed in another order compare alike."""
    return (a - b) > F.lit(EPS) * F.greatest(F.abs(a), F.abs(b))


def non_zero(c) -> Column:
    return F.nullif(c, F.lit(0.0))


def _zfill6(c: Column) -> Column:
    return F.when(F.length(c) < 6, F.lpad(c, 6, "0")).otherwise(c)


def normalize_code(c: Column) -> Column:
    """Any written form of an instrument code to the short code; idempotent, empty gives null."""
    s = F.trim(c.cast("string"))
    low = F.lower(s)
    # Dotted prefixes, letter prefixes and the index form.
    dotted = F.regexp_extract(low, r"^(?:sh|sz|bj|0|1|2)\.(\d+)$", 1)
    glued = F.regexp_extract(low, r"^(?:sh|sz|bj)(\d+)$", 1)
    return (
        F.when(s == "", F.lit(None).cast("string"))
        .when(s.rlike(r"^[Hh]\d"), F.upper(s))
        .when(dotted != "", _zfill6(dotted))
        .when(glued != "", _zfill6(glued))
        .when(s.rlike(r"^\d+$"), _zfill6(s))
        .otherwise(s)
    )


def _first(c: Column) -> Column:
    return F.substring(c, 1, 1)


def code_to_secid(code: Column, strict: bool = False) -> Column:
    """Short code to '<market digit>.<code>'; index-like codes give null, or an error if strict."""
    c = normalize_code(code)
    bad = F.raise_error(F.concat(F.lit("no market for code "), c)).cast("string") if strict else F.lit(None)
    return (
        F.when(~c.rlike(r"^\d+$"), bad)
        .when(_first(c).isin("6", "9"), F.concat(F.lit("1."), c))
        .when(_first(c).isin("0", "2", "3", "4", "8"), F.concat(F.lit("0."), c))
        .otherwise(bad)
    )


def code_to_symbol(code: Column, strict: bool = False) -> Column:
    """Short code to exchange symbol such as sh600000."""
    sid = code_to_secid(code, strict)
    prefix = F.when(F.startswith(sid, F.lit("1.")), F.lit("sh")).otherwise(F.lit("sz"))
    return F.when(sid.isNotNull(), F.concat(prefix, F.substring(sid, 3, 32)))


def market_of(code: Column) -> Column:
    """sh / sz / bj / other by the first digit."""
    c = F.trim(code.cast("string"))
    return (
        F.when(~c.rlike(r"^\d+$"), F.lit("other"))
        .when(_first(c).isin("6", "9"), F.lit("sh"))
        .when(_first(c).isin("0", "2", "3"), F.lit("sz"))
        .when(_first(c).isin("4", "8"), F.lit("bj"))
        .otherwise(F.lit("other"))
    )


def market_prefix(code: Column) -> Column:
    """sh for codes starting with 6 or 9, bj for 4 or 8, else sz."""
    return (
        F.when(_first(code).isin("6", "9"), F.lit("sh"))
        .when(_first(code).isin("4", "8"), F.lit("bj"))
        .otherwise(F.lit("sz"))
    )


def limit_rate(code: Column) -> Column:
    """Two-board price limit: 20 % for codes 30… and 68…, else 10 %."""
    return F.when(F.substring(code, 1, 2).isin("30", "68"), F.lit(0.20)).otherwise(F.lit(0.10))


def limit_threshold(code: Column) -> Column:
    """Three-board price limit in percent."""
    # Board prefixes and their limits.
    return (
        F.when(F.substring(code, 1, 3).isin("688", "689", "300", "301", "302"), F.lit(20.0))
        .when(_first(code).isin("4", "8"), F.lit(30.0))
        .otherwise(F.lit(10.0))
    )


def clip(c: Column, lo: float, hi: float) -> Column:
    return F.greatest(F.lit(lo), F.least(F.lit(hi), c))


def iso_week_key(d: Column) -> Column:
    return F.concat(
        F.extract(F.lit("YEAROFWEEK"), d).cast("string"), F.lit("-W"),
        F.lpad(F.weekofyear(d).cast("string"), 2, "0"),
    )


def month_key(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM")


def tick_order(ts: Column, seq: Column) -> Column:
    """Time and event number as one flat number, so that first/last picks stay in hash aggregation."""
    micros = F.unix_micros(ts.cast("timestamp")).cast("decimal(19,0)")
    return micros * F.lit(10**18).cast("decimal(19,0)") + seq.cast("decimal(18,0)")
