"""Trading-day arithmetic on a calendar table (date, td_idx), one row per trading day.

The calendar is bounded by the number of days, so it is broadcast by hint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factorspark.functions import columns as C

c = F.col


def day_bounds(days: DataFrame, calendar: DataFrame) -> DataFrame:
    """For each day: position and date of the last trading day on or before it and the next after it."""
    cal = calendar.select("date", "td_idx")
    marks = cal.select("date", "td_idx").unionByName(days.select("date").distinct(), allowMissingColumns=True)
    spine = marks.groupBy("date").agg(F.max("td_idx").alias("td"))
    # The spine has one row per day, so one ordered pass over it is bounded.
    up = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    down = Window.orderBy(c("date").desc()).rowsBetween(Window.unboundedPreceding, -1)
    spine = spine.withColumns({
        "is_trading_day": c("td").isNotNull(),
        "last_idx": F.last("td", ignorenulls=True).over(up),
        "last_day": F.last(F.when(c("td").isNotNull(), c("date")), ignorenulls=True).over(up),
        "next_day": F.last(F.when(c("td").isNotNull(), c("date")), ignorenulls=True).over(down),
    }).drop("td")
    return days.join(F.broadcast(spine), "date", "left")


def shift(days: DataFrame, calendar: DataFrame, n: int, out: str = "shifted") -> DataFrame:
    """Move n trading days from each day; a non-trading day counts from the last one before it (n <= 0)
    or from the next one (n > 0)."""
    b = day_bounds(days, calendar)
    step = c("last_idx") + n + F.when(~c("is_trading_day") & F.lit(n > 0), 1).otherwise(0)
    target = F.broadcast(calendar.select(c("td_idx").alias("__t"), c("date").alias(out)))
    return b.withColumn("__t", step).join(target, "__t", "left").drop("__t", "last_idx", "last_day", "next_day", "is_trading_day")


def closed_cutoff(calendar: DataFrame, now: str, half_days: tuple[str, ...] = (), close: str = "15:00", half_close: str = "11:30") -> Column:
    """Last trading day whose session is over at ``now`` ('yyyy-MM-dd HH:mm'), as a scalar."""
    ts = F.lit(now).cast("timestamp_ntz")
    at = F.when(c("date").isin(*[F.lit(d).cast("date") for d in half_days]), F.lit(half_close)).otherwise(F.lit(close)) \
        if half_days else F.lit(close)
    ends = F.concat_ws(" ", c("date").cast("string"), at).cast("timestamp_ntz")
    return calendar.filter(ends <= ts).agg(F.max("date")).scalar()


def trading_days_between(pairs: DataFrame, calendar: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Number of trading days in (a, b]."""
    days = pairs.select(c(a).alias("date")).union(pairs.select(c(b).alias("date")))
    pos = day_bounds(days.distinct(), calendar).select("date", F.coalesce("last_idx", F.lit(0)).alias("i"))
    pa = pos.select(c("date").alias(a), c("i").alias("__ia"))
    pb = pos.select(c("date").alias(b), c("i").alias("__ib"))
    return pairs.join(F.broadcast(pa), a).join(F.broadcast(pb), b).withColumn("n_days", c("__ib") - c("__ia")).drop("__ia", "__ib")


def data_lag(dates: DataFrame, calendar: DataFrame, today: str) -> DataFrame:
    """Trading days each data date lies behind the last trading day before ``today``."""
    ref = calendar.filter(c("date") < F.lit(today).cast("date")).agg(F.max("td_idx")).scalar()
    b = day_bounds(dates, calendar)
    first = c("last_idx") + F.when(c("is_trading_day"), 0).otherwise(1)
    lag = F.when(c("date") >= F.lit(today).cast("date"), F.lit(0)).otherwise(F.greatest(F.lit(0), ref - first))
    return b.withColumn("lag_days", lag.cast("bigint")).drop("last_idx", "last_day", "next_day", "is_trading_day").withColumn(
        "level", F.when(c("lag_days") > 3, "red").when(c("lag_days") > 1, "yellow").otherwise("ok"))


def health(calendar: DataFrame, today: str, warn_days: int = 90) -> DataFrame:
    t = F.lit(today).cast("date")
    return calendar.agg(F.min("date").alias("min_date"), F.max("date").alias("max_date"), F.count("*").alias("n_days")).withColumn(
        "level", F.when(c("max_date") < t, "error").when(c("max_date") < F.date_add(t, warn_days), "warning").otherwise("ok"))


def period_ends(calendar: DataFrame, freq: str) -> DataFrame:
    """Last trading day of every ISO week or calendar month."""
    return calendar.groupBy(period_key(c("date"), freq).alias("period_key")).agg(F.max("date").alias("period_end"))


def period_key(d: Column, freq: str) -> Column:
    if freq == "weekly":
        return C.iso_week_key(d)
    if freq == "monthly":
        return C.month_key(d)
    raise ValueError(f"no period for {freq!r}")
