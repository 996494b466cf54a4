"""Structured Streaming twins of the bar jobs. Each equals its batch form on the same rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from factorspark.functions import columns as C
from factorspark.session import shared_dir
from factorspark.sources import ingest as G
from factorspark.sources.store import remove_folder

c = F.col


def run_to_files(stream: DataFrame, out: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Run a stream over what is there now and return its output table."""
    q = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode(mode).trigger(
        availableNow=True).start()
    finish(q)
    return stream.sparkSession.read.schema(stream.schema).parquet(out)


def finish(q: StreamingQuery) -> None:
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def append_once(source: DataFrame, sink: str, checkpoint: str, keys: Sequence[str] = ("code", "date"), time: str = "date") -> StreamingQuery:
    """Append each key once, however late it comes; later copies of a key are ignored.

    The sink is partitioned by month and is itself the memory: a batch is reduced to one row per key and joined against
    the keys of its own months only. A replayed batch finds its rows there already.
    """
    k = list(keys)

    def write(batch: DataFrame, _: int) -> None:
        new = batch.dropDuplicates(k).withColumn("ym", C.month_key(c(time)))
        months = [r.ym for r in new.select("ym").distinct().collect()]  # bounded by the calendar
        try:
            old = batch.sparkSession.read.schema(new.schema).parquet(sink).filter(c("ym").isin(months)).select(*k)
            new = new.join(old, k, "left_anti").select(*new.columns)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
        new.write.mode("append").partitionBy("ym").parquet(sink)

    return source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _period(ts: Column, span: str) -> Column:
    if span not in ("day", "week"):
        raise ValueError(f"unknown span {span!r}")
    return F.date_trunc(span, ts).cast("date")


def partial_bars(ticks: DataFrame, sink: str, checkpoint: str, span: str) -> StreamingQuery:
    """Keep the bars of a stream of (code, ts, seq, value) ticks as parts, one folder per batch.

    No tick is lost to a watermark: a late one becomes a further part of its period, and reading combines the parts. A
    replayed batch overwrites its own folder.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        order, v = C.tick_order(c("ts"), c("seq")), c("value")
        g = batch.groupBy("code", _period(c("ts"), span).alias("date")).agg(
            F.min_by(v, order).alias("open"), F.min(order).alias("first"), F.max(v).alias("high"), F.min(v).alias("low"),
            F.max_by(v, order).alias("close"), F.max(order).alias("last"), F.count("*").alias("volume"), F.sum(v).alias("amount"))
        g.write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")

    return ticks.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_bars(spark: SparkSession, sink: str, closed: bool = True) -> DataFrame:
    """Bars out of the parts; ``closed`` withholds the latest period, which may still grow."""
    parts = spark.read.parquet(sink).drop("batch")
    bars = _combined(parts)
    return bars.filter(c("date") < parts.agg(F.max("date")).scalar()) if closed else bars


def _combined(parts: DataFrame) -> DataFrame:
    return parts.groupBy("code", "date").agg(
        F.min_by("open", "first").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "last").alias("close"),
        F.sum("volume").alias("volume"), F.sum("amount").alias("amount"))


def emit_closed(ticks: DataFrame, root: str, checkpoint: str, span: str) -> StreamingQuery:
    """Emit each period's bar once, when a tick of a later period closes it, and again whenever a late tick changes it.

    Under ``root`` a batch N writes its parts (``parts/batch=N``), the latest period seen so far (``clock/batch=N``, one row) and
    the bars it closes or amends (``closed/batch=N``). It reads the parts of the periods it closes and of the keys it amends
    only. A replayed batch sees the same earlier batches and overwrites its own folders.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        order, v = C.tick_order(c("ts"), c("seq")), c("value")
        g = batch.groupBy("code", _period(c("ts"), span).alias("date")).agg(
            F.min_by(v, order).alias("open"), F.min(order).alias("first"), F.max(v).alias("high"), F.min(v).alias("low"),
            F.max_by(v, order).alias("close"), F.max(order).alias("last"), F.count("*").alias("volume"), F.sum(v).alias("amount"))
        g.write.mode("overwrite").parquet(f"{root}/parts/batch={batch_id}")
        own = spark.read.schema(g.schema).parquet(f"{root}/parts/batch={batch_id}")
        parts = spark.read.schema(g.schema.add("batch", "long")).parquet(f"{root}/parts").filter(c("batch") <= batch_id)
        before = None
        if batch_id:
            seen = spark.read.schema("clock date, batch long").parquet(f"{root}/clock").filter(c("batch") < batch_id)
            before = seen.agg(F.max("clock")).first()[0]
        now = max((d for d in (before, own.agg(F.max("date")).first()[0]) if d is not None), default=None)
        spark.createDataFrame([(now,)], "clock date").write.mode("overwrite").parquet(f"{root}/clock/batch={batch_id}")
        newly = parts.filter((c("date") < F.lit(now)) & (F.lit(True) if before is None else c("date") >= F.lit(before)))
        out = _combined(newly)
        if before is not None:
            late = own.filter(c("date") < F.lit(before)).select("code", "date")
            days = [r.date for r in late.select("date").distinct().collect()]  # bounded by the calendar
            out = out.unionByName(_combined(parts.filter(c("date").isin(days)).join(late, ["code", "date"], "left_semi")))
        out.write.mode("overwrite").parquet(f"{root}/closed/batch={batch_id}")

    return ticks.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_emitted(spark: SparkSession, root: str) -> DataFrame:
    """All emitted bars; ``revision`` is the batch that emitted them, the greatest of a key is its latest form."""
    return spark.read.schema("code string, date date, open double, high double, low double, close double, volume long, amount double, batch long").parquet(
        f"{root}/closed").withColumnRenamed("batch", "revision")


def unfinished(calendar: DataFrame, now: str, close: str = "15:00", half_close: str = "11:30") -> DataFrame:
    """``date, reason`` of the calendar days (date, half_day) whose session isn't over at the moment ``now`` (YYYY-MM-DD HH:MM)."""
    at = F.when(F.coalesce("half_day", F.lit(False)), F.lit(half_close)).otherwise(F.lit(close))
    today, time = now[:10], now[11:16]
    reason = F.when(c("date") > F.lit(today).cast("date"), F.lit("day to come")).when(
        (c("date") == F.lit(today).cast("date")) & (F.lit(time) < at), F.concat(F.lit("session open until "), at))
    return calendar.select("date", reason.alias("reason")).filter(c("reason").isNotNull())


def gate_bars(bars: DataFrame, calendar: DataFrame, now: str, root: str, checkpoint: str, **session: str) -> StreamingQuery:
    """Append bars of closed sessions to ``root/bars``; those of an open session and of days to come go to ``root/rejected`` with their
    reason. The calendar (date, half_day) is static and joined to each batch, which writes folders of its own."""
    open_days = unfinished(calendar, now, **session)

    def write(batch: DataFrame, batch_id: int) -> None:
        judged = batch.join(F.broadcast(open_days), "date", "left").select(*batch.columns, "reason")  # calendar-sized
        judged.filter(c("reason").isNull()).drop("reason").write.mode("overwrite").parquet(f"{root}/bars/batch=b{batch_id}")
        judged.filter(c("reason").isNotNull()).withColumn("seen_at", F.lit(now)).write.mode("overwrite").parquet(f"{root}/rejected/batch=b{batch_id}")

    return bars.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def accept_closed(spark: SparkSession, schema, calendar: DataFrame, now: str, root: str, keys: Sequence[str] = ("code", "date"), **session: str) -> None:
    """Accept the rejected bars whose session has closed by ``now``, each key once; a second call finds them accepted already."""
    name = "r" + now.replace(" ", "T").replace(":", "")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
    rejected = spark.read.schema(f"{fields}, reason string, seen_at string, batch string").parquet(f"{root}/rejected")
    ready = rejected.join(F.broadcast(unfinished(calendar, now, **session)), "date", "left_anti").dropDuplicates(list(keys))
    there = spark.read.schema(f"{fields}, batch string").parquet(f"{root}/bars").filter(c("batch") != name)
    ready.join(there.select(*keys), list(keys), "left_anti").select(*schema.fieldNames()).write.mode("overwrite").parquet(f"{root}/bars/batch={name}")


STREAK_OUT = "code string, date date, close double, limit_up long, limit_count long, m3 long, m5 long, m10 long"
STREAK_ROWS = f"{STREAK_OUT}, day date, flags array<long>, batch long, kind string"


def limit_streak(bars: DataFrame, root: str, checkpoint: str) -> StreamingQuery:
    """Limit-up flag, run length and counts per code with keyed state. State per code is its last date, its last close, its run
    and its last ten flags (latest first); rows not after the last seen date are ignored, so bars come in batches by date. A row
    without a date counts as the last of its batch; of several rows of a code and date the least close counts.

    Under ``root`` a batch N writes its rows (``batch=N/kind=bar``) and the state of all codes after it (``batch=N/kind=state``).
    The state joins the batch as a row before the code's own, so one shuffle serves both. A replayed batch reads the state of
    the batch before it and overwrites its own folder; older states are removed.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        close = F.nanvl(c("close").cast("double"), F.lit(None).cast("double"))
        rows = batch.groupBy("code", "date").agg(F.min(close).alias("close")).withColumns(
            {"new": F.lit(1), "limit_count": F.lit(None).cast("long"), "flags": F.lit(None).cast("array<long>")})
        if batch_id:
            before = spark.read.schema(STREAK_ROWS).parquet(root).filter((c("batch") == batch_id - 1) & (c("kind") == "state"))
            rows = rows.unionByName(before.select("code", c("day").alias("date"), "close", F.lit(0).alias("new"), "limit_count", "flags"))
        w = Window.partitionBy("code").orderBy("new", c("date").asc_nulls_last())
        so_far = w.rowsBetween(Window.unboundedPreceding, 0)
        rows = rows.withColumns({
            "seen": F.first(F.when(c("new") == 0, c("date"))).over(so_far), "run": F.coalesce(F.first("limit_count").over(so_far), F.lit(0)),
            "earlier": F.coalesce(F.first("flags").over(so_far), F.array().cast("array<long>"))})
        rows = rows.filter((c("new") == 0) | c("seen").isNull() | c("date").isNull() | (c("date") > c("seen")))
        limit = F.rint((F.lag("close").over(w) * (1 + C.limit_threshold(c("code")) / 100) + 1e-9) * 100) / 100
        rows = rows.withColumns({
            "at": F.sum("new").over(so_far), "day": F.max("date").over(so_far), "last": F.lead("new").over(w).isNull(),
            "limit_up": F.when(c("new") == 1, F.coalesce(c("close") >= limit - 0.001, F.lit(False)).cast("long"))})
        opened = F.max(F.when(c("limit_up") == 0, c("at"))).over(so_far)  # the last row without the flag; null: the run came in
        ups = lambda n: F.slice("earlier", 1, F.greatest(n - c("at"), F.lit(0)).cast("int"))
        count = lambda n: F.aggregate(ups(n), F.coalesce(F.sum("limit_up").over(w.rowsBetween(1 - n, 0)), F.lit(0)), lambda a, x: a + x)
        own = F.reverse(F.collect_list("limit_up").over(w.rowsBetween(-9, 0)))
        rows = rows.withColumns({
            "limit_count": F.coalesce(c("at") - opened, c("run") + c("at")), **{f"m{n}": count(n) for n in (3, 5, 10)},
            "flags": F.when(c("last"), F.slice(F.concat(own, c("earlier")), 1, 10))})
        kinds = F.array_compact(F.array(F.when(c("new") == 1, F.lit("bar")), F.when(c("last"), F.lit("state"))))
        rows.select("code", "date", "close", "limit_up", "limit_count", "m3", "m5", "m10", "day", "flags", F.explode(kinds).alias("kind")).write.mode(
            "overwrite").partitionBy("kind").parquet(f"{root}/batch={batch_id}")
        remove_folder(spark, f"{root}/batch={batch_id - 2}/kind=state")

    return bars.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_streaks(spark: SparkSession, root: str) -> DataFrame:
    """The rows of all batches."""
    rows = spark.read.schema(STREAK_ROWS).parquet(root).filter(c("kind") == "bar")
    return rows.select("code", "date", "close", "limit_up", "limit_count", "m3", "m5", "m10")


def drop_ledger(lines: DataFrame, symbols: DataFrame, sink: str, checkpoint: str) -> StreamingQuery:
    """Dropped quote lines by reason. Each batch writes its own folder, so a replay overwrites itself."""
    def write(batch: DataFrame, batch_id: int) -> None:
        G.drop_ledger(G.parse_quotes(batch, symbols)).write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")

    return lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_ledger(spark: SparkSession, sink: str) -> DataFrame:
    d = spark.read.schema("reason string, n long, batch long").parquet(sink)
    return d.groupBy("reason").agg(F.sum("n").alias("n"))


def file_stream(spark: SparkSession, path: str, schema, per_trigger: int | None = 1, glob: str | None = None) -> DataFrame:
    """``per_trigger`` files make a batch, in no order among files written together; None: all that are there."""
    r = spark.readStream.schema(schema)
    if per_trigger is not None:
        r = r.option("maxFilesPerTrigger", per_trigger)
    if glob is not None:
        r = r.option("pathGlobFilter", glob)
    return r.parquet(path)


def work_paths(spark: SparkSession, purpose: str) -> tuple[str, str, str]:
    """Source, sink and checkpoint folders of one run."""
    base = shared_dir(spark, purpose)
    return f"{base}/source", f"{base}/sink", f"{base}/checkpoint"
