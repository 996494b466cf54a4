"""The bar and event store: partitioned parquet tables, readers and writers.

Layout: <root>/<table>/ym=YYYY-MM/ for sealed bars, <root>/<table>/incr/ym=…/ for daily increments and
<root>/<table>/fixup/ for repairs. Spark hides paths that start with an underscore, so none does.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factorspark.functions import columns as C
from factorspark.operators import bars as B
from factorspark.operators import quality as Q
from factorspark.schema import (ASSETS, BAR, BASES, EVENTS, FREQS, OPTIONAL, PRIVATE_META, ContractError, check_retention)

c = F.col

MANIFEST = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("ym", T.StringType()), T.StructField("rows", T.LongType()), T.StructField("codes", T.LongType()),
    T.StructField("date_min", T.DateType()), T.StructField("date_max", T.DateType()), T.StructField("fingerprint", T.LongType())])


def remove_folder(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(hadoop):
        fs.delete(hadoop, True)


class BarStore:
    """Bars of one asset and price base under a root folder."""

    def __init__(self, spark: SparkSession, root: str, asset: str = "stock", basis: str = "raw"):
        if asset not in ASSETS:
            raise ContractError(f"unknown asset {asset!r}")
        if basis not in BASES:
            raise ContractError(f"price base {basis!r} is not kept, use one of {BASES}")
        self.spark, self.asset, self.basis = spark, asset, basis
        self.base = f"{root.rstrip('/')}/market/{asset}/{basis}"

    @property
    def sealed_path(self) -> str:
        return f"{self.base}/sealed"

    @property
    def incr_path(self) -> str:
        return f"{self.base}/incr"

    @property
    def fixup_path(self) -> str:
        return f"{self.base}/fixup"

    def _read(self, path: str, schema: T.StructType | None = None) -> DataFrame | None:
        full = T.StructType(list((schema or BAR).fields) + list(OPTIONAL.fields) + [T.StructField("ym", T.StringType())])
        try:
            return self.spark.read.schema(full).parquet(path)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" in str(e):
                return None
            raise

    # -- reading ---------------------------------------------------------------------------------
    def sealed(self) -> DataFrame | None:
        return self._read(self.sealed_path)

    def increments(self) -> DataFrame | None:
        return self._read(self.incr_path)

    def fixups(self) -> DataFrame | None:
        return self._read(self.fixup_path)

    def load(self, columns: Sequence[str] | None = None, codes: Sequence[str] | None = None, start: str | None = None, end: str | None = None,
             last_n: int | None = None, freq: str = "daily") -> DataFrame:
        """Sealed and incremental rows with the repairs on top, one row per key. Date bounds also prune
        the month partitions."""
        if freq not in FREQS:
            raise ContractError(f"unknown frequency {freq!r}")
        if freq != "daily":
            return B.filter_rows(self.derived(freq), codes, start, end, last_n)
        parts = [p for p in (self.sealed(), self.increments()) if p is not None]
        if not parts:
            raise ContractError(f"no bars under {self.base}")

        def prune(df):
            if start is not None:
                df = df.filter(c("ym") >= start[:7])
            if end is not None:
                df = df.filter(c("ym") <= end[:7])
            return df.drop("ym")
        fix = self.fixups()
        df = B.load_bars([prune(p) for p in parts], None if fix is None else fix.drop("ym"))
        return B.filter_rows(B.select_columns(df, columns), codes, start, end, last_n)

    def derived(self, freq: str, closed_only: bool = True) -> DataFrame:
        """The stored weekly or monthly bars, by default without unfinished periods."""
        if freq not in FREQS or freq == "daily":
            raise ContractError(f"unknown derived frequency {freq!r}")
        if self.asset == "stock":
            raise ContractError("stock bars are not kept as weekly or monthly tables")
        try:
            df = self.spark.read.parquet(f"{self.base}/derived/{freq}")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" in str(e):
                raise ContractError(f"no {freq} bars under {self.base}") from e
            raise
        return B.load_derived(df.drop("ym"), closed_only)

    def write_derived(self, freq: str, calendar: DataFrame, asof: str | None = None) -> None:
        """Aggregate the daily bars and replace the stored weekly or monthly table."""
        if self.asset == "stock":
            raise ContractError("stock bars are not kept as weekly or monthly tables")
        bars = B.aggregate_period(self.load().select(*BAR.fieldNames()), freq, calendar, asof)
        self._spread(self._with_month(bars)).write.mode("overwrite").partitionBy("ym").parquet(f"{self.base}/derived/{freq}")

    # -- manifest --------------------------------------------------------------------------------
    def _partitions(self, months: Sequence[str] | None = None) -> DataFrame:
        """Rows, codes, dates and fingerprint of each stored month of sealed and incremental bars."""
        parts = []
        for kind, df in (("sealed", self.sealed()), ("incr", self.increments())):
            if df is not None:
                df = df if months is None else df.filter(c("ym").isin(list(months)))
                parts.append(Q.manifest(df, ["ym"]).withColumn("kind", F.lit(kind)))
        if not parts:
            raise ContractError(f"no bars under {self.base}")
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def manifest(self) -> DataFrame:
        """What the writers noted of each month: kind, ym, rows, codes, date_min, date_max, fingerprint."""
        return self.spark.read.schema(MANIFEST).parquet(f"{self.base}/manifest")

    def _note(self, months: Sequence[str]) -> None:
        """Write the entries of the touched months anew; months that are gone lose theirs."""
        now = self._partitions(months).select(*[f.name for f in MANIFEST.fields])
        rows = now.collect()  # two entries a month at most
        self.spark.createDataFrame(rows, MANIFEST).repartition(1).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("kind", "ym").parquet(f"{self.base}/manifest")
        held = {(r.kind, r.ym) for r in rows}
        for kind in ("sealed", "incr"):
            for ym in months:
                if (kind, ym) not in held:
                    self._remove(f"{self.base}/manifest/kind={kind}/ym={ym}")

    def verify(self) -> DataFrame:
        """``kind, ym, state`` of each month: ok, changed since it was noted, gone, or unlisted."""
        note = self.manifest().select("kind", "ym", c("fingerprint").alias("was"), c("rows").alias("n_was"))
        now = self._partitions().select("kind", "ym", c("fingerprint").alias("is"), c("rows").alias("n_is"))
        same = (c("was") == c("is")) & (c("n_was") == c("n_is"))
        state = F.when(c("is").isNull(), "gone").when(c("was").isNull(), "unlisted").when(same, "ok").otherwise("changed")
        return note.join(now, ["kind", "ym"], "full_outer").select("kind", "ym", state.alias("state"))

    def month(self, ym: str) -> DataFrame:
        """Sealed and incremental rows of one month; only its partitions are read."""
        parts = [p.filter(c("ym") == ym).drop("ym") for p in (self.sealed(), self.increments()) if p is not None]
        return B.load_bars(parts)

    # -- writing ---------------------------------------------------------------------------------
    @staticmethod
    def _with_month(df: DataFrame) -> DataFrame:
        return df.withColumn("ym", C.month_key(c("date")))

    @staticmethod
    def _spread(df: DataFrame) -> DataFrame:
        """Few files per month, yet a month with many rows spans several tasks."""
        return df.repartitionByRange("ym", "code")

    def write_sealed(self, df: DataFrame) -> None:
        self._spread(self._with_month(df)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("ym").parquet(self.sealed_path)
        self._note(self._months(df))

    @staticmethod
    def _months(df: DataFrame) -> list[str]:
        return [r.ym for r in df.select(C.month_key(c("date")).alias("ym")).distinct().collect()]  # bounded by the calendar

    def append_day(self, df: DataFrame, day: str, overwrite: bool = False) -> str:
        """Idempotent append of one day: the same number of rows again is skipped, another number is an
        error unless overwriting is allowed. The count is one number per side."""
        d = F.lit(day).cast("date")
        new = B.coerce(df, BAR).filter(c("date") == d)
        old = self.increments()
        n_old = 0 if old is None else old.filter((c("ym") == day[:7]) & (c("date") == d)).count()
        n_new = new.count()
        if n_new == 0:
            raise ContractError(f"no rows for {day}")
        if n_old == n_new:
            return "skipped"
        if n_old and not overwrite:
            raise ContractError(f"{day} holds {n_old} rows, got {n_new}")
        if n_old:
            month = old.filter((c("ym") == day[:7]) & (c("date") != d)).drop("ym").select(*BAR.fieldNames())
            self._replace(month.unionByName(new), self.incr_path)
            self._note([day[:7]])
            return "overwritten"
        self._with_month(new).repartitionByRange("code").write.mode("append").partitionBy("ym").parquet(self.incr_path)
        self._note([day[:7]])
        return "written"

    def append_days(self, df: DataFrame) -> DataFrame:
        """Idempotent append of all days of df at once: ``date, n, state`` with the state written, skipped (the same rows are
        there) or differs (other rows are there; nothing is written for that day). One count and one fingerprint per
        day decide, then all new days go out in one write."""
        new = B.coerce(df, BAR)
        mark = F.sum(F.xxhash64(*BAR.fieldNames()).cast("decimal(20,0)"))
        days = new.groupBy("date").agg(F.count("*").alias("n"), mark.alias("mark"))
        old = self.increments()
        if old is None:
            plan = days.select("date", "n", F.lit("written").alias("state"))
        else:
            months = [r.ym for r in days.select(C.month_key(c("date")).alias("ym")).distinct().collect()]  # bounded by the calendar
            held = old.filter(c("ym").isin(months)).groupBy("date").agg(F.count("*").alias("n_old"), mark.alias("mark_old"))
            same = (c("n") == c("n_old")) & (c("mark") == c("mark_old"))
            plan = days.join(held, "date", "left").select(
                "date", "n", F.when(c("n_old").isNull(), "written").when(same, "skipped").otherwise("differs").alias("state"))
        rows = plan.collect()  # one row per day
        plan = self.spark.createDataFrame(rows, "date date, n long, state string")
        todo = [r["date"] for r in rows if r["state"] == "written"]
        if todo:
            self._spread(self._with_month(new.filter(c("date").isin(todo)))).write.mode("append").partitionBy("ym").parquet(self.incr_path)
            self._note(sorted({d.isoformat()[:7] for d in todo}))
        return plan

    def append_frozen(self, df: DataFrame) -> None:
        """Append rows with new keys; a key that is already there would change frozen history."""
        new = B.coerce(df, BAR)
        old = self.increments()
        months = self._months(new)
        if old is not None:
            old = old.filter(c("ym").isin(months))
        if old is not None and new.join(old.select("code", "date"), ["code", "date"], "left_semi").limit(1).count():
            raise ContractError("rows of frozen keys")
        self._with_month(new).write.mode("append").partitionBy("ym").parquet(self.incr_path)
        self._note(months)

    def _replace(self, df: DataFrame, path: str, files: int | None = None) -> None:
        """Overwrite the months of df, which may be read from them: the rows are staged beside the table and the stage
        is removed afterwards."""
        stage = f"{self.base}/stage-{uuid.uuid4().hex}"
        try:
            self._with_month(df).write.mode("overwrite").parquet(stage)
            staged = self.spark.read.parquet(stage)
            out = self._spread(staged) if files is None else staged.repartitionByRange(files, "code").sortWithinPartitions("code", "date")
            out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("ym").parquet(path)
        finally:
            self._remove(stage)

    def rebuild_months(self, df: DataFrame) -> None:
        """Merge rows into their months: sealed, incremental and new rows, each winning over those before, no other code
        is lost. The months' increments are part of the result and are cleared."""
        new = B.coerce(df, BAR)
        months = self._months(new)
        old = [p.filter(c("ym").isin(months)).select(*BAR.fieldNames()) for p in (self.sealed(), self.increments()) if p is not None]
        self._replace(B.load_bars([*old, new]).select(*BAR.fieldNames()), self.sealed_path)
        for ym in months:
            self._clear(self.incr_path, ym)
        self._note(months)

    def seal(self, ym: str, codes_per_file: int = 200, dry_run: bool = False) -> int:
        """Compact the increments of one month into sorted files of ``codes_per_file`` codes. A key that is sealed
        already takes its incremental row; as many keys must come out as went in."""
        inc = self.increments().filter(c("ym") == ym).select(*BAR.fieldNames())
        n = inc.count()
        if dry_run or n == 0:
            return n
        parts = [inc]
        old = self.sealed()
        if old is not None:
            parts.insert(0, old.filter(c("ym") == ym).select(*BAR.fieldNames()))
        rows = B.load_bars(parts).select(*BAR.fieldNames())
        stats = rows.agg(F.count("*").alias("n"), F.approx_count_distinct("code").alias("k")).first()
        self._replace(rows, self.sealed_path, max(1, -(-stats.k // codes_per_file)))
        if self.sealed().filter(c("ym") == ym).count() != stats.n:
            raise ContractError(f"sealing {ym} lost rows")
        self._clear(self.incr_path, ym)
        self._note([ym])
        return stats.n

    def _clear(self, path: str, ym: str) -> None:
        self._remove(f"{path}/ym={ym}")

    def _remove(self, path: str) -> None:
        remove_folder(self.spark, path)

    def expire(self, calendar: DataFrame, today: str, keep: int | None, archive: str | None = None, dry_run: bool = True) -> DataFrame:
        """Months this asset no longer has to keep. Unless it is a dry run, their rows go to the folder ``archive`` (if
        one is given), then their partitions and manifest entries are removed; whole months only, nothing is rewritten."""
        check_retention(self.asset, keep)
        stored = [p.select("ym") for p in (self.sealed(), self.increments()) if p is not None]
        plan = retention_plan(stored[0].unionByName(stored[-1]).distinct(), calendar, today, keep)
        if dry_run:
            return plan
        rows = plan.collect()  # one row per month
        months = [r.ym for r in rows]
        done = self.spark.createDataFrame(rows, plan.schema)
        if months:
            if archive is not None:
                parts = [p.filter(c("ym").isin(months)) for p in (self.sealed(), self.increments()) if p is not None]
                kept = B.load_bars([p.drop("ym") for p in parts])
                self._spread(self._with_month(kept)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("ym").parquet(
                    f"{archive.rstrip('/')}/{self.asset}/{self.basis}")
            for ym in months:
                self._clear(self.sealed_path, ym)
                self._clear(self.incr_path, ym)
            self._note(months)
        return done


#: Files of the older layout in rising priority, with the depth of their folders; fixed order: what is flat is newer.
LEGACY = (("year=*/month=*/*.parquet", 2), ("*.parquet", 0), ("_incr/*/*.parquet", 1), ("_incr/*.parquet", 0))


def read_legacy(spark: SparkSession, base: str, schema: T.StructType = BAR, start: str | None = None, end: str | None = None,
                fix: DataFrame | None = None) -> DataFrame:
    """Bars of the older layout, one row per key: year=/month= folders and flat sealed files below ``base``, increments below
    ``_incr`` in day folders or flat.

    Of rows with one key the last read counts, where month folders come before flat sealed files, these before increments in day
    folders and these before flat increments; inside a layer folders and files go by name and a file's rows by their place. The
    order is that of ``_metadata``, so it doesn't depend on how Spark splits the files. Date bounds also leave out month folders.
    """
    parts = []
    for pattern, depth in LEGACY:
        reader = spark.read.option("basePath", base.rstrip("/"))
        full = T.StructType([*schema.fields, *OPTIONAL.fields])
        if depth == 2:
            full = T.StructType([*full.fields, T.StructField("year", T.StringType()), T.StructField("month", T.StringType())])
        try:
            df = reader.schema(full).parquet(f"{base.rstrip('/')}/{pattern}")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" in str(e):
                continue
            raise
        if depth == 2:
            ym = F.concat_ws("-", "year", "month")
            if start is not None:
                df = df.filter(ym >= start[:7])
            if end is not None:
                df = df.filter(ym <= end[:7])
        # Folders and file by name, not the whole path: "20240110-b" follows "20240110" although "-" precedes "/".
        place = F.struct(F.slice(F.split(c("_metadata.file_path"), "/"), -depth - 1, depth + 1).alias("names"), c("_metadata.row_index").alias("row"))
        parts.append(df.select(*schema.fieldNames(), *OPTIONAL.fieldNames(), place.alias("__origin")))
    if not parts:
        raise ContractError(f"no bars under {base}")
    return B.filter_rows(B.load_bars(parts, fix, origin="__origin"), start=start, end=end)


def retention_plan(months: DataFrame, calendar: DataFrame, today: str, keep: int | None) -> DataFrame:
    """Months whose last day lies before the trading day ``keep`` days before today; none for keep=None."""
    last = F.last_day(F.to_date(F.concat("ym", F.lit("-01"))))
    if keep is None:
        return months.withColumn("last_day", last).filter(F.lit(False))
    past = calendar.filter(c("date") <= F.lit(today).cast("date")).orderBy(c("date").desc()).limit(keep + 1)
    cutoff = past.agg(F.min("date")).scalar()
    enough = past.agg(F.count("*")).scalar() == keep + 1
    return months.withColumn("last_day", last).filter((c("last_day") < cutoff) & enough)


def trim_rolling(df: DataFrame, index_days: DataFrame, keep: int) -> DataFrame:
    """Rows from the keep-th latest index day on."""
    cutoff = index_days.select("date").distinct().orderBy(c("date").desc()).limit(keep).agg(F.min("date")).scalar()
    return df.filter(c("date") >= cutoff)


def gap_backfill(stored: DataFrame, source: DataFrame, cutoff: str) -> DataFrame:
    """Source rows before the cutoff whose keys the store does not hold yet."""
    old = source.filter(c("date") < F.lit(cutoff).cast("date"))
    return old.join(stored.select("code", "date"), ["code", "date"], "left_anti")


def export_layout(df: DataFrame, basis: str) -> DataFrame:
    """Bars in the exchange layout: market-digit codes, the base's columns and the market shard."""
    secid = C.code_to_secid(c("code"))
    cols = ["open", "high", "low", "close"] + (["volume", "amount"] if basis == "raw" else [])
    mkt = F.when(F.startswith(secid, F.lit("1.")), "b0").when(F.startswith(secid, F.lit("2.")), "b2").otherwise("b1")
    return df.select(secid.alias("code"), "date", *cols, mkt.alias("mkt"))


def seed_meta(df: DataFrame, required: Sequence[str]) -> DataFrame:
    missing = [x for x in required if x not in df.columns]
    if missing:
        raise ContractError(f"columns {missing} are missing")
    return df.select(*required)


def load_meta(spark: SparkSession, root: str, name: str, domain: str | None = None, schema: T.StructType | None = None) -> DataFrame:
    """A reference table as parquet, JSON or CSV, whichever is there first. Private tables are only for
    their own domain."""
    owner = PRIVATE_META.get(name)
    if owner is not None and domain != owner:
        raise ContractError(f"{name} belongs to {owner}")
    for fmt in ("parquet", "json", "csv"):
        reader = spark.read if schema is None else spark.read.schema(schema)
        if fmt == "csv":
            reader = reader.option("header", True)
        try:
            return getattr(reader, fmt)(f"{root.rstrip('/')}/meta/{name}.{fmt}")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
    raise ContractError(f"no table {name} under {root}")


class EventStore:
    """An event table partitioned by day, upserted by its key."""

    def __init__(self, spark: SparkSession, root: str, name: str):
        if name not in EVENTS:
            raise ContractError(f"unknown event table {name!r}")
        self.spark, self.name = spark, name
        self.keys, self.schema = EVENTS[name]
        self.path = f"{root.rstrip('/')}/events/{name}"
        self.stage_root = f"{root.rstrip('/')}/events-stage"

    def _read(self) -> DataFrame | None:
        full = T.StructType([*self.schema.fields, T.StructField("day", T.StringType())])
        try:
            return self.spark.read.schema(full).parquet(self.path)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" in str(e):
                return None
            raise

    def load(self, dates: Sequence[str] | None = None, start: str | None = None, end: str | None = None, **filters) -> DataFrame:
        """Rows of the asked days; bounds also prune the day partitions."""
        df = self._read()
        if df is None:
            raise ContractError(f"no events under {self.path}")
        if dates:
            df = df.filter(c("day").isin(list(dates)))
        if start is not None:
            df = df.filter(c("day") >= start)
        if end is not None:
            df = df.filter(c("day") <= end)
        return B.query_events(df.drop("day"), dates=dates, start=start, end=end, **filters)

    def upsert(self, df: DataFrame) -> None:
        """Merge rows by key; only the days they touch are rewritten."""
        new = B.coerce(df, self.schema)
        old = self._read()
        rows = new.withColumn("__prio", F.lit(1))
        if old is not None:
            days = new.select(c("date").cast("string").alias("day")).distinct()
            touched = old.join(F.broadcast(days), "day", "left_semi").drop("day").withColumn("__prio", F.lit(0))
            rows = touched.unionByName(rows)
        rest = [x for x in self.schema.fieldNames() if x not in self.keys]
        merged = B.keep_last(rows, self.keys, ["__prio", *rest]).drop("__prio").withColumn("day", c("date").cast("string"))
        self._overwrite(merged)

    def write_month(self, df: DataFrame) -> None:
        """Full rebuild of the months in df: one row per key, and days that df no longer has go. Of rows with one key the
        greatest counts."""
        new = B.coerce(df, self.schema)
        rest = [x for x in self.schema.fieldNames() if x not in self.keys]
        new = (B.keep_last(new, self.keys, rest) if rest else new.dropDuplicates(self.keys)).withColumn("day", c("date").cast("string"))
        months = [r.ym for r in new.select(F.substring("day", 1, 7).alias("ym")).distinct().collect()]  # bounded by the calendar
        old = self._read()
        gone = []
        if old is not None:
            held = old.filter(F.substring("day", 1, 7).isin(months)).select("day").distinct()
            gone = [r.day for r in held.join(new.select("day").distinct(), "day", "left_anti").collect()]
        self._write(new)
        for day in gone:
            remove_folder(self.spark, f"{self.path}/day={day}")

    def _write(self, df: DataFrame) -> None:
        df.repartitionByRange("day", self.keys[1]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(self.path)

    def _overwrite(self, df: DataFrame) -> None:
        stage = f"{self.stage_root}/{self.name}-{uuid.uuid4().hex}"
        try:
            df.write.parquet(stage)
            self._write(self.spark.read.schema(df.schema).parquet(stage))
        finally:
            remove_folder(self.spark, stage)


def write_reports(df: DataFrame, path: str) -> None:
    """Envelopes as JSON, one folder per domain and variant."""
    df.write.mode("overwrite").partitionBy("domain", "variant").json(path)


def envelopes(payloads: DataFrame, generated_at: str, schema_version: str = "1.0") -> DataFrame:
    """Payload rows (domain, variant, data_date, payload struct) as report envelopes with warnings."""
    empty = F.to_json("payload") == "{}"
    return payloads.select(
        "domain", "variant", F.lit(generated_at).alias("generated_at"), c("data_date").cast("string").alias("data_date"),
        F.lit(schema_version).alias("schema_version"), F.to_json("payload").alias("payload"),
        F.filter(F.array(F.when(empty, F.lit("payload is empty")), F.when(c("data_date").isNull(), F.lit("data date is missing"))),
                 lambda x: x.isNotNull()).alias("warnings"))


def split_variants(reports: DataFrame, domain: str, variants: dict[str, Sequence[str]]) -> DataFrame:
    """One payload per variant out of a map of sections: variant -> its section names. Sections that are
    absent give no row, except for the first variant. Input: data_date, sections MAP<STRING,STRING>."""
    rows = F.array(*[F.struct(F.lit(v).alias("variant"), F.array(*[F.lit(s) for s in secs]).alias("names"), F.lit(i == 0).alias("always"))
                     for i, (v, secs) in enumerate(variants.items())])
    d = reports.withColumn("v", F.explode(rows))
    payload = F.map_filter("sections", lambda k, _: F.array_contains(c("v.names"), k))
    return d.select(F.lit(domain).alias("domain"), c("v.variant").alias("variant"), "data_date", payload.alias("payload"),
                    c("v.always").alias("always")).filter((F.size("payload") > 0) | c("always")).drop("always")
