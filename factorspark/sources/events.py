"""Event tables: typed union, key dedupe and filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factorspark.functions import columns as C
from factorspark.operators import bars as B
from factorspark.schema import EVENTS, ContractError


def merge_events(name: str, parts: Sequence[DataFrame]) -> DataFrame:
    """Union of event shards in rising priority with one row per table key."""
    if name not in EVENTS:
        raise ContractError(f"unknown event table {name!r}")
    keys, schema = EVENTS[name]
    df = None
    for i, p in enumerate(parts):
        p = p.select(*[x for x in p.columns if x in schema.fieldNames()])
        if "code" in p.columns:
            p = p.withColumn("code", C.normalize_code(F.col("code")))
        p = p.withColumn("__prio", F.lit(i))
        df = p if df is None else df.unionByName(p, allowMissingColumns=True)
    rest = [x for x in df.columns if x not in (*keys, "__prio")]
    return B.keep_last(df, keys, ["__prio", *rest]).drop("__prio")


def load_events(name: str, parts: Sequence[DataFrame], start: str | None = None, end: str | None = None, dates: Sequence[str] | None = None,
                codes: Sequence[str] | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    return B.query_events(merge_events(name, parts), dates, start, end, codes, columns)
