"""Registry of named queries and their oracle statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from factorspark.sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of the contract tables under a name, with its oracle if it has one."""

    def wrap(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


def rounded(df: DataFrame, **places: int) -> DataFrame:
    """Round the named columns, the last step before a comparison with another engine."""
    from pyspark.sql import functions as F

    return df.withColumns({c: F.round(c, k) for c, k in places.items()})


def R(expr: str, places: int) -> str:
    """SQL twin of ``rounded``; adding zero turns -0.0 into 0.0."""
    return f"round({expr}, {places}) + 0.0"
