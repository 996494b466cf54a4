"""The corpus pipeline: language, toxicity, near duplicates, packing.

Each stage takes the documents that the one before kept, written as Parquet and read again, and all but the last return the
columns of ``documents``. Empty input gives empty output in each stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from factorspark.llm import langid, packing, simhash, toxicity
from factorspark.llm.common import table
from factorspark.session import materialize


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language: null texts and texts without a letter go."""
    return langid.keep_known(docs, held=(4, 2))


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the toxicity threshold of their language."""
    return toxicity.keep_clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels"), held=(4, 2)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near duplicates."""
    return simhash.keep_first(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all documents with their places in sequences of at most 4096 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language), ("toxicity", toxic), ("near_duplicates", near_duplicates), ("packing", pack)]

#: No stage can be expressed in SQL: models, XXH64 fingerprints and token ids are not to be had there.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
