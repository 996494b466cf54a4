"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factorspark.llm import bpe, clustering, html_text, langid, licenses, packing, quality, simhash, topk, toxicity, urls, vectors, whitening
from factorspark.llm.common import held_out, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op1_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"), least=0.93)


@query
def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"))


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


@query
def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


URL_RULES = [urls.Rule("allow", "com", "/"), urls.Rule("block", "example.com", "/en/"), urls.Rule("allow", "www.example.com", "/en/"),
             urls.Rule("block", "net", "/es/"), urls.Rule("block", "net", "/fr/")]


@query
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = urls.verdicts(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return found.select("page_id", "host", "path", "rule", "verdict")


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), held=(4, 2))
    scored = toxicity.predict(docs, model)
    return scored.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), every=100, k=10)


@query
def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.predict(docs, langid.train(docs, held=(4, 2)))
    return found.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score")


@query
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality.predict(docs, quality.train(docs, table(spark, sf_dir, "labels"), held=(5, 0)))
    return scored.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op11_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster(table(spark, sf_dir, "embeddings"), k=40, rounds=5, scale=256, dims=64, seed="2")


@query
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), scale=64, shift=1_000_000, components=32)


@query
def op13_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"),
                        F.array_join("labels", ",").alias("labels"), "score")


ORACLES["op11_clusters"] = clustering.oracle_sql()

ORACLES["op13_licenses"] = licenses.oracle_sql()

ORACLES["op1_vectors"] = """
with recursive numbered as materialized (select row_number() over () rid, vec_id, label, embedding from embeddings),
rows as materialized (select rid, label, list_transform(embedding, lambda x: x::double) v from numbered
    where label is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as materialized (select a.rid a, b.rid b from rows a join rows b on a.label = b.label and a.rid <> b.rid and len(a.v) = len(b.v)
    where list_cosine_similarity(a.v, b.v) >= 0.93),
reached as (select a, b from links union select r.a, l.b from reached r join links l on r.b = l.a),
lows as (select a, min(vec_id) low from reached join numbered on rid = b group by a)
select e.vec_id, coalesce(n.n, 0)::bigint n_links, least(e.vec_id, r.low) component_id, least(e.vec_id, r.low) is not distinct from e.vec_id kept
from numbered e left join (select a, count(*) n from links group by a) n on n.a = e.rid left join lows r on r.a = e.rid
"""

ORACLES["op8_top_k"] = """
with rows as materialized (select row_number() over () rid, vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) v from embeddings
    where embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
scores as (select q.rid, q.vec_id query_id, c.vec_id, c.rid other, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::bigint score
    from rows q join rows c on q.vec_id % 100 = 0 and q.rid <> c.rid),
ranked as (select query_id, row_number() over (partition by rid order by score desc, vec_id nulls last, other)::integer rank, vec_id, score from scores)
select query_id, rank, vec_id, score from ranked where rank <= 10
"""
