"""The registered queries: those with SQL against it, all with their columns."""
import pytest

import __spark_entry__ as entry
import check
from factorspark.llm import queries

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_vectors": ["vec_id", "n_links", "component_id", "kept"], "op2_main_text": ["page_id", "url", "text", "n_chars"],
    "op3_simhash": ["doc_id", "fingerprint", "component_id"], "op4_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op5_url_filter": ["page_id", "host", "path", "rule", "verdict"], "op6_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op7_packing": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"], "op8_top_k": ["query_id", "rank", "vec_id", "score"],
    "op9_language": ["doc_id", "held_out", "lang_pred", "score"],
    "op11_clusters": ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"],
    "op12_whitening": ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
    "op13_licenses": ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"], "op10_quality": ["doc_id", "held_out", "score", "predicted"],
}


def test_all_are_registered():
    assert set(COLUMNS) | {"pipeline"} <= set(entry.queries())
    assert set(queries.ORACLES) == {"op1_vectors", "op8_top_k", "op11_clusters", "op13_licenses"}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_oracle(spark, name):
    ok, note = check.compare(spark, check.connect(SF), name, SF)
    assert ok, note


@pytest.mark.parametrize("name", sorted(set(COLUMNS) - set(queries.ORACLES)))
def test_query_rows(spark, name):
    df = entry.queries()[name](spark, SF)
    assert df.columns == COLUMNS[name]
    source = "pages" if name in ("op2_main_text", "op5_url_filter") else "embeddings" if name == "op12_whitening" else "documents"
    n = spark.read.parquet(f"{SF}/{source}.parquet").count()
    n *= 32 if name == "op12_whitening" else 1
    assert df.count() == n if name != "op7_packing" else df.select("doc_id").distinct().count() == n
