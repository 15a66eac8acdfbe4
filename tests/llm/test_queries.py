"""Registered operator queries over the given tables: contract columns, and DuckDB where SQL can state them."""

from __future__ import annotations

import pytest

from plumbline.llm.queries import ORACLES, QUERIES
from tests.oracle import connect, duck_rows, spark_rows

COLUMNS = {
    "op1_simhash": ["doc_id", "fingerprint", "component_id"],
    "op2_decontamination": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op3_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op4_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op5_language": ["doc_id", "held_out", "lang_pred", "score"],
    "op6_secrets": ["doc_id", "nth", "candidate_sha256"],
    "op7_html": ["page_id", "url", "text", "n_chars"],
    "op8_packing": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op9_repeats": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op10_lines": ["doc_id", "n_lines", "n_deleted", "kept_sha256"],
    "op11_search": ["item_id", "rank", "doc_id", "score"],
    "op12_warc": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op13_periodic_runs": [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256",
    ],
}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, sf_dir, name):
    assert spark_rows(QUERIES[name](spark, sf_dir)) == duck_rows(connect(sf_dir), ORACLES[name])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns_and_rows(spark, name):
    folder = "/root/testdata/sf0.001"
    found = QUERIES[name](spark, folder)
    assert found.columns[: len(COLUMNS[name])] == COLUMNS[name]
    source = "pages" if name in ("op7_html", "op12_warc") else "documents"
    rows = spark.read.parquet(f"{folder}/{source}.parquet").count()
    if name not in ("op6_secrets", "op8_packing", "op11_search"):
        assert found.count() == rows
    else:
        assert found.select("doc_id").distinct().count() <= rows
