"""Bytes that are no UTF-8, in texts, keys and other columns: every operator and stage gives every row a result."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from plumbline.llm.queries import QUERIES

WORDS = "these are some plain words of a text that goes on for a while and says little that is new to anyone here"
BAD = "concat('{}', CAST(unhex('FFC328') AS STRING), ' {}')"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("bytes"))
    docs = spark.range(12).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.expr(BAD.format(WORDS, "and then password = abcdef0123456789")))
        .otherwise(F.concat(F.lit(WORDS + " number "), F.col("id").cast("string")))
        .alias("text"),
        F.when(F.col("id") % 2 == 0, "en").otherwise("de").alias("lang"),
        F.expr("CAST(unhex('FE') AS STRING)").alias("source"),
        F.lit(1).cast("long").alias("n_chars"),
    )
    docs.write.parquet(f"{base}/documents.parquet")
    docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"), (F.col("doc_id") % 2).cast("int").alias("toxic")).write.parquet(
        f"{base}/labels.parquet"
    )
    docs.select(F.col("doc_id").alias("item_id"), F.expr(BAD.format("some item", "of its own")).alias("text")).limit(2).write.parquet(
        f"{base}/benchmark.parquet"
    )
    docs.select(
        F.col("doc_id").alias("page_id"), F.col("source").alias("url"), F.concat(F.lit("<p>"), "text").alias("html")
    ).write.parquet(f"{base}/pages.parquet")
    return base


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries(spark, folder, name):
    found = QUERIES[name](spark, folder).collect()
    if name not in ("op6_secrets", "op8_packing", "op11_search"):
        assert len(found) == 12
    assert found or name == "op6_secrets"
    if name == "op9_repeats":  # the bytes themselves are kept
        first = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id = 0").select(F.expr("CAST(text AS BINARY)")).first()[0]
        assert next(r.kept_sha256 for r in found if r.doc_id == 0) == hashlib.sha256(bytes(first)).hexdigest()


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages(spark, folder, name, stage):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = stage(spark, docs, folder).collect()
    assert {r.doc_id for r in found} >= {1}
