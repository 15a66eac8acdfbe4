"""Very long texts, extra columns whose names clash, and repeated rows, for operators tested elsewhere on small ones."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from plumbline.llm import decontamination, html_text, lines, quality, repeats, secrets, simhash

WORDS = [f"word{i}" for i in range(5000)]


@pytest.fixture(scope="module")
def long_text():
    rnd = random.Random(21)
    return "\n".join(" ".join(rnd.choices(WORDS, k=12)) for _ in range(20_000))  # about 2 MB


@pytest.fixture(scope="module")
def docs(spark, long_text):
    item = " ".join(f"item{i}" for i in range(12))
    rows = [(1, long_text), (2, long_text + "\n" + item), (3, 'password="Tr0ub4dor&3" ' + long_text), (4, "short")]
    return spark.createDataFrame(rows, "doc_id long, text string").withColumn("source", F.lit("s"))


def test_decontamination(spark, docs):
    items = spark.createDataFrame([(7, " ".join(f"item{i}" for i in range(12)))], "item_id long, text string")
    found = {r.doc_id: (r.n_words, r.n_hit) for r in decontamination.decontaminate(docs, items).collect()}
    assert found[1] == (240_000, 0) and found[2] == (240_012, 12) and found[4] == (1, 0)


def test_quality(docs):
    found = {r.doc_id: r for r in quality.assess(docs).collect()}
    assert found[1].n_words == 240_000 and found[1].kept and not found[4].kept
    assert {r.doc_id for r in quality.keep_good(docs).collect()} == {1, 2, 3}


def test_secrets(docs):
    assert [r.candidate for r in secrets.candidates(docs).collect()] == ["Tr0ub4dor&3"]


def test_lines(docs):
    found = {r.doc_id: (r.n_lines, r.n_deleted) for r in lines.line_report(docs).collect()}
    assert found == {1: (20_000, 0), 2: (20_001, 20_000), 3: (20_000, 19_999), 4: (1, 0)}


def test_repeats_with_clashing_names(docs, long_text):
    clashing = docs.withColumns({n: F.lit(1) for n in ("tie", "own", "doc", "begin", "lead", "context", "at")})
    found = {r.doc_id: r.n_removed for r in repeats.remove_repeats(clashing, with_text=False).collect()}
    n = len(long_text)
    assert found[1] == found[4] == 0 and found[2] == found[3] == n


def test_simhash(docs):
    assert len({r.fingerprint for r in simhash.near_duplicates(docs).where("doc_id < 4").collect()}) <= 3


def test_pages(spark, long_text):
    body = "".join(f"<p>{x}</p>" for x in long_text.split("\n"))
    rows = [(1, "u", f"<article>{body}</article>")] * 2 + [(2, "v", None)]
    found = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((r.page_id, r.n_chars) for r in found) == [(1, len(long_text))] * 2 + [(2, 0)]
    assert found[0].text == long_text or found[1].text == long_text
