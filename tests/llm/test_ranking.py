"""Ranked search against counting every document's terms in plain Python."""

from __future__ import annotations

import math
import re
from collections import Counter

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from plumbline.llm import ranking
from plumbline.llm.queries import op11_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(low)


def brute(docs, items, k=10):
    counted = [(d, Counter(terms_of(t))) for d, t in docs]
    n = sum(1 for _, c in counted if c)
    total = sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in sorted(set(items), key=str):
        scored = []
        for doc, c in counted:
            if c:
                m = 100 - 75 + (75 * c.total() * n) // total
                score = sum(
                    math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                    for t in terms_of(text)
                    if t in c
                )
                if score > 0:
                    scored.append((-score, doc is not None, doc))
        out += [(item, r, d, -s) for r, (s, _, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def found(spark, docs, items, **kwargs):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    return sorted((tuple(r) for r in ranking.search(d, i, **kwargs).collect()), key=str)


@settings(max_examples=200)
@given(st.text(alphabet="aAbZ09 .-\né ß", max_size=40))
def test_terms(text):
    line = ranking.guarded(text.encode())
    assert ranking.count_terms(line) == len(terms_of(text))
    block = ranking.Terms([text.encode()])
    names = {n: t for t, n in block.numbers.items()}
    assert [names[n].encode("latin-1").decode() for n in block.occurrences(line)] == terms_of(text)


def test_guards_keep_parts_of_words_apart():
    block = ranking.Terms([b"a ab b"])
    assert Counter(block.occurrences(ranking.guarded(b"ab abb a-a xb, b"))) == Counter(
        {block.numbers["ab"]: 1, block.numbers["a"]: 2, block.numbers["b"]: 1}
    )


DOCS = [
    *[(i, f"alpha beta {'gamma ' * (i % 5)} w{i % 7}") for i in range(40)],
    (41, None), (42, ""), (43, "..."), (None, "alpha gamma"), (5, "alpha beta gamma"), (5, "alpha beta gamma"),
    (44, "Alpha\tBETA, gamma! " * 3000),
]
ITEMS = [(1, "alpha gamma"), (1, "alpha gamma"), (1, "beta"), (2, None), (3, ""), (4, "unknown words"), (None, "w3 w3 gamma")]


@pytest.mark.parametrize("kwargs", [{}, {"k": 3}, {"block_items": 2}, {"block_bytes": 8}])
def test_against_brute_force_with_ties_nulls_and_blocks(spark, kwargs):
    assert found(spark, DOCS, ITEMS, **kwargs) == brute(DOCS, ITEMS, kwargs.get("k", 10))


def test_few_scores_held_at_once(spark, monkeypatch):
    monkeypatch.setattr(ranking, "CELLS", 1)
    state = ranking.Scores(ranking.Terms([b"a b"]), ranking.np.array([5, 7]), 3, 9, 2)
    for key, text in [(3, b"a"), (1, b"a"), (2, b"a b"), (4, None)]:
        state.add(key, text)
    state.settle()
    assert [e[2] for e in state.best[0]] == [2, 1]


def test_empty_tables_other_names_and_bad_bytes(spark):
    assert found(spark, [], ITEMS) == [] and found(spark, DOCS, []) == []
    docs = spark.sql("SELECT 7L AS id, CAST(unhex('61FF20FF') AS STRING) AS body, 'x' AS text, 1 AS score, 2 AS rank")
    items = spark.sql("SELECT 'q' AS name, CAST(unhex('FF') AS STRING) AS body, 5 AS doc_id")
    got = ranking.search(docs, items, key="id", text="body", item_key="name", item_text="body")
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert [tuple(r)[:3] for r in got.collect()] == [("q", 1, 7)]


def test_query_reads_whole_tables(spark, tmp_path):
    spark.createDataFrame(DOCS, "doc_id long, text string").withColumn("source", F.lit("s")).write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = sorted((tuple(r) for r in op11_search(spark, str(tmp_path)).collect()), key=str)
    assert got == brute(DOCS, ITEMS)
