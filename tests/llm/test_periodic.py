"""Periodic runs against a search for every period, and the query against the contract done in plain Python."""

from __future__ import annotations

import hashlib
import zlib
from fractions import Fraction

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from plumbline.llm.periodic import find_runs, runs_by_document
from plumbline.llm.queries import op13_periodic_runs


def brute(words, min_length=24, min_periods=3):
    """Every stretch of equal words a period apart, for every period; the shortest period of each."""
    n, found = len(words), {}
    for q in range(1, n // min_periods + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(min_length, min_periods * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i) + 1
    return sorted((s, length, q) for (s, length), q in found.items())


@st.composite
def texts(draw):
    alphabet = draw(st.integers(1, 4))
    words = draw(st.lists(st.integers(0, alphabet - 1), max_size=60))
    for _ in range(draw(st.integers(0, 2))):
        p = draw(st.integers(1, 12))
        words += (words[-p:] or [0]) * draw(st.integers(2, 8))
    return [b"w%d" % w for w in words]


@settings(max_examples=300, deadline=None)
@given(st.lists(texts(), max_size=4), st.sampled_from([(24, 3), (1, 2), (6, 2), (4, 3)]))
def test_runs_of_any_documents(documents, limits):
    assert runs_by_document(documents, *limits) == [brute(w, *limits) for w in documents]


@pytest.mark.parametrize("words", [[b"a"] * 300_000, [b"%d" % (i % 999) for i in range(300_000)]])
def test_very_long_texts(words):
    assert runs_by_document([words]) == [[(0, 300_000, len(set(words)))]]


def expected(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (
        doc_id,
        len(runs),
        *best,
        1000 * best[1] // best[2] if runs else None,
        hashlib.sha256(listed.encode()).hexdigest(),
        hashlib.sha256(kept).hexdigest(),
    )


def test_query_against_the_contract(spark):
    folder = "/root/testdata/sf0.001"
    found = sorted(tuple(r) for r in op13_periodic_runs(spark, folder).collect())
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert found == sorted(expected(*r) for r in rows)
    assert any(r[1] for r in found)


def test_query_on_edge_cases(spark, tmp_path):
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0][:6]
    texts = [None, "", " \t\n", "one", "a b " * 40, "x " * 9 + "y"]
    rows = [(i, t) for i, t in zip(ids, texts)] + [(7, None), (8, ""), (9, "p q r " * 20), (9, "p q r " * 20)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = [tuple(r) for r in op13_periodic_runs(spark, str(tmp_path)).collect()]
    key = lambda r: (r[0], str(r))
    assert sorted(found, key=key) == sorted((expected(*r) for r in rows), key=key)


def test_operator_keeps_texts_and_defined_cases(spark):
    rows = [(1, None), (2, ""), (3, "a b c " * 10 + "d"), (3, "a b c " * 10 + "d"), (None, "z")]
    docs = spark.createDataFrame(rows, "id long, body string").select("*", F.lit(1).alias("runs"), F.lit("x").alias("doc_id"))
    found = find_runs(docs, key="id", text="body")
    assert found.columns == ["doc_id", "n_words", "runs", "collapsed"]
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in found.collect()), key=str)
    assert got == sorted(
        [(1, 0, [], ""), (2, 0, [], ""), (None, 1, [], "z"), *[(3, 31, [(0, 30, 3)], "a b c d")] * 2], key=str
    )
    assert find_runs(docs.limit(0), key="id", text="body").count() == 0
    bad = docs.limit(0).select("id", "body").union(
        spark.sql("SELECT 5L, CAST(unhex(repeat('FF20', 30)) AS STRING)")
    )
    assert [tuple(x) for x in find_runs(bad, key="id", text="body").first().runs] == [(0, 30, 1)]
    with pytest.raises(ValueError):
        find_runs(docs, key="id", text="body", min_periods=1)
