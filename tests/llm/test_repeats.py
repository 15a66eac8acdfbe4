"""Repeated passages against a dictionary of every window."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from plumbline.llm import repeats


def brute(docs, length):
    """doc -> (bytes, removed, spans, digest), windows taken in order of id and place."""
    seen, out = {}, {}
    for key, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        raw = (text or "").encode()
        hit = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if seen.setdefault(raw[i : i + length], (key, i)) != (key, i):
                hit[i : i + length] = b"\x01" * length
        kept = bytes(b for b, h in zip(raw, hit) if not h)
        spans = sum(1 for i, h in enumerate(hit) if h and (i == 0 or not hit[i - 1]))
        out[key] = (len(raw), sum(hit), spans, hashlib.sha256(kept).hexdigest())
    return out


def passages(seed, n):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdeé ") for _ in range(rnd.randint(1, 9)))
    text = lambda k: " ".join(word() for _ in range(k))
    shared = [text(30) for _ in range(6)]
    docs = []
    for i in range(n):
        kind = rnd.random()
        if kind < 0.2 and docs:
            docs.append(docs[rnd.randrange(len(docs))])
        elif kind < 0.5 and docs:
            old = docs[rnd.randrange(len(docs))]
            at = rnd.randrange(len(old) + 1)
            docs.append(old[:at] + word() + old[at + rnd.randint(0, 5) :])
        else:
            docs.append(" ".join([text(rnd.randint(0, 60)), rnd.choice(shared), text(rnd.randint(0, 60))]))
    return docs


def letters(seed, n):
    return "".join(random.Random(seed).choices("abcdefgh ", k=n))


CASES = ["", None, "a" * 500, "ab" * 300, "x" * 99, "x" * 100, "x" * 101, "of the " * 90, "é" * 77]


def result(frame, **options):
    return {
        r["doc_id"]: (r["n_bytes"], r["n_removed"], len(r["spans"]), r["kept_sha256"])
        for r in repeats.remove_repeats(frame, **options).collect()
    }


@pytest.mark.parametrize("group", [4000, 2])
def test_against_every_window(spark, group, monkeypatch):
    docs = list(enumerate(passages(1, 150) + CASES)) + [(None, passages(2, 3)[-1])]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    rows = frame.selectExpr("doc_id doc", "text").selectExpr("doc", "xxhash64(text) tie", "text")
    if group == 2:
        monkeypatch.setattr(repeats.repeated_spans, "__defaults__", (100, 2))
    assert result(frame) == brute(docs, 100)
    assert rows.count() == len(docs)


def test_blocks_of_long_texts(spark, monkeypatch):
    text = letters(4, 5000)
    docs = [(1, text), (2, text[300:2900]), (3, "q" + text)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert result(frame) == brute(docs, 100)


def test_blocks_do_not_change_anchored_windows():
    text = letters(4, 5000).encode()
    whole = [w for a in [repeats.anchors([text])] for w in zip(*(x.tolist() for x in a[1:3]))]
    assert sum(n for _, n in whole) == 5000 - 99
    old = repeats.BLOCK
    try:
        repeats.BLOCK = 700
        parts = list(repeats.segments([text], 100))
        covered = sorted(
            (place[t] + f + i)
            for _, place, ps in parts
            for t, f, n in zip(*(x.tolist() for x in repeats.anchors(ps)[:3]))
            for i in range(n)
        )
    finally:
        repeats.BLOCK = old
    assert covered == list(range(5000 - 99))


def test_multikey_groups():
    rnd = np.random.default_rng(1)
    raw = bytes(rnd.integers(97, 99, 3000).astype(np.uint8)) * 2
    starts = np.arange(0, len(raw) - 64)
    group = repeats.multikey(repeats.eights(raw + bytes(8)), starts, 20)
    by = {}
    for s, g in zip(starts.tolist(), group.tolist()):
        assert by.setdefault(raw[s : s + 20], g) == g
    assert len(set(by.values())) == len(by)


def test_repeated_rows_and_ties(spark):
    text = passages(3, 1)[0] * 2
    frame = spark.createDataFrame([(1, text), (1, text), (1, "other " + text), (2, text)], "doc_id long, text string")
    rows = [(r["doc_id"], r["n_bytes"], r["n_removed"]) for r in repeats.remove_repeats(frame).collect()]
    size = len(text.encode())
    assert len(rows) == 4 and rows.count((2, size, size)) == 1
    same = [r for r in rows if r[:2] == (1, size)]
    assert len(same) == 2 and same[0] == same[1]


def test_equal_rows_gather_their_places_once(spark, monkeypatch):
    text = " ".join(passages(6, 4))
    frame = spark.createDataFrame([(0, text)] + [(1, text)] * 40, "doc_id long, text string").repartition(4)
    seen, map_batches = [], repeats.map_batches
    monkeypatch.setattr(repeats, "map_batches", lambda df, *a, **k: (seen.append(df), map_batches(df, *a, **k))[1])
    rows = repeats.remove_repeats(frame).collect()
    assert [r["n_removed"] for r in rows if r["doc_id"] == 1] == [len(text.encode())] * 40
    for df in (x for x in seen if "own" in x.columns):
        for r in df.collect():
            assert len(r["own"] or ()) == len(set(r["own"] or ()))


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id string, text string, tie int, own int")
    assert repeats.remove_repeats(frame).collect() == []


def test_texts_of_ids(spark):
    docs = [("b", "w" * 50 + "z" * 200), ("a", "z" * 200)]
    frame = spark.createDataFrame(docs, "doc_id string, text string")
    found = {r["doc_id"]: r["n_removed"] for r in repeats.remove_repeats(frame).collect()}
    assert found == {"a": 199 + 0, "b": 200} or found["b"] == 200


@pytest.mark.parametrize("length", [64, 288, 400, 900])
def test_other_lengths(spark, length):
    text = letters(9, 3000)
    docs = [(1, text), (2, text), (3, text[500:2000] + "!" + text[100:1200]), (4, "ab" * 1000)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert result(frame, length=length) == brute(docs, length)


def test_lengths_that_do_not_fit_are_refused(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    for length in (63, 1 << 16):
        with pytest.raises(ValueError):
            repeats.remove_repeats(frame, length=length)


@pytest.mark.parametrize("sent", [100_000, 0])
def test_equal_rows_are_anchored_once(spark, sent, monkeypatch):
    monkeypatch.setattr(repeats, "SENT", sent)
    text = letters(8, 600)
    rows = [(1, text)] * 50 + [(2, text[100:500])] * 20 + [(None, None)] * 3
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    own = frame.selectExpr("doc_id doc", "text").selectExpr("doc", "xxhash64(text) tie", "text")
    assert repeats._once(own).count() == 3
    found = repeats.remove_repeats(frame).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in found) == [(0, 0)] * 3 + [(1, 0)] * 50 + [(2, 400)] * 20
