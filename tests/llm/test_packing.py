"""Packing: ids as the tokenizer gives them, windows gapless and full, cases of odd rows."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from plumbline.llm import packing

PATH = packing.default_tokenizer()
WHOLE = Tokenizer.from_file(PATH)


def true_ids(text):
    return [*WHOLE.encode(text or "", add_special_tokens=False).ids, 2]


@pytest.mark.parametrize(
    "text",
    [
        "",
        "Plain words, it's they're we'LL 123 ½ x² µM ÀÉß",
        "tabs\tand\nlines\r\nand\x0bmore\x0c \x85 \xa0.",
        "odd\x1cones\x1dhere\x1e and\x1f",
        "ﬁne œuvre “quoted” Ünïcödé é ́x İstanbul ΣΑΣ 中文 ١٢ Ⅷ",
        "odd\x1c ωmega\x1f done",
        "<|endoftext|>a<|startoftext|> b",
        "!!!'s 's'' ''d don't",
        "a" * 300,
    ],
)
def test_ids(text):
    assert packing.encoder(PATH).ids(text, 2).tolist() == true_ids(text)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_ids_of_any_text(text):
    assert packing.encoder(PATH).ids(text, 2).tolist() == true_ids(text)


def check(rows, docs, capacity):
    """Pieces rebuild every document once; windows are gapless and need no padding."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for doc, text in docs.items():
        ids = np.array(true_ids(text), "<u4")
        pieces = sorted(by_doc.pop(doc), key=lambda r: r["start"])
        assert sum(r["length"] for r in pieces) == len(ids)
        at = 0
        for r in pieces:
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            own = ids[at : at + r["length"]]
            assert r["ids_crc32"] == zlib.crc32(own.tobytes())
            assert r["ids"] == own.tolist()
            at += r["length"]
    assert not by_doc
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at == capacity or at & (at - 1) == 0


def test_pieces(spark):
    rng = np.random.default_rng(3)
    docs = {i: " ".join(["word"] * int(n)) for i, n in enumerate(rng.integers(0, 90, 200))}
    docs |= {500: None, 501: "", 502: "long " * 1000, None: "no id"}
    frame = spark.createDataFrame(
        [(k, v, "x", 1) for k, v in docs.items()], "doc_id long, text string, start string, ids int"
    ).repartition(3)
    check(packing.pack(frame, capacity=64).collect(), docs, 64)


def test_repeated_rows_and_empty_table(spark):
    frame = spark.createDataFrame([(1, "a b")] * 3, "doc_id long, text string")
    assert sorted(r["length"] for r in packing.pack(frame).collect()) == [1, 1, 1, 3, 3] or (
        sum(r["length"] for r in packing.pack(frame).collect()) == 9
    )
    assert packing.pack(frame.limit(0)).collect() == []


def test_level_minimises_squares():
    w = packing.Windows(16)
    rng = np.random.default_rng(5)
    for _ in range(300):
        size = int(rng.integers(1, 17))
        chosen = w.level(size)

        def squares(h):
            n = w.counts.copy()
            if h:
                n[h] -= 1
            n[h + size] += 1
            return int((n[1:16] ** 2).sum())

        options = [0] + [h for h in range(1, 17 - size) if w.counts[h]]
        assert squares(chosen) == min(map(squares, options))
        w.place((0, 0, np.zeros(size, "<u4"), size))


def test_held_windows_are_bounded():
    w = packing.Windows(64, hold=200)
    for i in range(100):
        w.add(i, np.full(40, i, "<u4"))
        assert w.held <= 200
    w.drain()
    sizes = [sum(len(p[2]) for p in x) for x in w.take()]
    assert sum(sizes) == 4000 and packing.padding(np.array(sizes), 64) == 0
