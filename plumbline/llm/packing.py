"""Sum-of-squares packing of tokenised documents into windows.

A window of ``capacity`` tokens is open until it is full. ``counts[h]`` says how many open windows
are filled to level ``h``; a piece of ``s`` tokens goes to the level whose move to ``h + s`` leaves
the smallest sum of squared counts (a full window counts nothing). Windows left open when a task
ends fill one another up with cut pieces, and what is left at last is cut at powers of two, which
need no padding. Every task packs the rows of its own input partition, so nothing is shuffled and a
task that runs again makes the same windows.

Defined cases: a null or empty text is the end token alone; a repeated row is packed again; a null
``doc_id`` is kept; a text longer than a window gives whole windows and a rest; bytes that are no UTF-8 become U+FFFD; an empty table
gives no piece. Only the two named columns are read.
"""

from __future__ import annotations

import re
import zlib
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, types as T

from plumbline.llm.common import kind, mapped, strings, text_rows

#: Tokens that open windows may hold before they fill one another up.
HOLD = 4_000_000
#: Words whose ids a worker remembers, and the longest such word.
REMEMBER, LONGEST = 600_000, 64


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: Letters, numerals and white space below U+0100, and what the tokenizer takes as one word there.
LETTERS, NUMERALS, BLANKS = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
PIECE = re.compile(
    f"[{LETTERS}]+|'(?:s|t|re|ve|m|ll|d)|[{NUMERALS}]|[^{BLANKS}{LETTERS}{NUMERALS}]+"
)


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Pieces(dict):
    """Lower-cased word -> its ids as little-endian bytes, from the tokenizer's own model."""

    def __init__(self, tokenizer):
        super().__init__()
        self._ids = tokenizer.model.tokenize
        self._letters = byte_letters()

    def __missing__(self, word: str) -> bytes:
        spelt = word.encode().decode("latin-1").translate(self._letters)
        found = np.array([t.id for t in self._ids(spelt)], "<u4").tobytes()
        return remember(self, word, found)


class Chunks(dict):
    """Any run without white space -> its ids, from the whole tokenizer."""

    def __init__(self, tokenizer):
        super().__init__()
        self._encode = tokenizer.encode

    def __missing__(self, chunk: str) -> bytes:
        found = np.array(self._encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()
        return remember(self, chunk, found)


def remember(known: dict, word: str, ids: bytes) -> bytes:
    if len(word) <= LONGEST:
        if len(known) >= REMEMBER:
            known.clear()
        known[word] = ids
    return ids


class Encoder:
    """Ids of a text, word by word: the tokenizer never joins what white space parts.

    Texts below U+0100 need no normalisation but lower-casing, so their words are cut here and
    only unknown ones go to the model; all others are cut at white space and go through the whole
    tokenizer. Both give what the tokenizer gives for the whole text.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.pieces, self.chunks = Pieces(tokenizer), Chunks(tokenizer)
        self.special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]

    def ids(self, text: str, end: int) -> np.ndarray:
        try:
            text.encode("latin-1")
            plain = not any(s in text for s in self.special)
        except UnicodeEncodeError:
            plain = False
        if plain:
            parts = map(self.pieces.__getitem__, PIECE.findall(text.lower()))
        elif any(c in text for c in "\x1c\x1d\x1e\x1f"):
            # Python also splits at these four, which are no white space to the tokenizer
            parts = (
                self.chunks[w] for x in text.split("\n") for y in x.split("\t") for w in y.split(" ")
            )
        else:
            parts = map(self.chunks.__getitem__, text.split())
        return np.frombuffer(b"".join(parts) + end.to_bytes(4, "little"), "<u4")


@cache
def encoder(path: str) -> Encoder:
    """One for each worker, so that tasks after the first find words known."""
    return Encoder(path)


class Windows:
    """The open windows of one task.

    A piece is (document, start, ids, tokens of the document); a window is (tokens, pieces).
    """

    def __init__(self, capacity: int, hold: int = HOLD):
        self.capacity, self.hold = capacity, hold
        self.counts = np.zeros(capacity + 1, np.int64)
        self.at: dict[int, list[list]] = {}
        self.held = 0
        self.full: list[list] = []

    def level(self, size: int) -> int:
        """The level of the window that takes a piece of this size; 0 opens one."""
        c, n = self.capacity, self.counts
        open_ = np.flatnonzero(n[1 : c - size + 1]) + 1
        after = 2 * n[size : c + 1] + 1
        if size <= c:
            after[-1] = 0
        if not len(open_):
            return 0
        cost = after[open_] - 2 * n[open_] + 1
        best = len(cost) - 1 - int(np.argmin(cost[::-1]))
        return int(open_[best]) if cost[best] <= after[0] else 0

    def place(self, piece: tuple) -> None:
        size = len(piece[2])
        h = self.level(size)
        if h:
            window = self.at[h].pop()
            self.counts[h] -= 1
        else:
            window = []
        window.append(piece)
        if h + size == self.capacity:
            self.held -= h
            self.full.append(window)
        else:
            self.at.setdefault(h + size, []).append(window)
            self.counts[h + size] += 1
            self.held += size
            if self.held > self.hold:
                self.drain()

    def add(self, doc_id, ids: np.ndarray) -> None:
        n = len(ids)
        for start in range(0, n, self.capacity):
            self.place((doc_id, start, ids[start : start + self.capacity], n))

    def drain(self) -> None:
        """Fill the open windows up, the fullest first, with pieces from the emptiest."""
        rest = [w for h in sorted(self.at) for w in self.at[h]]
        self.at, self.held = {}, 0
        self.counts[:] = 0
        low = 0
        while low < len(rest):
            window = rest.pop()
            room = self.capacity - sum(len(p[2]) for p in window)
            while room and low < len(rest):
                doc, start, ids, n = rest[low].pop()
                if len(ids) > room:
                    rest[low].append((doc, start, ids[:-room], n))
                    start, ids = start + len(ids) - room, ids[-room:]
                window.append((doc, start, ids, n))
                room -= len(ids)
                if not rest[low]:
                    low += 1
            if not room:
                self.full.append(window)
                continue
            size = self.capacity - room
            for bit in reversed(range(size.bit_length())):
                if size >> bit & 1:
                    part, window = split(window, 1 << bit)
                    self.full.append(part)

    def take(self) -> list[list]:
        full, self.full = self.full, []
        return full


def split(window: list, size: int) -> tuple[list, list]:
    """The first ``size`` tokens of a window and its rest."""
    head, tail = [], []
    for doc, start, ids, n in window:
        here = min(size, len(ids))
        if here:
            head.append((doc, start, ids[:here], n))
        if here < len(ids):
            tail.append((doc, start + here, ids[here:], n))
        size -= here
    return head, tail


def pack(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = 4096,
    end: int = 2,
    tokenizer: str | None = None,
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: its document, where it starts there, its ids, its window and place in it."""
    path = tokenizer or default_tokenizer()
    key_type = kind(docs, key)
    fields = [
        T.StructField("doc_id", key_type),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
    ]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    schema = T.StructType(fields)

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        words, windows = encoder(path), Windows(capacity)
        sequence = TaskContext.get().partitionId() << 32

        def rows(full):
            nonlocal sequence
            made = []
            for window in full:
                offset = 0
                for doc, start, ids, n in window:
                    row = (doc, start, len(ids), zlib.crc32(ids.tobytes()), n, sequence, offset)
                    made.append((*row, ids.astype(np.int32)) if with_ids else row)
                    offset += len(ids)
                sequence += 1
            columns = [pa.array(c, type=f.type) for c, f in zip(zip(*made), arrow)]
            return pa.RecordBatch.from_arrays(columns, schema=arrow)

        for batch in batches:
            for doc, value in zip(strings(batch.column(0)), strings(batch.column(1))):
                windows.add(doc, words.ids(value or "", end))
                if len(windows.full) >= 256:
                    yield rows(windows.take())
        windows.drain()
        if windows.full:
            yield rows(windows.take())

    return mapped(text_rows(docs, key, text)).mapInArrow(run, schema)


def padding(sizes: np.ndarray, capacity: int = 4096) -> int:
    """Tokens of padding that windows of these sizes need: none at a power of two, else up to the capacity."""
    sizes = np.asarray(sizes, np.int64)
    return int(np.where((sizes & (sizes - 1)) == 0, 0, capacity - sizes).sum())
