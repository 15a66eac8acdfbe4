"""Benchmark decontamination with a generalised suffix automaton.

The automaton holds every run of words of the test items. A task streams the words of a document
through it and knows after each word the length of the longest run that ends there and occurs in an
item. Where that length reaches the window, the window's words are hit; an item shorter than the
window is itself one. Runs of words that no item contains are passed over without touching the
automaton.

Items are read in blocks of at most ``block_words`` words; each block's automaton is broadcast, and a
document meets the blocks one after the other in the same pass. All of them are in every worker's memory,
so the items are measured first: more than ``MAX_BYTES`` of text are refused.

Words are runs of ASCII letters, digits and all characters beyond ASCII, with A-Z lower-cased.

Defined cases: a null or empty text has no words and is clean; a null item has none and matches
nothing; an item with a null key hits like any other, and all such items together are one null among a
document's items: ``n_items`` counts it as one, ``items_sha256`` passes over it; repeated items all
count, those of one key and different texts too; repeated rows of documents each give a row; an empty
benchmark leaves all clean; other columns of either table are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from plumbline.llm.common import OWN, kind, map_batches, text_rows

#: Fixed by the contract: what parts words, beside the lower-casing of A-Z.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Words of one block of items; an automaton has at most twice as many states.
BLOCK_WORDS = 1_000_000
#: Bytes of all items together; their automata go to every worker.
MAX_BYTES = 64_000_000


def words_of(text: str | None) -> list[bytes]:
    return WORD.findall(text.encode().lower()) if text else []


class Automaton:
    """Generalised suffix automaton of word sequences, with what a hit needs to know per state."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        runs = []
        for name, words in items:
            if words:
                ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
                runs.append((name, ids))
                last = 0
                for c in ids:
                    last = self._extend(last, c)
        self.shortest = min((min(window, len(ids)) for _, ids in runs), default=window)
        self._name(runs)

    def _clone(self, p: int, q: int, c: int) -> int:
        twin = len(self.next)
        self.next.append(dict(self.next[q]))
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        self.link[q] = twin
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = twin
            p = self.link[p]
        return twin

    def _extend(self, last: int, c: int) -> int:
        q = self.next[last].get(c)
        if q is not None:  # the run is known from an earlier item
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, q, c)
        new = len(self.next)
        self.next.append({})
        self.length.append(self.length[last] + 1)
        self.link.append(0)
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._clone(p, q, c)
        return new

    def _step(self, state: int, length: int, c: int) -> tuple[int, int]:
        while state and c not in self.next[state]:
            state = self.link[state]
            length = self.length[state]
        state = self.next[state].get(c, 0)
        return state, length + 1 if state else 0

    def _whole(self, state: int) -> int:
        """The ancestor whose runs include the one of window length."""
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def _name(self, runs: list[tuple[str | None, list[int]]]) -> None:
        """Which items a window at a state means: whole windows, and items shorter than one."""
        self.items: dict[int, set[str | None]] = {}
        short: dict[int, set[tuple[str | None, int]]] = {}
        for name, ids in runs:
            state = length = 0
            for c in ids:
                state, length = self._step(state, length, c)
                if length >= self.window:
                    self.items.setdefault(self._whole(state), set()).add(name)
            if len(ids) < self.window:
                short.setdefault(state, set()).add((name, len(ids)))
        #: state -> the short items that end wherever the state's runs do
        self.short: dict[int, set[tuple[str | None, int]]] = {}
        if short:
            for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
                above = self.short.get(self.link[state], set())
                own = short.get(state, set())
                if above or own:
                    self.short[state] = above | own if own else above

    def hits(self, words: list[bytes], mask: bytearray, found: set[str | None]) -> None:
        """Mark the hit words and add the items that occur."""
        flags = bytes(map(self.vocabulary.__contains__, words))
        for run in re.finditer(rb"\x01{%d,}" % self.shortest, flags):
            state = length = 0
            for i in range(run.start(), run.end()):
                state, length = self._step(state, length, self.vocabulary[words[i]])
                reach = 0
                if length >= self.window:
                    reach = self.window
                    found |= self.items[self._whole(state)]
                for name, size in self.short.get(state, ()):
                    if size <= length:
                        reach = max(reach, size)
                        found.add(name)
                if reach:
                    mask[i + 1 - reach : i + 1] = b"\x01" * reach


def blocks(items: DataFrame, key: str, text: str, size: int) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    """The items in order of their names, a bounded block at a time."""
    rows = items.select(
        F.col(key).cast("string").alias("item"), F.col(text).cast("string").alias("text")
    ).where("text IS NOT NULL")
    block, n = [], 0
    for row in rows.toLocalIterator():
        words = words_of(row["text"])
        if block and n + len(words) > size:
            yield block
            block, n = [], 0
        block.append((row["item"], words))
        n += len(words)
    if block:
        yield block


def sent(docs: DataFrame, items: DataFrame, key: str, text: str, window: int, size: int) -> list:
    """The blocks' automata, broadcast one by one as the items come in."""
    size_of = items.agg(F.coalesce(F.sum(F.octet_length(F.col(text).cast("string"))), F.lit(0))).first()[0]
    if size_of > MAX_BYTES:
        raise ValueError(f"the items have {size_of} bytes, automata of more than {MAX_BYTES} are not sent out")
    context = docs.sparkSession.sparkContext
    return [context.broadcast(Automaton(b, window)) for b in blocks(items, key, text, size)]


def matcher(automata: list):
    """Words -> mask of the hit ones and names of the items, over all blocks."""

    def match(words: list[bytes]) -> tuple[bytearray, set[str | None]]:
        mask, found = bytearray(len(words)), set()
        for a in automata:
            a.value.hits(words, mask, found)
        return mask, found

    return match


def spans_of(mask: bytearray) -> list[tuple[int, int]]:
    return [m.span() for m in re.finditer(rb"\x01+", bytes(mask))]


def cleaned(text: str, limit: float, match) -> str | None:
    """The text without hit spans, until none is left; None where they cover more than the limit."""
    total, removed = len(words_of(text)), 0
    while True:
        raw = text.encode()
        places = [m.span() for m in WORD.finditer(raw.lower())]
        spans = spans_of(match([raw[a:b].lower() for a, b in places])[0])
        removed += sum(b - a for a, b in spans)
        if not spans:
            return text
        if removed > limit * total:
            return None
        parts, at = [], 0
        for a, b in spans:
            parts.append(raw[at : places[a][0]])
            at = places[b - 1][1]
        text = b"".join([*parts, raw[at:]]).decode()


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    window: int = 10,
    max_coverage: float = 0.5,
    block_words: int = BLOCK_WORDS,
    with_text: bool = True,
) -> DataFrame:
    """One row per document: its words, hit words, hit spans (first word, words), items, and its cleaned text.

    ``clean_text`` is null where the spans cover more than ``max_coverage`` of the words (and where
    the text is null).
    """
    automata = sent(docs, items, item_key, item_text, window, block_words)
    schema = T.StructType(
        [
            T.StructField("doc_id", kind(docs, key)),
            T.StructField("n_words", T.LongType()),
            T.StructField("n_hit", T.LongType()),
            T.StructField("item_ids", T.ArrayType(T.StringType())),
            T.StructField(
                "spans",
                T.ArrayType(
                    T.StructType(
                        [T.StructField("word", T.LongType()), T.StructField("words", T.LongType())]
                    )
                ),
            ),
            T.StructField("contaminated", T.BooleanType()),
            *([T.StructField("clean_text", T.StringType())] if with_text else []),
        ]
    )

    def make():
        match = matcher(automata)

        def work(batch):
            out = {f.name: [] for f in schema}
            out["doc_id"] = batch.column(0)
            for value in batch.column(1):
                value = value.as_py()
                words = words_of(value)
                mask, found = match(words)
                n = mask.count(1)
                out["n_words"].append(len(words))
                out["n_hit"].append(n)
                out["item_ids"].append(sorted(found, key=lambda x: (x is None, x or "")))
                out["spans"].append([{"word": a, "words": b - a} for a, b in spans_of(mask)])
                out["contaminated"].append(n > 0)
                if with_text:
                    out["clean_text"].append(cleaned(value, max_coverage, match) if n else value)
            return out

        return work

    return map_batches(text_rows(docs, key, text), make, schema)


def remove_contamination(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    window: int = 10,
    max_coverage: float = 0.5,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The documents with hit spans cut out; those that consist mostly of them go.

    Columns and all other documents stay as they are, rows with a null text too.
    """
    key = OWN + "key"
    automata = sent(docs, items, item_key, item_text, window, block_words)
    place = [c.lower() for c in docs.columns].index(text.lower())
    schema = T.StructType([*docs.schema.fields, T.StructField(key, T.BooleanType())])

    def make():
        match = matcher(automata)

        def work(batch):
            texts, keep = [], []
            for value in batch.column(place):
                value = value.as_py()
                words = words_of(value)
                new = value
                if words and 1 in match(words)[0]:
                    new = cleaned(value, max_coverage, match)
                texts.append(new)
                keep.append(value is None or new is not None)
            columns = {f"{i}": c for i, c in enumerate(batch.columns)}
            columns[f"{place}"] = pa.array(texts, type=batch.schema.field(place).type)
            columns[f"{len(batch.columns)}"] = np.array(keep)
            return columns

        return work

    numbered = T.StructType(
        [T.StructField(f"{i}", f.dataType, f.nullable) for i, f in enumerate(schema)]
    )
    out = map_batches(docs, make, numbered).toDF(*schema.names)
    return out.where(F.col(key)).drop(key)
