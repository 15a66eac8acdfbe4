"""Ranked lexical search by scanning documents with an Aho-Corasick automaton of the items' terms.

There is no index of documents. All terms of the items, each between two guards (blanks), form one
automaton, which is broadcast; a document's bytes, with every character that parts terms turned into
a guard, run through it once and each output is an occurrence of a whole term. A term's output maps
to the items that hold it, with how often.

Two scans: the first counts documents, terms and in how many documents each term stands; the second
scores. A task of the second keeps, item by item, the best ``k`` documents it has met, so a task
gives at most ``k`` rows an item to the final ranking however many documents it scans.

Items are taken in blocks whose texts have at most ``block_bytes`` together and which number at most
``block_items`` (a longer text is a block by itself), so that what is broadcast and what a task holds
is bounded whatever the benchmark's size; each block scans the documents by itself.

A term is a run of ASCII letters, digits and all bytes beyond ASCII, with A-Z lower-cased. With N
documents that have a term, L terms in all, n terms in a document, df documents with the term and tf
occurrences in the document: w = floor(1000 ln((2N + 2) / (2df + 1))), m = 25 + (75 n N) div L, and the
score is the sum of w * ((10^9 tf) div (1000 tf + 8 m)) over the item's terms, repeats included.

Defined cases: a null or empty text has no terms, as a document it is never found, as an item it finds
nothing and has no row; a document of a null key is ranked before the others of its score; an item
of a null key is an item of its own; equal rows of items are one item, rows of one key and different
texts are an item each; every row of documents counts, equal ones too, and takes a rank of its own;
an empty table on either side gives no rows; bytes that are no UTF-8 are part of terms as they
are; other columns of either table are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import reduce
from operator import itemgetter

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame, Window, functions as F, types as T

from plumbline.llm.common import OWN, kind, map_batches, raw, strings, text_rows

#: Bytes of the texts of one block of items, and items of one block.
BLOCK_BYTES = 32_000_000
BLOCK_ITEMS = 20_000
#: Scores and postings held at once: a stretch of documents times the items, and their terms' postings.
CELLS = 1_000_000

#: Fixed by the contract: ASCII letters and digits and all bytes beyond ASCII make terms.
TABLE = bytes(
    ord(chr(b).lower()) if chr(b).isascii() and chr(b).isalnum() else b if b > 0x7F else 0x20
    for b in range(256)
)
GUARD = " "
VALUE = itemgetter(1)


def guarded(text: bytes | None) -> str:
    """The text between guards, each byte one character; every byte that parts terms is a guard."""
    return f"{GUARD}{(text or b'').translate(TABLE).decode('latin-1')}{GUARD}"


def count_terms(line: str) -> int:
    """Terms of a guarded text: places where a guard is followed by something else."""
    inside = np.frombuffer(line.encode("latin-1"), np.uint8) != 0x20
    return int(np.count_nonzero(inside[1:] & ~inside[:-1]))


class Terms:
    """The automaton of a block of items, and from each of its outputs to items."""

    def __init__(self, texts: list[bytes | None]):
        self.numbers: dict[str, int] = {}
        held: list[list[tuple[int, int]]] = []
        for item, text in enumerate(texts):
            for term, times in Counter(guarded(text).split(GUARD)).items():
                if term:
                    number = self.numbers.setdefault(term, len(self.numbers))
                    if number == len(held):
                        held.append([])
                    held[number].append((item, times))
        self.items = len(texts)
        #: of term number t the postings first[t] .. first[t + 1]: item and how often it has the term
        self.first = np.cumsum([0, *map(len, held)])
        self.item = np.array([i for h in held for i, _ in h], np.int64)
        self.times = np.array([t for h in held for _, t in h], np.int64)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for term, number in self.numbers.items():
            self.automaton.add_word(f"{GUARD}{term}{GUARD}", number)
        if self.numbers:
            self.automaton.make_automaton()

    def __len__(self) -> int:
        return len(self.numbers)

    def occurrences(self, line: str):
        """The number of each term of a guarded text that an item holds, in order."""
        return map(VALUE, self.automaton.iter(line)) if self.numbers else iter(())


def term_statistics(docs: DataFrame, terms) -> DataFrame:
    """``term, n``: documents that hold a term; under -1 documents with any term, under -2 all terms."""
    schema = T.StructType([T.StructField("term", T.IntegerType()), T.StructField("n", T.LongType())])

    def make():
        block: Terms = terms.value
        holding = np.zeros(len(block) + 2, np.int64)

        def work(batch):
            if batch is None:
                met = np.flatnonzero(holding)
                return {"term": np.where(met < len(block), met, len(block) - 1 - met), "n": holding[met]}
            for text in raw(batch.column(1)):
                line = guarded(text)
                if n := count_terms(line):
                    holding[-2:] += 1, n
                    holding[list(set(block.occurrences(line)))] += 1
            return None

        return work

    return map_batches(docs, make, schema, finish=True, as_stored=True).groupBy("term").agg(F.sum("n").alias("n"))


class Scores:
    """The best documents of each item among those that one task has met."""

    def __init__(self, terms: Terms, weights: np.ndarray, found: int, total: int, k: int):
        self.terms, self.weights, self.found, self.total, self.k = terms, weights, found, total, k
        self.best: list[list[tuple[int, tuple, object]]] = [[] for _ in range(terms.items)]
        #: a document must reach this score to be among the best of the item
        self.least = np.ones(terms.items, np.int64)
        self.rows: list[tuple[object, int, np.ndarray, np.ndarray]] = []
        self.fan = np.diff(terms.first)
        self.postings = 0

    def add(self, key, text: bytes | None) -> None:
        line = guarded(text)
        counts = Counter(self.terms.occurrences(line))
        if counts:
            m = 25 + 75 * count_terms(line) * self.found // self.total
            tf = np.fromiter(counts.values(), np.int64, len(counts))
            number = np.fromiter(counts, np.int64, len(counts))
            self.rows.append((key, m, number, tf))
            self.postings += int(self.fan[number].sum())
            if max(self.postings, len(self.rows) * self.terms.items) >= CELLS:
                self.settle()

    def settle(self) -> None:
        """Score the documents held and keep the best."""
        if not self.rows:
            return
        keys, ms, numbers, tfs = zip(*self.rows)
        self.rows, self.postings = [], 0
        sizes = np.array([len(n) for n in numbers])
        number, tf = np.concatenate(numbers), np.concatenate(tfs)
        m = np.repeat(np.array(ms, np.int64), sizes)
        part = self.weights[number] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
        fan = self.fan[number]
        posting = np.repeat(self.terms.first[number] - np.cumsum(fan) + fan, fan) + np.arange(fan.sum())
        cell = np.repeat(np.repeat(np.arange(len(keys)), sizes), fan) * self.terms.items
        scores = np.zeros(len(keys) * self.terms.items, np.int64)
        np.add.at(scores, cell + self.terms.item[posting], np.repeat(part, fan) * self.terms.times[posting])
        scores = scores.reshape(len(keys), self.terms.items)
        rows, items = np.nonzero(scores >= self.least)
        grown = set()
        for row, item in zip(rows.tolist(), items.tolist()):
            key = keys[row]
            self.best[item].append((-int(scores[row, item]), (key is not None, key), key))
            grown.add(item)
        for item in grown:
            # ties beyond the last place stay out by their key, as in the final ranking
            ranked = sorted(self.best[item], key=lambda e: e[:2])[: self.k]
            self.best[item] = ranked
            if len(ranked) == self.k:
                self.least[item] = -ranked[-1][0]


def scored(docs: DataFrame, terms, weights, found: int, total: int, k: int) -> DataFrame:
    """``item`` (its number in the block), ``doc_id, score``: what may be among an item's best ``k``."""
    schema = T.StructType(
        [
            T.StructField("item", T.IntegerType()),
            T.StructField("doc_id", kind(docs, "doc_id")),
            T.StructField("score", T.LongType()),
        ]
    )

    def make():
        state = Scores(terms.value, weights.value, found, total, k)

        def work(batch):
            if batch is None:
                state.settle()
                best = [(item, *e) for item, ranked in enumerate(state.best) for e in ranked]
                return {
                    "item": [e[0] for e in best],
                    "doc_id": [e[3] for e in best],
                    "score": [-e[1] for e in best],
                }
            for key, text in zip(strings(batch.column(0)), raw(batch.column(1))):
                state.add(key, text)
            return None

        return work

    return map_batches(docs, make, schema, finish=True, as_stored=True)


def blocks(items: DataFrame, block_bytes: int, block_items: int) -> tuple[DataFrame, int]:
    """The items with a block number each, and how many blocks there are.

    Items are dealt by a hash; as long as a block of several items is over a bound, to twice as many.
    """
    total = items.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")
    ).first()
    count = max(1, math.ceil(total["b"] / block_bytes), math.ceil(total["n"] / block_items))
    count = count if count == 1 else 2 * count
    while True:
        dealt = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(count)))
        over = (
            dealt.groupBy("block")
            .agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("b"))
            .where(f"n > 1 AND (n > {block_items} OR b > {block_bytes})")
        )
        if count == 1 and total["n"] <= block_items and total["b"] <= block_bytes or over.isEmpty():
            return dealt, count
        count *= 2


def search(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    k: int = 10,
    block_bytes: int = BLOCK_BYTES,
    block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's best ``k`` documents of a score above 0."""
    spark = docs.sparkSession
    own = text_rows(docs, key, text)
    wanted = text_rows(items, item_key, item_text).toDF("item_id", "text").distinct()
    dealt, count = blocks(wanted, block_bytes, block_items)
    schema = T.StructType(
        [
            T.StructField("item_id", kind(items, item_key)),
            T.StructField("rank", T.IntegerType()),
            T.StructField("doc_id", kind(docs, key)),
            T.StructField("score", T.LongType()),
        ]
    )
    parts: list[DataFrame] = []
    for number in range(count):
        rows = dealt.where(F.col("block") == number).select("item_id", F.col("text").cast("binary")).collect()
        rows = sorted(rows, key=lambda r: (r["text"] or b"", str(r["item_id"])))
        block = Terms([bytes(r["text"]) if r["text"] is not None else None for r in rows])
        if not len(block):
            continue
        terms = spark.sparkContext.broadcast(block)
        counted = {r["term"]: r["n"] for r in term_statistics(own, terms).collect()}
        found, total = counted.pop(-1, 0), counted.pop(-2, 0)
        if not found:
            break
        weights = np.zeros(len(block), np.int64)
        for term, df in counted.items():
            weights[term] = math.floor(1000 * math.log((2 * found + 2) / (2 * df + 1)))
        names = spark.createDataFrame(
            [(i, r["item_id"]) for i, r in enumerate(rows)],
            T.StructType([T.StructField(OWN + "item", T.IntegerType()), T.StructField("item_id", schema["item_id"].dataType)]),
        )
        best = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
        ranked = (
            scored(own, terms, spark.sparkContext.broadcast(weights), found, total, k)
            .withColumn("rank", F.row_number().over(best))
            .where(F.col("rank") <= k)
            .join(F.broadcast(names), F.col("item") == F.col(OWN + "item"))  # block_items rows at most
            .select(*schema.names)
        )
        parts.append(ranked)
    return reduce(DataFrame.unionByName, parts or [spark.createDataFrame([], schema)])
