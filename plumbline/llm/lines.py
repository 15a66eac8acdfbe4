"""Line deduplication by winnowing over line hashes.

A *run* is the fewest whole lines from some line on, or up to some line, that together have
``min_words`` words; lines without a word are passed over. Winnowing picks from each run the line of the
least hash (the first of equals): the minima are the fingerprints, and any two passages of ``min_words``
words that are equal have one in common. A fingerprint is kept once, with its *extent*: all lines of the
runs that picked it, which is as far as it can speak for a match both ways.

1. Fingerprints meet by the hash of their line. One that meets no other is done.
2. Of equal extents around it all but the first are repeated, line for line.
3. Where extents differ, the first one of each is extended both ways as far as it equals another: run by
   run of the extent, those up to each line and those from each line on, by digest. A run that also starts
   earlier (in a document of smaller id, or before in the same one) is repeated.

The lines of all later occurrences are deleted; the first stays. Together these are all lines of all maximal
repeated passages of ``min_words`` words or more: in such a passage each line either has that many
words up to it, and then ends a run inside the passage, or has fewer, and then lies in the run that begins
with the passage.

Comparisons group for the least position, which combines before the shuffle, and join back, which can be
split; a line that stands in a third of all documents is spread. Within a batch, equal extents are found
before anything is shuffled. Equal rows have the same extents, which are gathered once, so what is
gathered is bounded by the text whatever the number of its rows.

Defined cases: a null or empty text has no lines and stays; texts of fewer than ``min_words`` words
stay; lines are compared without the white space at their ends; a null ``doc_id`` counts as the
smallest; rows of one ``doc_id`` with different texts follow the order of a hash of their texts;
rows equal in both are one document; an empty table gives an empty one; bytes that are no UTF-8 become
U+FFFD in the texts given back; other columns are kept.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from plumbline.llm.common import OWN, kind, map_batches, written

MIN_WORDS = 10
#: Hashes of lines that are sent to all extents; more meet them in a join.
SENT = 200_000


def shaped(text: str | None) -> tuple[list[int], list[bytes], list[int]]:
    """The lines with a word: which line, without white space at the ends, its words."""
    number, lines, words = [], [], []
    for i, line in enumerate(text.split("\n") if text else ()):
        line = line.strip()
        if line:
            number.append(i), lines.append(line.encode()), words.append(len(line.split()))
    return number, lines, words


def shortest_runs(words: list[int], min_words: int) -> list[tuple[int, int]]:
    """First line and one past the last of the fewest lines from each line on, and up to each line."""
    out, end, total = [], 0, 0
    for start, own in enumerate(words):
        while end < len(words) and total < min_words:
            total += words[end]
            end += 1
        if total < min_words:
            break
        out.append((start, end))
        total -= own
    start = total = 0
    for last, own in enumerate(words):
        total += own
        while total - words[start] >= min_words:
            total -= words[start]
            start += 1
        if total >= min_words:
            out.append((start, last + 1))
    return sorted(set(out))


def digest_of(lines: list[bytes]) -> bytes:
    return hashlib.blake2b(b"\n".join(lines), digest_size=16).digest()


def winnowed(text: str | None, min_words: int) -> list[tuple[int, int, int, bytes, list[tuple[int, int, bytes]] | None]]:
    """Per fingerprint: first line of its extent, one past the last, its hash, the extent's digest, its runs.

    A run is its first line, one past the last, and its digest; None where the extent is one run.
    """
    from xxhash import xxh3_64_intdigest

    number, lines, words = shaped(text)
    if sum(words) < min_words:
        return []
    hashes = [xxh3_64_intdigest(x) for x in lines]
    picked: list[tuple[int, list[tuple[int, int]]]] = []
    seen = head = 0
    least: list[int] = []  # lines that may yet be least, from small to large hash
    # in this order neither the first line nor the last ever goes back, so neither does the least one
    for start, end in shortest_runs(words, min_words):
        for i in range(seen, end):
            while len(least) > head and hashes[least[-1]] > hashes[i]:
                least.pop()
            least.append(i)
        seen = max(seen, end)
        while least[head] < start:
            head += 1
        if not picked or picked[-1][0] != least[head]:
            picked.append((least[head], []))
        picked[-1][1].append((start, end))
    out = []
    for at, runs in picked:
        low, high = runs[0][0], max(end for _, end in runs)
        if len(runs) == 1:
            extent, own = digest_of(lines[low:high]), None
        else:  # no line is empty, so these digests are no run's
            extent = digest_of([b"", b"%d" % (at - low), *lines[low:high]])
            own = [(number[a], number[b - 1] + 1, digest_of(lines[a:b])) for a, b in runs]
        out.append((number[low], number[high - 1] + 1, hashes[at], extent, own))
    return out


RUN = T.StructType(
    [T.StructField("begin", T.LongType()), T.StructField("end", T.LongType()), T.StructField("digest", T.BinaryType())]
)


def _fingerprints(rows: DataFrame, min_words: int) -> DataFrame:
    """All fingerprints of all documents; those whose extent was met earlier in the batch are marked as known."""
    schema = T.StructType(
        [
            T.StructField("doc", kind(rows, "doc")),
            T.StructField("tie", T.LongType()),
            T.StructField("begin", T.LongType()),
            T.StructField("end", T.LongType()),
            T.StructField("fingerprint", T.LongType()),
            T.StructField("extent", T.BinaryType()),
            T.StructField("runs", T.ArrayType(RUN)),
            T.StructField("known", T.BooleanType()),
        ]
    )

    def make():
        def work(batch):
            keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            order = sorted(
                range(len(keys)),
                key=lambda i: (keys[i][0] is not None, keys[i][0] if keys[i][0] is not None else 0, keys[i][1]),
            )
            first: dict[bytes, tuple] = {}
            made = []
            for i in order:
                for begin, end, fingerprint, extent, runs in winnowed(batch.column(2)[i].as_py(), min_words):
                    place = (keys[i], begin)
                    known = first.setdefault(extent, place) != place
                    own = None if known or runs is None else [{"begin": a, "end": b, "digest": d} for a, b, d in runs]
                    made.append((i, begin, end, fingerprint, extent, own, known))
            if not made:
                return None
            row, begin, end, fingerprint, extent, runs, known = zip(*made)
            row = pa.array(row)
            return {
                "doc": batch.column(0).take(row),
                "tie": batch.column(1).take(row),
                "begin": begin,
                "end": end,
                "fingerprint": pa.array(np.array(fingerprint, np.uint64).view(np.int64)),
                "extent": extent,
                "runs": runs,
                "known": known,
            }

        return work

    return map_batches(rows, make, schema)


def _first_and_latest(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.min("place").alias("first"), F.max("place").alias("latest"))


def repeated_runs(rows: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc, tie, begin, end`` (lines) of what also starts earlier; of ``doc, tie, text``."""
    columns, place = ("doc", "tie", "begin", "end"), F.struct("doc", "tie", "begin")
    found = written(_fingerprints(rows, min_words), "fingerprints")
    open_ = found.where("NOT known").withColumn("place", place)
    extents = written(_first_and_latest(open_, "fingerprint", "extent"), "extents")
    # a hash beside which lines of more than one kind stand
    differing = written(
        extents.groupBy("fingerprint")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("fingerprint", F.lit(True).alias("differs")),
        "differing",
    )
    if differing.limit(SENT + 1).count() <= SENT:  # a common line has many extents, which then stay where they are
        differing = F.broadcast(differing)
    asked = extents.join(differing, "fingerprint", "left").where("differs OR NOT first <=> latest")
    met = open_.join(asked.drop("latest"), ["fingerprint", "extent"])
    whole = met.where("NOT place <=> first").select(*columns)
    alone = F.array(F.struct("begin", "end", F.col("extent").alias("digest")))
    # an extent of one run has that run's digest
    runs = written(
        met.where("differs AND place <=> first").select("doc", "tie", "fingerprint", F.inline(F.coalesce("runs", alone))),
        "runs",
    ).withColumn("place", place)
    firsts = _first_and_latest(runs, "fingerprint", "digest").where("NOT first <=> latest").drop("latest")
    again = runs.join(firsts, ["fingerprint", "digest"]).where("NOT place <=> first")
    return found.where("known").select(*columns).union(whole).union(again.select(*columns))


def without(text: str | None, places: list[tuple[int, int]]) -> str | None:
    """The text less the lines of the runs; None if it had words and none are left."""
    if not text or not places:
        return text
    gone: set[int] = set()
    for begin, end in places:
        gone.update(range(begin, end))
    left = [line for i, line in enumerate(text.split("\n")) if i not in gone]
    return "\n".join(left) if any(line.strip() for line in left) else None


def dedupe_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """The documents without later repeated runs of lines; those of which no word is left go."""
    names, count, gone = docs.columns, OWN + "runs", OWN + "gone"
    place = [c.lower() for c in names].index(text.lower())
    tie = OWN + "tie"
    rows = docs.withColumn(tie, F.xxhash64(F.col(text)))
    short = rows.select(F.col(key).alias("doc"), F.col(tie).alias("tie"), F.col(text).cast("string").alias("text"))
    found = (
        repeated_runs(short, min_words)
        .groupBy(F.col("doc").alias(OWN + "d"), F.col("tie").alias(OWN + "t"))
        .agg(F.collect_set(F.struct("begin", "end")).alias(count))
    )
    joined = rows.join(
        found, F.col(key).eqNullSafe(F.col(OWN + "d")) & (F.col(tie) == F.col(OWN + "t")), "left"
    ).select(*(F.col(f"`{c}`") for c in names), count)
    # numbered names, as names of the input may repeat one another but for case
    schema = T.StructType(
        [T.StructField(f"{i}", f.dataType) for i, f in enumerate(docs.schema)]
        + [T.StructField(gone, T.BooleanType())]
    )

    def make():
        def work(batch):
            texts, lost = [], []
            for value, own in zip(batch.column(place), batch.column(len(names))):
                value = value.as_py()
                new = without(value, [(x["begin"], x["end"]) for x in own.as_py() or ()])
                texts.append(new)
                lost.append(value is not None and new is None)
            out = {f"{i}": batch.column(i) for i in range(len(names))}
            out[f"{place}"] = pa.array(texts, type=batch.schema.field(place).type)
            out[gone] = lost
            return out

        return work

    return map_batches(joined, make, schema).where(~F.col(gone)).drop(gone).toDF(*names)


def line_report(
    docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """Per row: its lines with a word, how many are deleted, and the SHA-256 of the text that stays."""
    rows = docs.select(F.col(key).alias("doc"), F.col(text).cast("string").alias("text")).select(
        "doc", F.xxhash64("text").alias("tie"), "text"
    )
    found = (
        repeated_runs(rows, min_words)
        .groupBy(F.col("doc").alias("d"), F.col("tie").alias("t"))
        .agg(F.collect_set(F.struct("begin", "end")).alias("own"))
    )
    joined = rows.join(found, rows.doc.eqNullSafe(F.col("d")) & (rows.tie == F.col("t")), "left")
    schema = T.StructType(
        [
            T.StructField("doc_id", kind(docs, key)),
            T.StructField("n_lines", T.LongType()),
            T.StructField("n_deleted", T.LongType()),
            T.StructField("kept_sha256", T.StringType()),
        ]
    )

    def make():
        def work(batch):
            lines, deleted, digests = [], [], []
            for value, own in zip(batch.column(1), batch.column(2)):
                value = value.as_py()
                new = without(value, [(x["begin"], x["end"]) for x in own.as_py() or ()]) or ""
                before, after = len(shaped(value)[0]), len(shaped(new)[0])
                lines.append(before), deleted.append(before - after)
                digests.append(hashlib.sha256(new.encode()).hexdigest())
            return {"doc_id": batch.column(0), "n_lines": lines, "n_deleted": deleted, "kept_sha256": digests}

        return work

    return map_batches(joined.select("doc", "text", "own"), make, schema)
