"""Repeated passages by a sparse suffix array over the corpus.

A passage is repeated where ``length`` bytes also start earlier: in a document of smaller id, or
before in the same one. All bytes of every such later occurrence are removed.

Not every suffix is sorted. An *anchor* is the place in a window of ``length`` bytes whose next 32
bytes hash least; equal windows have it at the same place, and about one byte in 36 is one. So only
suffixes at anchors are compared, each with the *context* that its windows can see:

1. Anchors are dealt by the hash of their 32 leading bytes. One that meets no other is done: none of
   its windows can be repeated. Of equal contexts all but the first are repeated throughout.
2. What is left are the first ones of differing contexts around equal leading bytes, the ends of
   passages. Their text goes to buckets whose borders Spark samples from the leading bytes
   (``repartitionByRange``). A bucket sorts the suffixes at all its windows by multikey quicksort,
   eight bytes a step and only what is still tied, and of equal ones all but the first are repeated.
   Work is cut between groups of equal leading bytes only, so what equals across a border is compared.
3. A group with more contexts than one task should hold goes window by window instead: a digest
   grouped for the least position, combined before the shuffle, and joined back.

All three compare whole windows, where contexts are equal by a 64-bit hash of them (one and two) or windows
by a 128-bit digest (three). A document's places are gathered per document and applied to its bytes.

Defined cases: a null or empty text has no bytes; texts under ``length`` bytes stay whole; a null
``doc_id`` counts as the smallest; rows of one ``doc_id`` with different texts follow the order of a
hash of their texts; rows equal in both are one document, and each gets its result; an empty table
gives no row; bytes that are no UTF-8 count as they are; other columns are not read. ``length`` may be
64 to 65,535.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from plumbline.llm.common import kind, map_batches, mapped, raw, strings, written

LENGTH, LEAD = 100, 32
#: Bytes looked at together; contexts sorted together; contexts of one group for one task.
BLOCK, CHUNK, GROUP = 1 << 20, 4_000, 4_000
ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)
PLACE = (1 << 24) - 1
#: Bits for a number of windows or an offset, which bound the length of a repeat.
BITS = 16
FIELD = (1 << BITS) - 1
LENGTHS = (64, FIELD)
#: Documents of several rows that are sent to all rows to be made one each.
SENT = 100_000


def eights(buffer: bytes) -> np.ndarray:
    """The eight bytes at every place as one number."""
    n = len(buffer) - 7
    every = np.empty(n, "<u8")
    for i in range(8):
        part = np.frombuffer(buffer, "<u8", (len(buffer) - i) // 8, i)
        every[i::8] = part[: len(range(i, n, 8))]
    return every


def lead_hashes(buffer: bytes) -> np.ndarray:
    """A hash of the ``LEAD`` bytes at every place that has as many."""
    words = eights(buffer)
    n = len(buffer) - LEAD + 1
    total = np.zeros(n, np.uint64)
    for j, odd in enumerate(ODD):
        x = words[8 * j : 8 * j + n] * np.uint64(odd)
        x ^= x >> np.uint64(29)
        x *= np.uint64(odd)
        total += x
    total ^= total >> np.uint64(32)
    total *= np.uint64(ODD[0])
    total ^= total >> np.uint64(29)
    return total


def sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    span, least = 1, keys
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    n = len(keys) - width + 1
    return np.minimum(least[:n], least[width - span : width - span + n])


def runs(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers ``starts[i] .. starts[i] + counts[i] - 1``, one after the other."""
    ends = np.cumsum(counts)
    out = np.arange(ends[-1] if len(ends) else 0)
    return out + np.repeat(starts - (ends - counts), counts)


def anchors(parts: list[bytes], length: int = LENGTH):
    """Of texts: which text, first window, windows, anchor less first window, hash of lead, hash of context."""
    from xxhash import xxh64_intdigest as digest

    sizes = np.array([len(p) for p in parts])
    begins = np.cumsum(sizes) - sizes
    windows = np.maximum(sizes - length + 1, 0)
    if not windows.any():
        return None
    buffer = b"".join(parts)
    hashes = lead_hashes(buffer)
    keys = (hashes & ~np.uint64(PLACE)) | np.arange(len(hashes), dtype=np.uint64)
    least = sliding_least(keys, length - LEAD + 1)
    at = runs(begins, windows)
    text = np.repeat(np.arange(len(parts)), windows)
    place = (least[at] & np.uint64(PLACE)).astype(np.int64)
    new = np.flatnonzero(
        np.concatenate([[True], (place[1:] != place[:-1]) | (text[1:] != text[:-1])])
    )
    count = np.diff(np.append(new, len(at)))
    first, text, place = at[new], text[new], place[new]
    context = np.array(
        [digest(buffer[a:b]) for a, b in zip(first.tolist(), (first + count + length - 1).tolist())],
        np.uint64,
    )
    return text, first - begins[text], count, place - first, hashes[place], context


def segments(texts: list[bytes], length: int) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """The texts in lots of about a block: row, place in its text, bytes. Long ones overlap by a window."""
    rows, places, parts, size = [], [], [], 0
    for row, text in enumerate(texts):
        for at in range(0, max(1, len(text) - length + 1), BLOCK):
            part = text[at : at + BLOCK + length - 1]
            if len(part) < length:
                continue
            rows.append(row), places.append(at), parts.append(part)
            size += len(part)
            if size >= BLOCK:
                yield rows, places, parts
                rows, places, parts, size = [], [], [], 0
    if parts:
        yield rows, places, parts


def packed(first, count, offset):
    """First window, number of windows and anchor's offset in one number."""
    return (first << 2 * BITS) | (count << BITS) | offset


def unpacked(at):
    """The three again."""
    return at >> 2 * BITS, at >> BITS & FIELD, at & FIELD


def ranks(keys: list) -> np.ndarray:
    """Places in order; equal keys share one. A null id comes first."""
    def order(k):
        return (k[0] is not None, k[0] if k[0] is not None else 0, k[1])

    distinct = {k: i for i, k in enumerate(sorted(set(keys), key=order))}
    return np.array([distinct[k] for k in keys], np.int64)


def multikey(words: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Group numbers of the suffixes: equal where their first ``length`` bytes are.

    Multikey quicksort with eight bytes as a character: suffixes are sorted by one character, and
    only those tied there go on to the next.
    """
    group = np.zeros(len(starts), np.int64)
    live = np.arange(len(starts))
    used = 1
    depths = [*range(0, length - 7, 8)]
    if depths[-1] + 8 < length:
        depths.append(length - 8)
    for depth in depths:
        if not len(live):
            break
        word = words[starts[live] + depth].byteswap()
        own = group[live]
        order = np.lexsort((word, own))
        live, word, own = live[order], word[order], own[order]
        new = np.concatenate([[True], (word[1:] != word[:-1]) | (own[1:] != own[:-1])])
        number = np.cumsum(new) - 1
        group[live] = used + number
        used += int(number[-1]) + 1
        sizes = np.bincount(number)
        live = live[sizes[number] > 1]
    return group


def repeated(contexts: list[bytes], counts: np.ndarray, position: np.ndarray, length: int = LENGTH):
    """Which windows of the contexts are repeated; ``position`` orders the first windows."""
    buffer = b"".join(contexts) + bytes(8)
    sizes = np.array([len(c) for c in contexts])
    starts = runs(np.cumsum(sizes) - sizes, counts)
    where = runs(position, counts)
    group = multikey(eights(buffer), starts, length)
    order = np.lexsort((where, group))
    g, w = group[order], where[order]
    first = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
    least = np.repeat(w[first], np.diff(np.append(first, len(g))))
    out = np.zeros(len(starts), bool)
    out[order] = w != least
    return out


def spans(flags: np.ndarray, counts: np.ndarray, firsts: np.ndarray):
    """Runs of repeated windows: context, first window, one past the last."""
    owner = np.repeat(np.arange(len(counts)), counts)
    window = runs(firsts, counts)
    on = np.flatnonzero(flags)
    if not len(on):
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0, int)
    o, w = owner[on], window[on]
    new = np.concatenate([[True], (o[1:] != o[:-1]) | (w[1:] != w[:-1] + 1)])
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(on)) - 1
    return o[head], w[head], w[tail] + 1


def _fields(key: T.DataType, *more: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType(
        [T.StructField("doc", key), T.StructField("tie", T.LongType())]
        + [T.StructField(n, t) for n, t in more]
    )


def _anchored(rows: DataFrame, key: T.DataType, length: int) -> DataFrame:
    """One row per anchor; those known as repeated within the batch are marked and dealt evenly."""
    schema = _fields(
        key, ("lead", T.LongType()), ("context", T.LongType()), ("at", T.LongType()), ("known", T.BooleanType())
    )

    def make():
        def work(batch):
            docs, ties = batch.column(0), batch.column(1)
            texts = [t or b"" for t in raw(batch.column(2))]
            rank = ranks(list(zip(strings(docs), ties.to_pylist())))
            found = []
            for row, place, parts in segments(texts, length):
                made = anchors(parts, length)
                if made:
                    text, first, count, offset, lead, context = made
                    found.append(
                        (np.array(row)[text], first + np.array(place)[text], count, offset, lead, context)
                    )
            if not found:
                return None
            row, first, count, offset, lead, context = map(np.concatenate, zip(*found))
            order = np.lexsort((first, rank[row], context, lead))
            le, co = lead[order], context[order]
            same = np.concatenate([[False], (le[1:] == le[:-1]) & (co[1:] == co[:-1])])
            head = np.flatnonzero(~same)
            back = np.repeat(order[head], np.diff(np.append(head, len(order))))
            known = np.zeros(len(row), bool)
            known[order] = (rank[row[order]] != rank[row[back]]) | (first[order] != first[back])
            even = context * np.uint64(ODD[0]) + (first + 1).astype(np.uint64) * np.uint64(ODD[1])
            even ^= (row + 1).astype(np.uint64) * np.uint64(ODD[2])
            return {
                "doc": docs.take(pa.array(row)),
                "tie": ties.take(pa.array(row)),
                "lead": pa.array(np.where(known, even, lead).view(np.int64)),
                "context": pa.array(context.view(np.int64)),
                "at": pa.array(packed(first, count, offset)),
                "known": pa.array(known),
            }

        return work

    return map_batches(rows, make, schema, as_stored=True)


def _met(found: DataFrame, key: T.DataType) -> DataFrame:
    """Anchors that met another: repeated as a whole, or the first of a context among others."""
    schema = _fields(key, ("lead", T.LongType()), ("at", T.LongType()), ("whole", T.BooleanType()))
    dealt = found.repartition("lead").sortWithinPartitions(
        "known", "lead", "context", "doc", "tie", "at"
    )

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        now = context_now = place_now = None  # the present lead, context and the context's first place
        waiting = None  # the first row of the lead, while it has one context

        def out(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow
            )

        for batch in batches:
            batch = batch.select(["doc", "tie", "lead", "at", "context", "known"])
            known = batch.column("known").to_numpy(zero_copy_only=False)
            if known.any():
                on = batch.filter(pa.array(known))
                yield pa.RecordBatch.from_arrays([*on.columns[:4], on.column("known")], schema=arrow)
            batch = batch.filter(pa.array(~known))
            if not len(batch):
                continue
            lead = batch.column("lead").to_numpy()
            same = lead[1:] == lead[:-1]
            # the last row may meet the next batch's first
            busy = np.append(same, True) | np.insert(same, 0, lead[0] == now)
            made = []
            rows = batch.filter(pa.array(busy))
            for doc, tie, lead, at, context in zip(*(c.to_pylist() for c in rows.columns[:5])):
                place = (doc, tie, unpacked(at)[0])
                if lead != now:
                    now, context_now, place_now = lead, context, place
                    waiting = (doc, tie, lead, at, False)
                elif context != context_now:
                    if waiting:
                        made.append(waiting)
                        waiting = None
                    made.append((doc, tie, lead, at, False))
                    context_now, place_now = context, place
                elif place != place_now:  # else the same document once more
                    made.append((doc, tie, lead, at, True))
            if made:
                yield out(made)

    return mapped(dealt).mapInArrow(run, schema)


def _places(df: DataFrame, *columns: str) -> DataFrame:
    """Per document what it has, at most some for each of its bytes: equal rows have the same, which counts once."""
    return df.groupBy("doc", "tie").agg(F.collect_set(F.struct(*columns)).alias("own"))


def _joined(rows: DataFrame, own: DataFrame, how: str) -> DataFrame:
    own = own.select(F.col("doc").alias("d"), F.col("tie").alias("t"), "own")
    return rows.join(own, rows.doc.eqNullSafe(own.d) & (rows.tie == own.t), how).select("doc", "tie", "text", "own")


def _contexts(rows: DataFrame, firsts: DataFrame, key: T.DataType, length: int) -> DataFrame:
    """The text of each context and its leading bytes."""
    schema = _fields(
        key, ("at", T.LongType()), ("start", T.BinaryType()), ("context", T.BinaryType()), ("lead", T.LongType())
    )

    def make():
        def work(batch):
            row, at, start, context, lead = [], [], [], [], []
            for i, (text, own) in enumerate(zip(raw(batch.column(2)), batch.column(3))):
                text = text or b""
                for x in own.as_py():
                    first, count, offset = unpacked(x["at"])
                    row.append(i), at.append(x["at"]), lead.append(x["lead"])
                    start.append(text[first + offset : first + offset + LEAD])
                    context.append(text[first : first + count + length - 1])
            return {
                "doc": batch.column(0).take(pa.array(row, pa.int64())),
                "tie": batch.column(1).take(pa.array(row, pa.int64())),
                "at": at,
                "start": start,
                "context": context,
                "lead": lead,
            }

        return work

    return map_batches(_joined(rows, _places(firsts, "at", "lead"), "inner"), make, schema, as_stored=True)


def _sorted_buckets(contexts: DataFrame, key: T.DataType, length: int) -> DataFrame:
    schema = _fields(key, ("begin", T.LongType()), ("end", T.LongType()))
    dealt = contexts.repartitionByRange("start").sortWithinPartitions("start")

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)

        def settle(table: pa.Table):
            docs, ties = table.column("doc").combine_chunks(), table.column("tie").combine_chunks()
            at = table.column("at").to_numpy()
            first, count, _ = unpacked(at)
            rank = ranks(list(zip(strings(docs), ties.to_pylist())))
            flags = repeated(table.column("context").to_pylist(), count, (rank << 40) + first, length)
            owner, begin, end = spans(flags, count, first)
            owner = pa.array(owner)
            return pa.RecordBatch.from_arrays(
                [docs.take(owner), ties.take(owner), pa.array(begin), pa.array(end)], schema=arrow
            )

        held, size = [], 0
        for batch in batches:
            at = 0
            if size + len(batch) >= CHUNK:
                starts = batch.column("start").to_pylist()
                tail = held[-1].column("start")[-1].as_py() if held else None
                for i, start in enumerate(starts):
                    before = starts[i - 1] if i else tail
                    if size + i - at >= CHUNK and start != before:
                        yield settle(pa.Table.from_batches([*held, batch.slice(at, i - at)]))
                        held, size, at = [], 0, i
            if at < len(batch):
                held.append(batch.slice(at))
                size += len(batch) - at
        if size:
            yield settle(pa.Table.from_batches(held))

    return mapped(dealt).mapInArrow(run, schema)


def _by_digest(contexts: DataFrame, key: T.DataType, length: int) -> DataFrame:
    """The same, for groups of any size: windows by their digest."""
    schema = _fields(key, ("place", T.LongType()), ("digest", T.BinaryType()))

    def make():
        def work(batch):
            for i, (at, context) in enumerate(zip(batch.column(2).to_pylist(), batch.column(4).to_pylist())):
                first, n, _ = unpacked(at)
                row = pa.array([i] * n, pa.int64())
                yield {
                    "doc": batch.column(0).take(row),
                    "tie": batch.column(1).take(row),
                    "place": list(range(first, first + n)),
                    "digest": [
                        hashlib.blake2b(context[j : j + length], digest_size=16).digest() for j in range(n)
                    ],
                }

        return work

    windows = map_batches(contexts, make, schema).withColumn("where", F.struct("doc", "tie", "place"))
    firsts = (
        windows.groupBy("digest")
        .agg(F.min("where").alias("first"), F.max("where").alias("latest"))
        .where("NOT first <=> latest")
    )
    return (
        windows.join(firsts, "digest")
        .where("NOT where <=> first")
        .select("doc", "tie", F.col("place").alias("begin"), (F.col("place") + 1).alias("end"))
    )


def repeated_spans(rows: DataFrame, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """``doc, tie, begin, end``: runs of windows that also start earlier; of ``doc, tie, text``."""
    key = kind(rows, "doc")
    met = written(_met(_anchored(rows, key, length), key), "anchors")
    whole = met.where("whole").select(
        "doc",
        "tie",
        F.shiftright("at", 2 * BITS).alias("begin"),
        (F.shiftright("at", 2 * BITS) + F.shiftright("at", BITS).bitwiseAND(FIELD)).alias("end"),
    )
    firsts = met.where("NOT whole").select("doc", "tie", "at", "lead")
    large = written(
        firsts.groupBy("lead").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > group).select("lead"),
        "leads",
    )
    if large.isEmpty():
        return whole.union(_sorted_buckets(_contexts(rows, firsts, key, length), key, length))
    contexts = written(_contexts(rows, firsts, key, length), "contexts")
    return (
        whole.union(_sorted_buckets(contexts.join(large, "lead", "left_anti").select(contexts.columns), key, length))
        .union(_by_digest(contexts.join(large, "lead", "left_semi").select(contexts.columns), key, length))
    )


def covered(places: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """The bytes under runs of windows, as maximal spans."""
    out: list[list[int]] = []
    for begin, end in sorted(places):
        stop = end - 1 + length
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([begin, stop])
    return [tuple(x) for x in out]


def _once(rows: DataFrame) -> DataFrame:
    """One row per document: equal rows have one result, and a thousand of them would meet in each of their anchors."""
    again = written(
        rows.groupBy("doc", "tie").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc", "tie"), "again"
    )
    n = again.limit(SENT + 1).count()
    if not n:
        return rows
    if n > SENT:
        return rows.groupBy("doc", "tie").agg(F.first("text").alias("text"))
    again = F.broadcast(again.toDF("d", "t"))
    same = rows.doc.eqNullSafe(F.col("d")) & (rows.tie == F.col("t"))
    merged = rows.join(again, same, "left_semi").groupBy("doc", "tie").agg(F.first("text").alias("text"))
    return rows.join(again, same, "left_anti").union(merged)


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, with_text: bool = True
) -> DataFrame:
    """Per row: its bytes, removed bytes and spans (first byte, one past the last), what is kept, its SHA-256.

    ``kept`` is binary: a span may end within a character.
    """
    if not LENGTHS[0] <= length <= LENGTHS[1]:
        raise ValueError("repeats are sought from {} to {} bytes".format(*LENGTHS))
    own = kind(docs, key)
    rows = docs.select(F.col(key).alias("doc"), F.col(text).cast("string").alias("text")).select(
        "doc", F.xxhash64("text").alias("tie"), "text"
    )
    places = written(repeated_spans(_once(rows), length), "places")
    span = T.StructType([T.StructField("begin", T.LongType()), T.StructField("end", T.LongType())])
    schema = T.StructType(
        [
            T.StructField("doc_id", own),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("spans", T.ArrayType(span)),
            T.StructField("kept_sha256", T.StringType()),
            *([T.StructField("kept", T.BinaryType())] if with_text else []),
        ]
    )

    def make():
        def work(batch):
            out = {f.name: [] for f in schema}
            out["doc_id"] = batch.column(0)
            for value, found in zip(raw(batch.column(2)), batch.column(3)):
                value = value or b""
                cuts = covered([(x["begin"], x["end"]) for x in found.as_py() or ()], length)
                kept, at = [], 0
                for a, b in cuts:
                    kept.append(value[at:a])
                    at = b
                kept = b"".join([*kept, value[at:]])
                out["n_bytes"].append(len(value))
                out["n_removed"].append(len(value) - len(kept))
                out["spans"].append([{"begin": a, "end": b} for a, b in cuts])
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                if with_text:
                    out["kept"].append(kept)
            return out

        return work

    return map_batches(_joined(rows, _places(places, "begin", "end"), "left"), make, schema, as_stored=True)
