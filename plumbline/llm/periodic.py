"""Periodic runs of words by an enhanced suffix array and the branching-tandem test.

A run is a stretch of words in which words ``period`` apart are equal, which no neighbouring word
extends, whose period is the smallest it has, and which is long enough: at least ``min_length`` words
and ``min_periods`` periods.

Within a task, documents are taken a stretch of words at a time. Suffixes are sorted by doubling
(a suffix's first key is its document, so that order and common prefixes never cross documents, and
only suffixes not yet told apart are sorted again); the ranks of each doubling stay, since two
stretches of 2^k words are equal where their ranks of step k are. They give the common prefix of
neighbours in the array, which is the LCP table. Each LCP value d with its neighbours of at least d
is an LCP interval, parted at that place in two: of the smaller part each suffix i asks whether
ISA[i + d] or ISA[i - d] lies in the other part. If so, the square of period d that starts at the
smaller of the two cannot be rotated right, as the two suffixes part after d words. It is rotated left
as far as words agree, by ranks again; what it sweeps is a run. Of runs over the same words
the shortest period stays. Intervals are places in the table, no tree is built, and each suffix is asked
at most log n times.

Memory in a task: 4 bytes times log2 of the longest repeat for each word of a stretch, that is of
``STRETCH`` words or of one document that is longer.

Defined cases: a null or empty text has no words, no runs and collapses to the empty text; repeated rows
each give a row; an empty table gives none; words are bytes between ASCII white space, equal where their
bytes are, be they UTF-8 or not (``collapsed`` shows U+FFFD for bytes that are none); other columns are
not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from plumbline.llm.common import kind, map_batches, raw, strings, text_rows

#: Words sorted together, and suffixes asked at once.
STRETCH = 200_000
ASKED = 1_000_000


def ranks(keys: np.ndarray) -> list[np.ndarray]:
    """Per step k, each place's rank by its first 2^k keys; the last step's ranks are all different.

    The keys' last place must differ from all others, and so must each document's.
    """
    n = len(keys)
    order = np.argsort(keys, kind="stable")
    new = np.empty(n, bool)
    new[0] = True
    np.not_equal(keys[order[1:]], keys[order[:-1]], out=new[1:])
    starts = np.flatnonzero(new)
    rank = np.empty(n, np.int32)
    rank[order] = np.repeat(starts, np.diff(starts, append=n))
    steps = [rank]
    # places of groups with more than one member, group by group
    active = order[~(new & np.append(new[1:], True))]
    h = 1
    while len(active):
        before = rank[active].astype(np.int64)
        pair = before * n + rank[active + h]
        sort = np.argsort(pair, kind="stable")
        active, pair, before = active[sort], pair[sort], before[sort]
        place = np.arange(len(active))
        group = np.append(True, before[1:] != before[:-1])
        new = np.append(True, pair[1:] != pair[:-1])
        within = place - np.maximum.accumulate(np.where(group, place, 0))
        now = before + np.maximum.accumulate(np.where(new, place, 0)) - (place - within)
        rank = rank.copy()
        rank[active] = now
        steps.append(rank)
        active = active[~(new & np.append(new[1:], True))]
        h *= 2
    return steps


def common(steps: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many keys from a and b on are equal."""
    length = np.zeros(len(a), np.int64)
    for k in range(len(steps) - 1, -1, -1):
        step = steps[k]
        length += (step[a + length] == step[b + length]).astype(np.int64) << k
    return length


def common_before(steps: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many keys before a and b are equal, for a < b."""
    length = np.zeros(len(a), np.int64)
    for k in range(len(steps) - 1, -1, -1):
        step, at = steps[k], a - length - (1 << k)
        equal = (at >= 0) & (step[np.maximum(at, 0)] == step[np.maximum(at + b - a, 0)])
        length += equal.astype(np.int64) << k
    return length


def intervals(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places x of lcp > 0, and for each the parts [low, x - 1] and [x, high] that lcp[x] parts.

    Left of x stand values of at least lcp[x], right of it greater ones, so that the places of one value
    part their interval one after the other.
    """
    n = len(lcp)
    at = np.flatnonzero(lcp > 0)
    value = lcp[at]
    # least value among the 2^k from each place on
    least, k = [lcp], 0
    while least[-1].any() and 2 << k <= n:
        last = least[-1]
        wider = np.zeros_like(last)
        wider[: n - (1 << k)] = np.minimum(last[: n - (1 << k)], last[1 << k :])
        least.append(wider)
        k += 1
    low, high = at.copy(), at.copy()
    for k in range(len(least) - 1, -1, -1):
        step, width = least[k], 1 << k
        begin = low - width
        low -= width * ((begin >= 0) & (step[np.maximum(begin, 0)] >= value))
        begin = high + 1
        high += width * ((begin < n) & (step[np.minimum(begin, n - 1)] > value))
    return at, low - 1, high


def squares(sa: np.ndarray, isa: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and period of each square that cannot be rotated right."""
    at, low, high = intervals(lcp)
    left = at - low <= high - at + 1
    first = np.where(left, low, at)
    size = np.where(left, at - low, high - at + 1)
    other_low, other_high = np.where(left, at, low), np.where(left, high, at - 1)
    ends = np.cumsum(size)
    starts, periods = [], []
    a = 0
    while a < len(at):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + ASKED, side="right")))
        count = size[a:b]
        which = np.repeat(np.arange(a, b), count)
        i = sa[np.repeat(first[a:b] - np.cumsum(count) + count, count) + np.arange(len(which))]
        d = lcp[at[which]]
        lo, hi = other_low[which], other_high[which]
        after = isa[i + d]
        hit = (after >= lo) & (after <= hi)
        starts.append(i[hit])
        periods.append(d[hit])
        prior = isa[np.maximum(i - d, 0)]
        hit = (i >= d) & (prior >= lo) & (prior <= hi)
        starts.append((i - d)[hit])
        periods.append(d[hit])
        a = b
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(starts), np.concatenate(periods)


def runs_of(keys: np.ndarray, min_length: int, min_periods: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of each run in the keys, by start and period; see ``ranks`` for the keys."""
    steps = ranks(keys)
    isa = steps[-1]
    sa = np.empty(len(isa), np.int64)
    sa[isa] = np.arange(len(isa))
    near = steps[0][sa]
    lcp = np.zeros(len(sa), np.int64)
    told = np.flatnonzero(near[1:] == near[:-1]) + 1
    lcp[told] = common(steps, sa[told - 1], sa[told])
    start, period = squares(sa, isa, lcp)
    back = common_before(steps, start, start + period)
    start, length = start - back, 2 * period + back
    long = (length >= min_length) & (length >= min_periods * period)
    start, length, period = start[long], length[long], period[long]
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    new = np.append(True, (start[1:] != start[:-1]) | (length[1:] != length[:-1]))[: len(start)]
    start, length, period = start[new], length[new], period[new]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def keys_of(documents: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """The documents' words as numbers, one after the other, each document's end its own key; and their starts."""
    sizes = np.array([len(w) + 1 for w in documents])
    offsets = np.cumsum(sizes) - sizes
    total = int(sizes.sum())
    ends = np.zeros(total, bool)
    ends[offsets + sizes - 1] = True
    words = pa.array([w for d in documents for w in d], pa.large_binary()).dictionary_encode()
    keys = np.empty(total, np.int64)
    keys[~ends] = words.indices.to_numpy(zero_copy_only=False)
    keys[ends] = len(words.dictionary)
    return keys + np.repeat(np.arange(len(documents)), sizes) * (len(words.dictionary) + 1), offsets


def kept_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words but those of a run after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]


def runs_by_document(
    documents: list[list[bytes]], min_length: int = 24, min_periods: int = 3
) -> list[list[tuple[int, int, int]]]:
    """Start, length and period of the runs of each document."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in documents]
    some = [i for i, w in enumerate(documents) if len(w) >= min_length]
    if some:
        keys, offsets = keys_of([documents[i] for i in some])
        start, length, period = runs_of(keys, min_length, min_periods)
        which = np.searchsorted(offsets, start, side="right") - 1
        for i, s, n, p in zip(which.tolist(), (start - offsets[which]).tolist(), length.tolist(), period.tolist()):
            out[some[i]].append((s, n, p))
    return out


def find_runs(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    min_length: int = 24,
    min_periods: int = 3,
    with_text: bool = True,
) -> DataFrame:
    """Per document ``doc_id, n_words, runs`` (start, length, period, in words) and ``collapsed``.

    ``collapsed`` has the words, joined by blanks, without those of a run after its first period.
    A square is two periods, so ``min_periods`` is 2 at least.
    """
    if min_periods < 2:
        raise ValueError("a run has two periods at least")
    run = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
    schema = T.StructType(
        [
            T.StructField("doc_id", kind(docs, key)),
            T.StructField("n_words", T.LongType()),
            T.StructField("runs", T.ArrayType(run)),
            *([T.StructField("collapsed", T.StringType())] if with_text else []),
        ]
    )

    def make():
        def settle(keys: list, documents: list[list[bytes]]) -> dict:
            found = runs_by_document(documents, min_length, min_periods)
            return {
                "doc_id": keys,
                "n_words": [len(w) for w in documents],
                "runs": [[{"start": s, "length": n, "period": p} for s, n, p in r] for r in found],
                "collapsed": [
                    b" ".join(kept_words(w, r)).decode("utf-8", "replace") for w, r in zip(documents, found)
                ]
                if with_text
                else None,
            }

        def work(batch):
            keys, documents, held = [], [], 0
            for name, value in zip(strings(batch.column(0)), raw(batch.column(1))):
                words = (value or b"").split()
                if documents and held + len(words) > STRETCH:
                    yield settle(keys, documents)
                    keys, documents, held = [], [], 0
                keys.append(name)
                documents.append(words)
                held += len(words)
            if documents:
                yield settle(keys, documents)

        return work

    return map_batches(text_rows(docs, key, text), make, schema, as_stored=True)
