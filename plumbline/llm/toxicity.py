"""Toxicity: a small convolutional text classifier, trained in numpy.

A word's embedding is the sum of two rows of hashed tables, one for the word and one for its first
letters, so that unseen endings of a known stem count too. Filters one, two and three words wide
slide over the text; each filter keeps its largest response anywhere in the text (max pooling), and
a logistic unit reads these. For scoring, tables and filters are multiplied out once per task: a
filter's response is then a sum of looked-up rows.

The fit reads every labelled row, whole texts of any length: each epoch, every task trains the
network on its rows and the networks are averaged. A fifth of the rows, by a hash of the key, is kept
from training to calibrate, counted by logits in bins of ``BIN``: the score's own threshold, so that
0.5 is the cut that errs least at the share of toxic rows among all labels, and one threshold per
language for ``flagged``. The score reads the text alone.

Every text is scored whole, in blocks that overlap by the widest filter.

Defined cases: a null or empty text has no words and gets the score of no response; rows without a
label or key are not learned from; with labels of one class only, or none, all scores are the
share of toxic labels (0 without labels); repeated rows each give a row; bytes that are no UTF-8 become U+FFFD; an empty table gives none.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F, types as T

from plumbline.llm.common import kind, map_batches
from plumbline.scratch import scratch_path

SAMPLE_ROWS, EPOCHS = 5_000, 10
#: Rows of each hashed table, numbers per embedding, filters per width, widths.
TABLE, DIM, FILTERS, WIDTHS = 1 << 15, 16, 16, (1, 2, 3)
LEFT_OUT = 0.6
STEM, REMEMBER, BLOCK = 5, 400_000, 1 << 16
#: Words of the texts scored together; table rows per piece of the state summed on the executors.
RUN, PIECE = 1 << 18, 4096
WORD = re.compile(r"[^\W_]+")


class Ids(dict):
    """A word's rows in both tables, packed in one number."""

    def __missing__(self, word: str) -> int:
        raw = word.encode("utf-8", "replace")
        stem = word[:STEM].encode("utf-8", "replace")
        found = (zlib.crc32(raw) % TABLE) << 16 | zlib.crc32(stem, 1) % TABLE
        if len(self) >= REMEMBER:
            self.clear()
        self[word] = found
        return found

    def of(self, text: str | None) -> np.ndarray:
        words = WORD.findall(text.lower()) if text else []
        return np.fromiter(map(self.__getitem__, words), np.uint32, len(words))


class Network:
    """Tables, filters and the logistic unit on the pooled responses."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.words = rng.normal(0, 0.02, (TABLE, DIM)).astype(np.float32)
        self.stems = rng.normal(0, 0.02, (TABLE, DIM)).astype(np.float32)
        self.filters = [
            rng.normal(0, 1 / np.sqrt(DIM * w), (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS
        ]
        self.bias = np.zeros(FILTERS * len(WIDTHS), np.float32)
        self.out = rng.normal(0, 0.3, FILTERS * len(WIDTHS)).astype(np.float32)
        self.shift = np.float32(0)

    def responses(self, ids: np.ndarray, tables=None) -> list[np.ndarray]:
        """Per width the responses at every place, without the bias."""
        a, b = ids >> 16, ids & 0xFFFF
        found = []
        x = None if tables else self.words[a] + self.stems[b]
        for k, w in enumerate(WIDTHS):
            n = len(ids) - w + 1
            if n <= 0:
                found.append(np.zeros((0, FILTERS), np.float32))
                continue
            total = None
            for j in range(w):
                if tables:
                    part = tables[k][j][0][a[j : j + n]]
                    part += tables[k][j][1][b[j : j + n]]
                else:
                    part = x[j : j + n] @ self.filters[k][j]
                total = part if total is None else np.add(total, part, out=total)
            found.append(total)
        return found

    def tables(self) -> list:
        """Tables times filters, for scoring."""
        return [[(self.words @ f, self.stems @ f) for f in self.filters[k]] for k in range(len(WIDTHS))]

    def pooled(self, ids: np.ndarray, tables=None) -> np.ndarray:
        """The largest response of each filter in the whole text; 0 is the least."""
        best = np.zeros(FILTERS * len(WIDTHS), np.float32)
        reach = max(WIDTHS) - 1
        for at in range(0, max(1, len(ids)), BLOCK):
            part = ids[max(0, at - reach) : at + BLOCK]
            tops = [
                r.max(axis=0) if len(r) else np.full(FILTERS, -np.inf, np.float32)
                for r in self.responses(part, tables)
            ]
            np.maximum(best, np.concatenate(tops) + self.bias, out=best)
        return best

    def logit(self, ids: np.ndarray, tables=None) -> float:
        return float(self.pooled(ids, tables) @ self.out + self.shift)

    def logits(self, texts: list[np.ndarray], tables) -> list[float]:
        """``logit`` of each text; texts are looked up together in runs of up to ``RUN`` words."""
        found, run, size = [], [], 0
        for ids in texts:
            if run and size + len(ids) > RUN:
                found += self._together(run, tables)
                run, size = [], 0
            if len(ids) > RUN:
                found.append(self.logit(ids, tables))
            else:
                run.append(ids)
                size += len(ids)
        if run:
            found += self._together(run, tables)
        return found

    def _together(self, run: list[np.ndarray], tables) -> list[float]:
        """The logits of texts laid end to end; a place counts for a text if its filter stays within it."""
        lengths = np.array([len(x) for x in run], np.int64)
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
        tops = []
        for w, r in zip(WIDTHS, self.responses(np.concatenate(run).astype(np.uint32), tables)):
            n = lengths - w + 1
            top = np.full((len(run), FILTERS), -np.inf, np.float32)
            on = np.flatnonzero(n > 0)
            if len(on):
                edges = np.empty(2 * len(on), np.int64)
                edges[0::2], edges[1::2] = starts[on], starts[on] + n[on]
                # one more place, so that the last text's end is a place too
                r = np.concatenate([r, np.zeros((1, FILTERS), np.float32)])
                top[on] = np.maximum.reduceat(r, edges, axis=0)[0::2]
            tops.append(top)
        pooled = np.maximum(np.zeros((len(run), FILTERS * len(WIDTHS)), np.float32), np.concatenate(tops, axis=1) + self.bias)
        return [float(p @ self.out + self.shift) for p in pooled]

    def train(self, texts: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, rate: float = 0.08):
        """Adaptive gradient steps, one text at a time; only the places a filter keeps get a gradient.

        Each time a share of the words is left out, so that no few words stand for all the others.
        """
        rng = np.random.default_rng(11)
        grow = {
            "words": np.full(TABLE, 1e-4, np.float32),
            "stems": np.full(TABLE, 1e-4, np.float32),
            "filters": [np.full_like(f, 1e-4) for f in self.filters],
            "bias": np.full_like(self.bias, 1e-4),
            "out": np.full_like(self.out, 1e-4),
            "shift": np.float32(1e-4),
        }
        for _ in range(epochs):
            for i in rng.permutation(len(texts)).tolist():
                left = texts[i][rng.random(len(texts[i])) >= LEFT_OUT]
                self._step(left, labels[i], rate, grow)

    def _step(self, ids, label, rate, grow) -> None:
        reply = self.responses(ids)
        n = FILTERS
        top = np.full(n * len(WIDTHS), -np.inf, np.float32)
        place = np.zeros(n * len(WIDTHS), np.int64)
        for k, r in enumerate(reply):
            if len(r):
                place[k * n : k * n + n] = r.argmax(axis=0)
                top[k * n : k * n + n] = r.max(axis=0)
        hidden = np.maximum(top + self.bias, 0)
        p = 1 / (1 + np.exp(-float(hidden @ self.out + self.shift)))
        error = np.float32(p - label)
        if abs(error) < 1e-3:
            return
        d_out = error * hidden + 1e-5 * self.out
        d_hidden = error * self.out * (hidden > 0)
        grow["shift"] += error**2
        self.shift -= rate * error / np.sqrt(grow["shift"])
        for name, d in (("out", d_out), ("bias", d_hidden)):
            grow[name] += d * d
            setattr(self, name, getattr(self, name) - rate * d / np.sqrt(grow[name]))
        a, b = ids >> 16, ids & 0xFFFF
        for k, w in enumerate(WIDTHS):
            on = np.flatnonzero(d_hidden[k * n : k * n + n])
            if not len(on) or len(ids) < w:
                continue
            d = d_hidden[k * n + on]
            for j in range(w):
                at = place[k * n + on] + j
                x = self.words[a[at]] + self.stems[b[at]]
                f = self.filters[k][j]
                d_x = d[:, None] * f[:, on].T
                d_f = (x * d[:, None]).T
                g = grow["filters"][k][j]
                g[:, on] += d_f * d_f
                f[:, on] -= rate * d_f / np.sqrt(g[:, on])
                for table, rows, name in ((self.words, a[at], "words"), (self.stems, b[at], "stems")):
                    np.add.at(grow[name], rows, (d_x * d_x).sum(axis=1))
                    np.subtract.at(table, rows, rate * d_x / np.sqrt(grow[name][rows])[:, None])


def cut(logits: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> float:
    """The threshold with the least weighted error, in the middle of the widest best gap."""
    order = np.argsort(logits)
    x, y, w = logits[order], labels[order], weights[order]
    # error if everything from place i on is called toxic
    missed = np.concatenate([[0], np.cumsum(w * (y == 1))])
    wrong = np.concatenate([np.cumsum((w * (y == 0))[::-1])[::-1], [0]])
    edges = np.concatenate([[x[0] - 2], (x[1:] + x[:-1]) / 2, [x[-1] + 2]])
    gaps = np.concatenate([[1.0], x[1:] - x[:-1], [1.0]])
    total = missed + wrong
    best = np.flatnonzero(total <= total.min() + 1e-12)
    return float(edges[best[np.argmax(gaps[best])]])


class Model:
    """A trained network, its threshold's logit and the thresholds by language."""

    def __init__(self, network: Network | None, centre: float, by_language: dict[str, float], share: float):
        self.network, self.centre, self.by_language, self.share = network, centre, by_language, share


#: Logits are counted for the thresholds in bins of this width.
BIN = 0.01


def _state(network: Network, grow: dict) -> list[np.ndarray]:
    """Every number that training changes, in a fixed order."""
    return [
        network.words, network.stems, *network.filters, network.bias, network.out, np.array([network.shift]),
        grow["words"], grow["stems"], *grow["filters"], grow["bias"], grow["out"], np.array([grow["shift"]]),
    ]


def _restore(state: list[np.ndarray]) -> tuple[Network, dict]:
    network, k = Network(), len(WIDTHS)
    network.words, network.stems = (x.astype(np.float32) for x in state[:2])
    network.filters = [x.astype(np.float32) for x in state[2 : 2 + k]]
    network.bias, network.out = (x.astype(np.float32) for x in state[2 + k : 4 + k])
    network.shift = np.float32(state[4 + k][0])
    rest = state[5 + k :]
    grow = {
        "words": rest[0].astype(np.float32),
        "stems": rest[1].astype(np.float32),
        "filters": [x.astype(np.float32) for x in rest[2 : 2 + k]],
        "bias": rest[2 + k].astype(np.float32),
        "out": rest[3 + k].astype(np.float32),
        "shift": np.float32(rest[4 + k][0]),
    }
    return network, grow


def _pieces(delta: list[np.ndarray]):
    """Keyed parts of a change: a table by pieces of ``PIECE`` rows, only the pieces and rows that changed."""
    for i, x in enumerate(delta):
        if x.shape[0] != TABLE:
            yield (i, 0), x
            continue
        at = np.flatnonzero(x.any(axis=1) if x.ndim == 2 else x)
        for p in np.unique(at // PIECE).tolist():
            own = at[(at >= p * PIECE) & (at < (p + 1) * PIECE)]
            yield (i, p), ((own - p * PIECE).astype(np.int32), x[own])


def _whole(x, like: np.ndarray) -> np.ndarray:
    """A piece of ``PIECE`` rows shaped as the rows of ``like``."""
    if not isinstance(x, tuple):
        return x
    at, rows = x
    found = np.zeros((PIECE, *like.shape[1:]), np.float64)
    found[at] = rows
    return found


def _train(rows: DataFrame, epochs: int = EPOCHS, rate: float = 0.08) -> Network:
    """Every epoch, each task trains the broadcast network on all its rows; the networks are averaged by rows.

    The changes are summed by pieces on the executors, so the driver gets one sum of each piece.
    Each time a share of the words is left out, as in ``Network.train``.
    """
    spark = rows.sparkSession
    state = _state(Network(), {
        "words": np.full(TABLE, 1e-4, np.float32),
        "stems": np.full(TABLE, 1e-4, np.float32),
        "filters": [np.full((w, DIM, FILTERS), 1e-4, np.float32) for w in WIDTHS],
        "bias": np.full(FILTERS * len(WIDTHS), 1e-4, np.float32),
        "out": np.full(FILTERS * len(WIDTHS), 1e-4, np.float32),
        "shift": np.float32(1e-4),
    })
    state = [x.astype(np.float64) for x in state]
    data = rows.select("toxic", "ids").rdd
    keys = sum(-(-x.shape[0] // PIECE) if x.shape[0] == TABLE else 1 for x in state) + 1
    for epoch in range(epochs):
        sent = spark.sparkContext.broadcast(state)

        def part(index, batch, sent=sent, epoch=epoch):
            network, grow, n = None, None, 0
            rng = np.random.default_rng((11, epoch, index))
            for r in batch:
                if network is None:
                    network, grow = _restore(sent.value)
                ids = np.frombuffer(bytes(r["ids"]), np.uint32)
                network._step(ids[rng.random(len(ids)) >= LEFT_OUT], r["toxic"], rate, grow)
                n += 1
            if n:
                yield (-1, 0), n
                # n times the change
                yield from _pieces([(x.astype(np.float64) - base) * n for x, base in zip(_state(network, grow), sent.value)])

        summed = dict(data.mapPartitionsWithIndex(part).reduceByKey(_add, keys).collect())
        sent.destroy()
        if not summed:
            break
        n = summed.pop((-1, 0))
        found = [np.zeros_like(x) for x in state]
        for (i, p), x in summed.items():
            if state[i].shape[0] == TABLE:
                found[i][p * PIECE : (p + 1) * PIECE] = _whole(x, state[i])
            else:
                found[i] = x
        # in float32, as the tasks train, so that a row they leave alone shows no change
        state = [(base + x / n).astype(np.float32).astype(np.float64) for base, x in zip(state, found)]
    return _restore(state)[0]


def _add(a, b):
    """The sum of two parts of a change; sparse pieces are made whole."""
    if isinstance(a, int):
        return a + b
    like = next((x[1] for x in (a, b) if isinstance(x, tuple)), a)
    return _whole(a, like) + _whole(b, like)


def learn(
    docs: DataFrame, labels: DataFrame, key: str, text: str, lang: str, label: str, sample_rows: int | None = None
) -> Model:
    """Trains on every labelled document; a fifth of them, by a hash of the key, sets the thresholds.

    ``sample_rows`` is no longer read: nothing is sampled.
    """
    spark = docs.sparkSession
    known = labels.select(F.col(key).alias("doc_id"), F.col(label).cast("int").alias("toxic")).where(
        "doc_id IS NOT NULL AND toxic IN (0, 1)"
    )
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return Model(None, 0.0, {}, 0.0)
    share = counts.get(1, 0) / sum(counts.values())
    if len(counts) < 2:
        return Model(None, 0.0, {}, share)
    rows = docs.select(
        F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")
    ).join(known, "doc_id")
    schema = T.StructType(
        [
            T.StructField("doc_id", kind(docs, key)),
            T.StructField("lang", T.StringType()),
            T.StructField("toxic", T.IntegerType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )

    def make():
        ids = Ids()

        def work(batch):
            return {
                "doc_id": batch.column(0),
                "lang": batch.column(1),
                "toxic": batch.column(2),
                "ids": [ids.of(t.as_py()).tobytes() for t in batch.column(3)],
            }

        return work

    # every labelled text once as word ids, read again each epoch
    path = scratch_path(spark, "toxicity_ids")
    map_batches(rows.select("doc_id", "lang", "toxic", "text"), make, schema).withColumn(
        "held", F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0
    ).write.parquet(path)
    coded = spark.read.parquet(path)
    network = _train(coded.where(~F.col("held")))
    sent = spark.sparkContext.broadcast(network)
    logit_schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("toxic", T.IntegerType()), T.StructField("logit", T.DoubleType())])

    def make_logits():
        net = sent.value
        tables = net.tables()

        def work(batch):
            return {
                "lang": batch.column(0),
                "toxic": batch.column(1),
                "logit": net.logits([np.frombuffer(x.as_py(), np.uint32) for x in batch.column(2)], tables),
            }

        return work

    logits = map_batches(coded.where("held").select("lang", "toxic", "ids"), make_logits, logit_schema)
    binned = (
        logits.groupBy("lang", "toxic", (F.round(F.col("logit") / BIN) * BIN).alias("logit"))
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    sent.unpersist()
    y = np.array([r["toxic"] for r in binned])
    if len(set(y.tolist())) < 2:
        return Model(network, 0.0, {}, share)
    x = np.array([r["logit"] for r in binned])
    n = np.array([r["n"] for r in binned], np.float64)
    weights = np.where(y == 1, n * share / n[y == 1].sum(), n * (1 - share) / n[y == 0].sum())
    centre = cut(x, y, weights)
    by_language = {}
    own = [r["lang"] for r in binned]
    for lang_ in sorted({v for v in own if v is not None}):
        at = np.array([v == lang_ for v in own])
        if len(set(y[at].tolist())) == 2:
            by_language[lang_] = float(1 / (1 + np.exp(centre - cut(x[at], y[at], weights[at]))))
    return Model(network, centre, by_language, share)


def score(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    label: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """``doc_id, score, flagged`` for every document; learns from all the rows of ``labels`` given."""
    spark = docs.sparkSession
    model = learn(docs, labels, key, text, lang, label, sample_rows)
    sent = spark.sparkContext.broadcast(model)
    schema = T.StructType(
        [
            T.StructField("doc_id", kind(docs, key)),
            T.StructField("score", T.DoubleType()),
            T.StructField("flagged", T.BooleanType()),
        ]
    )

    def make():
        m, ids = sent.value, Ids()
        tables = m.network.tables() if m.network else None

        def work(batch):
            if m.network:
                logits = np.array(m.network.logits([ids.of(t.as_py()) for t in batch.column(1)], tables))
                found = 1 / (1 + np.exp(np.clip(m.centre - logits, -60, 60)))
            else:
                found = np.full(len(batch), m.share)
            return {
                "doc_id": batch.column(0),
                "score": found,
                "flagged": [
                    s >= m.by_language.get(x, 0.5) for s, x in zip(found.tolist(), batch.column(2).to_pylist())
                ],
            }

        return work

    rows = docs.select(
        F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")
    )
    return map_batches(rows, make, schema)


def learnable(key: Column, fold: Column) -> Column:
    """Rows of known key outside the held-out fold."""
    return key.isNotNull() & (fold != 0)
