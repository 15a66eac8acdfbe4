"""Language identification with a blended-spectrum string kernel.

The kernel of two texts is, for n-grams of one, two and three characters each, the number of n-grams
present in both over the geometric mean of the numbers present in either; the blend is the mean of
the three. N-grams are hashed to a fixed table, so presence is a row of bits.

A bounded sample of labelled rows is gathered as such bits. A few of them, even by language, are the
Nystroem landmarks: with their kernel matrix K every text gets the features k(text, landmarks)
K^(-1/2), and ridge regression, one language against the rest and weighted so that each counts
alike, gives a weight per feature. As the kernel is an inner product of scaled bits, landmarks and
weights fold into one matrix with a column per language, and scoring a batch is one product of its
scaled bits with that matrix.

Every text is read whole. Bound of the fit: about ``sample_rows`` rows in all, the same share for
each language.

Defined cases: a text that is null or has no letter is ``und`` with score 0; rows with a null
language or key are not learned from; where nothing can be learned all is ``und``; repeated rows
each give a row; bytes that are no UTF-8 become U+FFFD; an empty table gives none; no other column is read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from plumbline.llm.common import kind, map_batches

SAMPLE_ROWS, LANDMARKS, RIDGE = 3_000, 240, 1e-3
#: Bits of the tables of 1-, 2- and 3-grams.
SIZES = (1 << 10, 1 << 13, 1 << 14)
#: Odd multipliers, one per place in an n-gram.
MIX = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)
#: Characters taken at a time, and documents per product.
BLOCK, BATCH = 1 << 20, 64
SHARP = 6.0


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def presence(text: str) -> np.ndarray:
    """One byte per table entry: 1 where an n-gram of the lower-cased text falls."""
    bits = np.zeros(sum(SIZES), np.uint8)
    text = text.lower()
    for at in range(0, len(text), BLOCK):
        part = text[max(0, at - len(SIZES) + 1) : at + BLOCK]
        codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
        start, total = 0, None
        for n, size in enumerate(SIZES):
            own = codes[n:] * MIX[n]
            total = own if total is None else total[: len(own)] + own
            bits[start + (total >> np.uint32(32 - (size.bit_length() - 1)))] = 1
            start += size
    return bits


def scaled(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as kernel features: each n's bits over the root of their number."""
    out = bits.astype(np.float32)
    start = 0
    for size in SIZES:
        block = out[:, start : start + size]
        counts = block.sum(axis=1, keepdims=True)
        block /= np.sqrt(np.maximum(counts, 1) * len(SIZES))
        start += size
    return out


def fit(bits: np.ndarray, langs: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE):
    """The names of the languages, the folded matrix and the intercepts."""
    names = sorted(set(langs))
    labels = np.searchsorted(names, langs)
    features = scaled(bits)
    order = np.argsort(labels, kind="stable")
    rank = np.empty(len(labels), np.int64)  # place of a row within its language
    for c in range(len(names)):
        own = order[labels[order] == c]
        rank[own] = np.arange(len(own))
    chosen = np.lexsort((labels, rank))[:landmarks]
    basis = features[chosen]
    values, vectors = np.linalg.eigh((basis @ basis.T).astype(np.float64))
    keep = values > 1e-6 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    x = (features @ basis.T) @ root
    x = np.hstack([x, np.ones((len(x), 1))])
    y = np.where(labels[:, None] == np.arange(len(names)), 1.0, 0.0)
    weight = 1.0 / np.bincount(labels)[labels]
    gram = (x * weight[:, None]).T @ x
    penalty = ridge * np.eye(len(gram))
    penalty[-1, -1] = 1e-9
    beta = np.linalg.solve(gram + penalty, (x * weight[:, None]).T @ y)
    return names, (basis.T @ (root @ beta[:-1])).astype(np.float32), beta[-1].astype(np.float32)


def scores(bits: np.ndarray, matrix: np.ndarray, intercept: np.ndarray) -> np.ndarray:
    """Shares of the languages per row, from one matrix product."""
    raw = SHARP * (scaled(bits) @ matrix + intercept)
    raw = np.exp(raw - raw.max(axis=1, keepdims=True))
    return raw / raw.sum(axis=1, keepdims=True)


def sample(rows: DataFrame, label: str, share: int, counts: dict) -> DataFrame:
    """About ``share`` rows of each label, by a hash of the key; the choice is the same in every run."""
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    chosen = F.lit(False)
    for value, n in counts.items():
        chosen = chosen | ((F.col(label) == F.lit(value)) & (place < F.lit(min(1.0, share / n))))
    return rows.where(chosen)


def bounded(rows: DataFrame, most: int, *columns: str) -> DataFrame:
    """``most`` rows at most, by a hash of what they hold: the same ones in every run, whatever key they share."""
    return rows.orderBy(F.xxhash64(*columns), *columns).limit(most)


def learn(docs: DataFrame, learnable: Column, key: str, text: str, lang: str, sample_rows: int):
    """A model from the learnable labelled rows, or None where there are none."""
    rows = docs.where(learnable & F.col(lang).isNotNull()).select(
        F.col(key).alias("doc_id"), F.col(lang).alias("lang"), F.col(text).cast("string").alias("text")
    )
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    chosen = bounded(sample(rows, "lang", max(1, sample_rows // len(counts)), counts), 2 * sample_rows, "doc_id", "text")

    def make():
        def work(batch):
            pairs = [
                (lang, np.packbits(presence(t)).tobytes())
                for lang, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                if has_letter(t)
            ]
            return {"lang": [p[0] for p in pairs], "bits": [p[1] for p in pairs]}

        return work

    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("bits", T.BinaryType())])
    found = map_batches(chosen.select("lang", "text"), make, schema).collect()
    if not found:
        return None
    found.sort(key=lambda r: (r["lang"], bytes(r["bits"])))
    bits = np.unpackbits(
        np.frombuffer(b"".join(bytes(r["bits"]) for r in found), np.uint8).reshape(len(found), -1), axis=1
    )
    return fit(bits, [r["lang"] for r in found])


def identify(
    docs: DataFrame,
    learnable: Column,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """``doc_id, lang_pred, score`` for every row; learns from the ``learnable`` rows with a language."""
    model = docs.sparkSession.sparkContext.broadcast(
        learn(docs, learnable, key, text, lang, sample_rows)
    )
    schema = T.StructType(
        [
            T.StructField("doc_id", kind(docs, key)),
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
        ]
    )

    def make():
        names, matrix, intercept = model.value or ([], None, None)

        def work(batch):
            keys = batch.column(0)
            for at in range(0, len(keys), BATCH):
                texts = batch.column(1).slice(at, BATCH).to_pylist()
                known = [i for i, t in enumerate(texts) if names and has_letter(t)]
                langs, best = ["und"] * len(texts), np.zeros(len(texts))
                if known:
                    shares = scores(np.stack([presence(texts[i]) for i in known]), matrix, intercept)
                    for i, c, s in zip(known, shares.argmax(axis=1), shares.max(axis=1)):
                        langs[i], best[i] = names[c], s
                yield {"doc_id": keys.slice(at, BATCH), "lang_pred": langs, "score": pa.array(best)}

        return work

    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return map_batches(rows, make, schema)
