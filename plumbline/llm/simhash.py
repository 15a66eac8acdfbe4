"""SimHash near-duplicates: fingerprints linked through BK-trees.

Fingerprints of 64 bits are cut into four blocks. Two that differ in two bits at most agree in two
blocks at least, so each fingerprint goes to the six shards named by a pair of its blocks, and every
link lies within a shard. A shard's fingerprints form a BK-tree: a node's children are keyed by
their Hamming distance to it, and a search with radius r that stands at distance d from a node
follows only the edges d - r to d + r. A shard too large for one tree is dealt out again by a third
of its free bits, as often as needed: pairs in it still agree in one of the thirds, and after three
times only ten bits are free. So a tree has a bounded size without a link being lost, however
many fingerprints look alike. Trees travel by shuffle to where they are asked; broadcasting
them to all tasks would grow with the corpus.

Trees give a spanning set of links per shard; components come from joins over these.

Defined cases: a null or empty text, and one of white space only, has fingerprint zero, linked like
any other; fewer than three words are one shingle; repeated rows have the same fingerprint and
each give a row; a null ``doc_id`` is never a component's name unless the component has no other;
bytes that are no UTF-8 become U+FFFD; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from plumbline.llm.common import OWN, kind, map_batches, mapped, text_rows, written
from plumbline.llm.components import roots

SHINGLE, SEED, RADIUS = 3, 42, 2
#: Fingerprints of one tree at most.
TREE = 2_000
#: Shingles hashed at a time.
BLOCK = 65_536


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The bits set in more than half the hashes of a text's shingles."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, BLOCK):
        part = words[at : at + BLOCK + shingle - 1]
        runs = zip(*(part[i:] for i in range(shingle))) if len(part) >= shingle else [part]
        hashes = np.array([digest(b" ".join(r), SEED) for r in runs], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * ones > n).tolist())


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


class BKTree:
    """A tree of distinct fingerprints; ``link`` adds one and gives its neighbours within the radius."""

    def __init__(self, radius: int = RADIUS):
        self.radius = radius
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def link(self, value: int) -> list[int]:
        found, values, r = [], self.values, self.radius
        stack = [0] if values else []
        while stack:
            node = stack.pop()
            d = (values[node] ^ value).bit_count()
            if d <= r:
                found.append(node)
            edges = self.children[node]
            if edges:
                if len(edges) <= 2 * r:
                    stack += [c for e, c in edges.items() if d - r <= e <= d + r]
                else:
                    stack += [edges[e] for e in range(d - r, d + r + 1) if e in edges]
        self._insert(value)
        return found

    def _insert(self, value: int) -> None:
        new = len(self.values)
        self.values.append(value)
        self.children.append({})
        node = 0
        while node != new:
            d = (self.values[node] ^ value).bit_count()
            node = self.children[node].setdefault(d, new)


def spanning(values: list[int], radius: int = RADIUS) -> list[tuple[int, int]]:
    """Links that connect what the shard's links connect."""
    tree, up, links = BKTree(radius), list(range(len(values))), []

    def top(x):
        while up[x] != x:
            up[x] = x = up[up[x]]
        return x

    for i, value in enumerate(values):
        for j in tree.link(value):
            a, b = top(i), top(j)
            if a != b:
                up[a] = b
                links.append((value, values[j]))
    return links


def thirds(mask: int, parts: int = 3) -> list[int]:
    """A shard's mask with one part more of its free bits."""
    free = [i for i in range(64) if not mask >> i & 1]
    return [mask | sum(1 << i for i in part.tolist()) for part in np.array_split(free, parts)]


def first_masks(radius: int = RADIUS) -> list[int]:
    """Pairs of blocks: ``radius + 2`` blocks of which any link leaves two alike."""
    blocks = [sum(1 << i for i in b.tolist()) for b in np.array_split(np.arange(64), radius + 2)]
    return [a | b for i, a in enumerate(blocks) for b in blocks[:i]]


def _sharded(rows: DataFrame, masks: list[int]) -> DataFrame:
    choices = F.array(*(F.lit(signed(m)) for m in masks))
    return rows.select("fp", F.explode(choices).alias("mask")).withColumn(
        "value", F.col("fp").bitwiseAND(F.col("mask"))
    )


def links(fingerprints: DataFrame, radius: int = RADIUS, tree: int = TREE) -> DataFrame:
    """Links ``u, v`` that connect all distinct ``fp`` within the radius of each other.

    ``tree``: fingerprints of one tree at most; 64 are always allowed, so that bits remain to deal by.
    """
    tree = max(tree, 64)
    schema = T.StructType([T.StructField("u", T.LongType()), T.StructField("v", T.LongType())])

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def found(values):
            # numpy integers have no bits to count in the sense of unsigned 64
            return spanning([v & 0xFFFFFFFFFFFFFFFF for v in values], radius)

        shard, values = None, []
        for frame in frames:
            made = []
            for mask, value, fp in zip(
                frame["mask"].tolist(), frame["value"].tolist(), frame["fp"].tolist()
            ):
                if (mask, value) != shard:
                    if len(values) > 1:
                        made += found(values)
                    shard, values = (mask, value), []
                values.append(fp)
            yield pd.DataFrame([(signed(a), signed(b)) for a, b in made], columns=["u", "v"], dtype="int64")
        if len(values) > 1:
            made = found(values)
            yield pd.DataFrame([(signed(a), signed(b)) for a, b in made], columns=["u", "v"], dtype="int64")

    rows, masks, out = _sharded(fingerprints, first_masks(radius)), first_masks(radius), None
    while True:
        sizes = written(
            rows.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shards"
        )
        sized = rows.join(sizes, ["mask", "value"])
        deeper = {m: thirds(m, radius + 1) for m in masks}
        free = max(64 - m.bit_count() for m in masks)
        small = sized if 1 << free <= tree else sized.where(F.col("n") <= tree)
        part = (
            mapped(small)
            .select("mask", "value", "fp")
            .repartition("mask", "value")
            .sortWithinPartitions("mask", "value", "fp")
            .mapInPandas(search, schema)
        )
        out = part if out is None else out.union(part)
        if 1 << free <= tree or sizes.where(F.col("n") > tree).isEmpty():
            return out
        # what is left: fingerprints of shards beyond one tree, by a part more of their bits
        pick = F.create_map(
            *(
                x
                for m, d in deeper.items()
                for x in (F.lit(signed(m)), F.array(*(F.lit(signed(i)) for i in d)))
            )
        )
        large = sized.where(F.col("n") > tree)
        rows = written(
            large.select("fp", F.explode(pick[F.col("mask")]).alias("mask"))
            .withColumn("value", F.col("fp").bitwiseAND(F.col("mask")))
            .distinct(),
            "shards",
        )
        masks = sorted({i for d in deeper.values() for i in d})


def _fingerprinted(docs: DataFrame, key: str, text: str) -> DataFrame:
    schema = T.StructType(
        [T.StructField("doc_id", kind(docs, key)), T.StructField("fp", T.LongType())]
    )

    def make():
        def work(batch):
            return {
                "doc_id": batch.column(0),
                "fp": [signed(fingerprint(t.as_py())) for t in batch.column(1)],
            }

        return work

    return map_batches(text_rows(docs, key, text), make, schema)


def _named(prints: DataFrame) -> DataFrame:
    """``fp, component_id``: each distinct fingerprint and the smallest document it reaches."""
    distinct = written(
        prints.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "fingerprints"
    )
    reached = roots(links(distinct.select("fp")))
    rooted = written(
        distinct.join(reached.withColumnRenamed("node", "fp"), "fp", "left").select(
            "fp", "doc_id", F.coalesce("root", "fp").alias("root")
        ),
        "rooted",
    )
    names = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return rooted.join(names, "root").select("fp", "component_id")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of the documents."""
    prints = written(_fingerprinted(docs, key, text), "prints")
    return prints.join(_named(prints), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents less all but one row of each component: that of the smallest ``doc_id``.

    Of rows with equal ``doc_id`` one stays. Columns are unchanged.
    """
    row = OWN + "row"
    numbered = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    prints = written(
        _fingerprinted(
            numbered.select(
                F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), F.col(row).alias("row")).alias(OWN + "k"),
                F.col(text).alias(OWN + "t"),
            ),
            OWN + "k",
            OWN + "t",
        ),
        "prints",
    )
    stay = prints.join(_named(prints), "fp").where("doc_id = component_id").select(
        F.col("doc_id.row").alias(row)
    )
    return numbered.join(stay, row, "left_semi").drop(row)
