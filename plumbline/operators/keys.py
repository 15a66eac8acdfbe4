"""Keys of a table: the smallest sets of columns whose values never repeat.

The search goes level by level, from single columns to sets of ``most`` columns. Sets with a key inside
them are keys too and not looked at; a column with a NULL is in no key. Of the others an upper bound comes for
free: a set has no more different values than the product of its columns' numbers of values. What passes is
decided by values, over all rows, with as few of them counted as it takes:

* Rows that are alone with their values in a smaller set are alone in every set around it. So once the repeated
  values of a set are known (``_repeated``) and few, the sets around it are counted on those rows only.
* Two equal rows settle a set. So the sets without such a base are counted first on the rows of one hash slice of
  their column of most values, where a repeat shows that there is no key. What shows none there is then
  counted over all rows: by the repeated rows of a smaller set that several have in common, or by itself.

Sets of one step are counted in one scan and one exchange.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame, functions as F

from plumbline.functions.columns import compact_key, every, identifier, is_flat, ref
from plumbline.operators import grouped as G
from plumbline.scratch import scratch_path

# Registers of a sketch, as a power of two, and its relative error.
LG_K, RSD = 12, 0.02
# Columns of a key at most, and sketches of one pass.
MOST, PER_PASS = 3, 36
# Hash slices of a column, and rows from which on one slice is looked at before the others.
SLICES, SLICED_FROM = 64, 20_000
# Share of rows with repeated values up to which a set is a base of the sets around it.
BASE_SHARE = 0.25

Set = tuple[str, ...]


def _estimates(df: DataFrame, sets: Sequence[Set]) -> dict[Set, int]:
    """Estimated number of different values of each set of columns; rows with a NULL among them left out."""
    found: dict[Set, int] = {}
    for at in range(0, len(sets), PER_PASS):
        own = sets[at : at + PER_PASS]
        hashes = [F.when(every(ref(c).isNotNull() for c in s), F.xxhash64(*map(ref, s))) for s in own]
        sketches = [F.hll_sketch_estimate(F.hll_sketch_agg(h, F.lit(LG_K))) for h in hashes]
        numbers = df.agg(F.array(*sketches).alias("n")).first()["n"]
        found |= {s: n or 0 for s, n in zip(own, numbers)}
    return found


def _passes(sets: Sequence[Set]) -> list[list[Set]]:
    """The sets dealt to passes that keep within the bounds of one."""
    out: list[list[Set]] = []
    for s in sets:
        if out and len(out[-1]) < G.SETS_PER_PASS and len({*s}.union(*out[-1])) <= G.SLOTS_PER_PASS:
            out[-1].append(s)
        else:
            out.append([s])
    return out


def _shares(df: DataFrame, sets: Sequence[Set]) -> dict[Set, float]:
    """Share of the rows whose values of the set come more than once, exactly: 0 of a key and of no rows.

    All sets of a pass are counted in one scan and one exchange, tasks count before it.
    """
    out = dict.fromkeys(sets, 0.0)
    for own in _passes(sets):
        columns = list(dict.fromkeys(c for s in own for c in s))
        slots = dict(zip(columns, G.key_names(len(columns))))
        rows = df.select(*[compact_key(ref(c), df.schema[c].dataType).alias(n) for c, n in slots.items()])
        numbers = {sum(1 << i for i, c in enumerate(reversed(columns)) if c not in s): s for s in own}
        sizes = rows.groupingSets([[slots[c] for c in s] for s in own], *slots.values()).agg(
            F.grouping_id().alias(G.TAG), F.count(F.lit(1)).alias(G.N)
        )
        repeated = F.sum(F.when(F.col(G.N) > 1, F.col(G.N)).otherwise(0))
        shares = sizes.groupBy(G.TAG).agg((repeated / F.sum(G.N)).alias("share"))
        out |= {numbers[r[G.TAG]]: r["share"] for r in shares.collect()}  # a row per set
    return out


class _Base:
    """A set of columns, its values that repeat, and the share of the rows that have them: 0 of a key."""

    def __init__(self, df: DataFrame, columns: Set, rows: int):
        self.df, self.columns = df, columns
        self.keys = [compact_key(df[identifier(c)], df.schema[c].dataType) for c in columns]
        path = scratch_path(df.sparkSession, "repeated")
        G.group_sizes(df, self.keys).where(F.col(G.N) > 1).write.parquet(path)
        self.values = df.sparkSession.read.parquet(path)
        self.share = (self.values.agg(F.sum(G.N)).first()[0] or 0) / rows

    def rows(self) -> DataFrame:
        """The rows that are not alone with their values."""
        same = [k == self.values[n] for k, n in zip(self.keys, G.key_names(len(self.keys)))]
        return self.df.join(self.values, every(same), "left_semi")


class _Search:
    """What is known of a table's sets of columns on the way; ``df`` has no NULL."""

    def __init__(self, df: DataFrame, rows: int, single: dict[Set, int]):
        self.df, self.rows, self.single = df, rows, single
        self.bases: list[_Base] = []
        self.slices: dict[str, DataFrame] = {}
        # Shares of repeated rows as a slice or all rows showed them.
        self.shares: dict[Set, float] = {}

    def _slice(self, column: str) -> DataFrame:
        """All rows of about one in ``SLICES`` values of a column."""
        if column not in self.slices:
            spark = self.df.sparkSession
            own = self.df.where(F.pmod(F.xxhash64(ref(column)), F.lit(SLICES)) == 0)
            path = scratch_path(spark, "slice")
            own.repartition(spark.sparkContext.defaultParallelism).write.parquet(path)
            self.slices[column] = spark.read.schema(self.df.schema).parquet(path)
        return self.slices[column]

    def _by_bases(self, sets: Sequence[Set], bases: Sequence[_Base]) -> dict[Set, float]:
        """Shares of those sets that have one of the bases inside, over all rows."""
        around: dict[int, list[Set]] = {}
        for s in sets:
            inside = [i for i, b in enumerate(bases) if set(b.columns) <= set(s)]
            if inside:
                around.setdefault(min(inside, key=lambda i: bases[i].share), []).append(s)
        found: dict[Set, float] = {}
        for i, own in around.items():
            found |= {s: x * bases[i].share for s, x in _shares(bases[i].rows(), own).items()}
        return found

    def _base(self, columns: Set) -> _Base:
        base = _Base(self.df, columns, self.rows)
        self.shares[columns] = base.share
        if base.share <= BASE_SHARE:
            self.bases.append(base)
        return base

    def keys(self, level: Sequence[Set], last: bool) -> list[Set]:
        """The keys among sets of one width; ``last``: no wider sets will be asked for."""
        self.shares |= self._by_bases(level, self.bases)
        rest = [s for s in level if s not in self.shares]
        if self.rows < SLICED_FROM:
            self.shares |= _shares(self.df, rest)
            rest = []
        leads: dict[str, list[Set]] = {}
        for s in rest:
            leads.setdefault(max(s, key=lambda c: self.single[(c,)]), []).append(s)
        for column, own in leads.items():
            self.shares |= _shares(self._slice(column), own)
        rest = [s for s in rest if not self.shares[s]]
        while rest:
            inner = Counter(p for s in rest for p in combinations(s, len(s) - 1) if 0 < self.shares.get(p, 1) <= BASE_SHARE)
            columns, around = max(inner.items(), key=lambda i: i[1], default=((), 0))
            if around < 2:
                break
            base = self._base(columns)
            if base.share <= BASE_SHARE:
                decided = self._by_bases(rest, [base])
                self.shares |= decided
                rest = [s for s in rest if s not in decided]
        for s in rest:
            self.shares |= _shares(self.df, [s]) if last else {s: self._base(s).share}
        return [s for s in level if not self.shares[s]]


def minimal_keys(
    df: DataFrame, columns: Sequence[str] | None = None, most: int = MOST
) -> list[tuple[str, ...]]:
    """The keys of ``most`` columns or fewer that have no key inside them; of no rows, none."""
    given = df.columns if columns is None else list(columns)
    names = [c for c in given if is_flat(df.schema[c].dataType)]
    rows, *held = df.agg(F.count(F.lit(1)), *[F.count(ref(c)) for c in names]).first()
    names = [c for c, n in zip(names, held) if n == rows]
    if not rows or not names:
        return []
    df = df.select(*map(ref, names))
    room = 1 + 3 * RSD
    found: list[tuple[str, ...]] = []
    single = _estimates(df, [(c,) for c in names])
    search = _Search(df, rows, single)
    for width in range(1, most + 1):
        level = []
        for s in combinations(names, width):
            if any(set(k) <= set(s) for k in found):
                continue
            bound = 1.0
            for c in s:
                bound *= max(1, single[(c,)]) * room
            if bound >= rows:
                level.append(s)
        found += search.keys(level, width == most)
    return found


def suggested_keys(df: DataFrame, columns: Sequence[str] | None = None, most: int = MOST) -> DataFrame:
    """``(columns, width, dqdl_rule)`` of every minimal key."""
    rows = [
        (list(k), len(k), "IsPrimaryKey " + " ".join('"' + c.replace('"', '""') + '"' for c in k))
        for k in minimal_keys(df, columns, most)
    ]
    return df.sparkSession.createDataFrame(rows, "columns array<string>, width int, dqdl_rule string")
