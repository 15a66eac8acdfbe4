"""Statistics of group sizes over all batches of a data set that grows, without reading old batches again.

Kept are, in a folder: per batch the sizes of its groups (one table for all key sets: the set's name,
its keys in typed columns, the size), and per batch what it added to the totals of each key set. A new
batch counts its own groups, looks up the earlier size of just these keys, and adds the difference to
the totals. Earlier sizes are scanned for that but not shuffled while the batch's groups are few (counted first) and
sent to them; else both are united and summed by key, one exchange without a join. Statistics are read off the
totals, a row per batch and key set.

A batch owns its folders and overwrites them, and looks only at batches before it: one that is repeated after
a failure leaves the same state. ``compact`` sums up the sizes of earlier batches into a base that takes
their place once it is written in full.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from plumbline.functions.columns import ref
from plumbline.operators.grouped import COUNTS, N, TAG, key_set, key_types, passes, slots_of, tagged_sizes
from plumbline.operators.metric import Metric
from plumbline.sources.readers import read_path

SET, BATCH = "key_set", "batch_id"
# Groups of a batch that are sent to all earlier sizes, so that these are not shuffled.
SENT = 100_000
# Rows that a task counts or sums by key, about.
ROWS_PER_TASK = 500_000
# What totals hold of a key set: sums over its groups.
PARTS = ("rows", "keyed", "groups", "distinct", "single", "single_complete", "n_ln_n")


def set_name(metric: Metric) -> str:
    return repr(key_set(metric))


def _slot(dtype: T.DataType, ordinal: int) -> str:
    """Column that holds keys of a type, under a name that is the same in every batch."""
    kind = "".join(c if c.isalnum() else "_" for c in dtype.simpleString())
    return f"key_{kind}_{ordinal}"


def tasks_for(df: DataFrame, rows: int) -> int:
    """Tasks that count so many rows, each few enough for its memory."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // ROWS_PER_TASK))


def batch_sizes(df: DataFrame, metrics: Sequence[Metric], by: Sequence[str] = ()) -> DataFrame:
    """``by`` columns, key set, key columns and size of every group of every key set, one scan a pass.

    Rows are spread over all cores before they are multiplied: a batch may be one file that one task reads, or so
    large that the groups of a task do not fit its memory.
    """
    tasks = tasks_for(df, df.count())
    df = df.select(*map(ref, dict.fromkeys([*by, *(c for m in metrics for c in m.columns)]))).repartition(tasks)
    sets = {}
    for m in metrics:
        sets.setdefault(key_set(m), []).append(m)
    out = []
    for own in passes(df, sets):
        chosen = {set_name(m): m.keys for m in own}
        types, _ = slots_of(key_types(df, list(chosen.values())))
        sizes, slots = tagged_sizes(df, list(chosen.values()), by)
        named = [
            F.col(s).alias(_slot(t, types[:i].count(t))) for i, (s, t) in enumerate(zip(slots, types))
        ]
        name = F.get(F.array(*map(F.lit, chosen)), F.col(TAG))
        width = F.get(F.array(*[F.lit(len(k)) for k in chosen.values()]), F.col(TAG))
        held = sum((F.col(s).isNotNull().cast("int") for s in slots), F.lit(0))
        out.append(
            sizes.select(
                *map(ref, by), name.alias(SET), *named, held.alias("held"), width.alias("width"), F.col(N).alias("size")
            )
        )
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), out)


def added(new: DataFrame, old: DataFrame | None, widths: Mapping[str, int], by: Sequence[str] = ()) -> DataFrame:
    """What groups of ``new`` sizes add to the totals of their key sets, given the sizes before.

    ``widths``: the key sets by name and how many keys each has.
    """
    keys = [c for c in new.columns if c not in ("size", "held", "width")]
    number = F.array_position(F.array(*map(F.lit, widths)), F.col(SET))
    none = F.lit(0).cast("long")
    if old is None:
        both = new.withColumn("before", none)
    else:
        for c in keys:
            if c not in old.columns:
                old = old.withColumn(c, F.lit(None).cast(new.schema[c].dataType))
        lost = [c for c in old.columns if c not in (*keys, "size", "held", "width")]
        # groups with a key in a column that the batch lacks are none of the batch's
        old = old.where(reduce(Column.__and__, [F.col(c).isNull() for c in lost], F.lit(True)))
        groups = new.count()
        few = groups <= SENT
        tasks = tasks_for(new, groups + old.count())
        if few:
            wanted = new.select(*keys).withColumnsRenamed({k: f"_{k}" for k in keys})
            same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
            old = old.join(F.broadcast(wanted), same, "left_semi")
        # the number of a set is shorter than its name; sets that the batch lacks have number 0
        new = new.select(number.alias(TAG), *map(ref, keys), "size", none.alias("before")).drop(SET)
        old = old.select(number.alias(TAG), *map(ref, keys), none.alias("size"), F.col("size").alias("before")).drop(SET)
        sizes = new.unionByName(old.where(F.col(TAG) > 0))
        slots = [c for c in keys if c != SET and c not in by]
        group = [ref(c) for c in sizes.columns if c not in ("size", "before")]
        if not few:  # a key has a row a batch at most, so nothing is hot and nothing to combine before the exchange
            sizes = sizes.repartition(tasks, *group)
        both = (
            sizes.groupBy(*group)
            .agg(F.sum("size").alias("size"), F.sum("before").alias("before"))
            .where(F.col("size") > 0)
            .withColumn(SET, F.get(F.array(*map(F.lit, widths)), F.col(TAG) - 1))
            .withColumn("held", sum((ref(c).isNotNull().cast("int") for c in slots), F.lit(0)))
            .withColumn("width", F.get(F.array(*map(F.lit, widths.values())), F.col(TAG) - 1))
        )
    size, before = F.col("size"), F.col("before")
    after = size + before
    keyed, complete = F.col("held") > 0, F.col("held") == F.col("width")

    def one(test: Column, count: Column) -> Column:
        return (test & (count == 1)).cast("long")

    def weighted(count: Column) -> Column:
        return F.when(keyed & (count > 0), count * F.ln(count)).otherwise(0.0)

    parts = {
        "rows": size,
        "keyed": F.when(keyed, size).otherwise(0),
        "groups": (before == 0).cast("long"),
        "distinct": (keyed & (before == 0)).cast("long"),
        "single": one(keyed, after) - one(keyed, before),
        "single_complete": one(complete, after) - one(complete, before),
        "n_ln_n": weighted(after) - weighted(before),
    }
    return both.groupBy(*map(ref, by), SET).agg(*[F.sum(parts[p]).alias(p) for p in PARTS])


def statistics_of_totals() -> Mapping[str, Column]:
    """The statistics of ``grouped.statistics`` from totals."""
    keyed = F.col("keyed")
    return {
        "uniqueness": F.try_divide("single", "keyed"),
        "distinctness": F.try_divide("distinct", "keyed"),
        "unique_value_ratio": F.try_divide("single", "distinct"),
        "distinct": F.col("distinct"),
        "primary_key": F.try_divide("single_complete", "rows"),
        "entropy": F.when(keyed > 0, F.ln(keyed) - F.col("n_ln_n") / keyed),
        "bins": F.col("groups"),
    }


class KeyedState:
    """Group sizes and totals in a folder."""

    def __init__(self, spark: SparkSession, path: str, by: Sequence[str] = ()):
        self.spark, self.path, self.by = spark, path.rstrip("/"), tuple(by)

    def _base(self, before: int) -> tuple[int, str | None]:
        """The newest base that holds only batches before this one: its last batch and its folder."""
        bases = read_path(self.spark, f"{self.path}/bases")
        newest = bases and bases.where(F.col("upto") < before).orderBy(F.desc("upto"), "folder").first()
        return (newest["upto"], newest["folder"]) if newest else (-1, None)

    def _read(self, path: str) -> DataFrame:
        return self.spark.read.option("mergeSchema", "true").parquet(path)

    def sizes(self, before: int) -> DataFrame | None:
        """Group sizes of all batches before this one, in parts that add up."""
        upto, folder = self._base(before)
        parts = [] if folder is None else [self._read(folder)]
        if before > upto + 1:
            batches = read_path(self.spark, f"{self.path}/sizes")
            if batches is not None:
                batches = self._read(f"{self.path}/sizes")
                own = batches.where((F.col(BATCH) > upto) & (F.col(BATCH) < before)).drop(BATCH)
                parts.append(own)
        if not parts:
            return None
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)

    def add(self, batch: DataFrame, metrics: Sequence[Metric], batch_id: int) -> None:
        """Takes in the groups of a batch; a batch that is added again replaces itself."""
        own = f"{self.path}/sizes/{BATCH}={batch_id}"
        earlier = self.sizes(batch_id)
        batch_sizes(batch, metrics, self.by).write.mode("overwrite").parquet(own)
        new = self.spark.read.parquet(own)
        widths = {set_name(m): len(m.keys) for m in metrics}
        difference = added(new, earlier, widths, self.by).hint("rebalance")
        difference.write.mode("overwrite").parquet(f"{self.path}/totals/{BATCH}={batch_id}")

    def metrics(self, metrics: Sequence[Metric], names: Sequence[str], upto: int) -> DataFrame:
        """``by`` columns and each metric over all batches up to this one under its name."""
        by = list(map(ref, self.by))
        totals = self.spark.read.parquet(f"{self.path}/totals").where(F.col(BATCH) <= upto)
        whole = totals.groupBy(*by, SET).agg(*[F.sum(p).alias(p) for p in PARTS])
        found = statistics_of_totals()
        values = []
        for m, name in zip(metrics, names):
            value = F.max(F.when(F.col(SET) == set_name(m), found[m.identity[0]]))
            if m.identity[0] in COUNTS:
                value = F.coalesce(value, F.lit(0))
            values.append(value.cast("double").alias(name))
        return whole.groupBy(*by).agg(*values)

    def compact(self, upto: int) -> None:
        """Sums up the sizes of all batches up to this one; later batches read the sums."""
        sizes = self.sizes(upto + 1)
        if sizes is None:
            return
        keys = [c for c in sizes.columns if c != "size"]
        folder = f"{self.path}/base/{uuid.uuid4().hex}"
        sizes.groupBy(*map(ref, keys)).agg(F.sum("size").alias("size")).write.parquet(folder)
        pointer = self.spark.range(0, 1, 1, 1).select(F.lit(upto).alias("upto"), F.lit(folder).alias("folder"))
        pointer.write.mode("append").parquet(f"{self.path}/bases")
