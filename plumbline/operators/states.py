"""Metrics from partial states: each part of a data set (file, micro-batch) is read once.

What a part keeps of a metric is a few numbers or a sketch (``metric.State``), written as one row per
part and metric. Rows of all parts merge into the metric of the whole: counts, sums and extremes by
themselves, means and centred sums by their deviations from the common mean, distinct-value and quantile
sketches by the union of sketches. The parts' data is not read again.

Exact metrics come out as over the whole, up to the order of floating-point sums; sketches keep their
bounds.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from plumbline.functions.columns import ref
from plumbline.operators.metric import SCAN, SKETCH, Metric

# Fields of a state row and how they merge; centred sums need the common means first.
MERGED = {
    "n": (T.LongType(), F.sum),
    "hits": (T.LongType(), F.sum),
    "total": (T.DoubleType(), F.sum),
    "low": (T.DoubleType(), F.min),
    "high": (T.DoubleType(), F.max),
    "hll": (T.BinaryType(), F.hll_union_agg),
    "kll": (T.BinaryType(), F.kll_merge_agg_double),
}
CENTRED = ("mean_a", "square_a", "mean_b", "square_b", "product")
TYPES = {n: t for n, (t, _) in MERGED.items()} | {n: T.DoubleType() for n in CENTRED}
METRIC = "metric_id"
# Aggregates of one pass, below the code generator's limit of 100 fields.
PER_PASS = 80


def identity(metric: Metric) -> str:
    """The metric as it is named in stored states, the same in every run."""
    return f"{metric.family} {metric.identity!r}"


def mergeable(metrics: Sequence[Metric]) -> list[Metric]:
    return [m for m in metrics if m.state is not None]


def _row(metric: Metric) -> Column:
    fields = [F.lit(identity(metric)).alias(METRIC)]
    for name, dtype in TYPES.items():
        given = metric.state.fields.get(name)
        fields.append((F.lit(None) if given is None else given).cast(dtype).alias(name))
    return F.struct(*fields)


def partial_states(df: DataFrame, metrics: Sequence[Metric], parts: Sequence[str]) -> DataFrame:
    """A row per part and metric; ``parts`` are columns of ``df`` that tell the parts apart."""
    keys = list(map(ref, parts))
    passes: list[list[Metric]] = []
    for family in (SCAN, SKETCH):  # sketches would take generated code away from plain aggregates
        room = 0
        for m in sorted((m for m in metrics if m.family == family), key=lambda m: m.columns):
            if len(m.state.fields) > room:
                passes.append([])
                room = PER_PASS
            passes[-1].append(m)
            room -= len(m.state.fields)
    rows = [
        df.groupBy(*keys).agg(F.array(*map(_row, own)).alias("_rows")).select(*keys, F.inline("_rows"))
        for own in passes
    ]
    return reduce(DataFrame.unionByName, rows)


def merged_states(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per metric (and part of ``by``) with the fields of the whole."""
    keys = [*map(ref, by), F.col(METRIC)]

    def common(mean: str) -> Column:
        return F.try_divide(F.sum(F.col("n") * F.col(mean)), F.sum(F.when(F.col(mean).isNotNull(), F.col("n"))))

    means = states.where("mean_a IS NOT NULL").groupBy(*keys).agg(
        common("mean_a").alias("_common_a"), common("mean_b").alias("_common_b")
    )
    same = [states[k].eqNullSafe(means[k]) for k in (*by, METRIC)]
    centred = states.join(means, reduce(Column.__and__, same), "left").select(states["*"], "_common_a", "_common_b")
    off_a, off_b = F.col("mean_a") - F.col("_common_a"), F.col("mean_b") - F.col("_common_b")
    n = F.col("n")
    return centred.groupBy(*keys).agg(
        *[merge(name).alias(name) for name, (_, merge) in MERGED.items()],
        F.sum(F.col("square_a") + n * off_a * off_a).alias("square_a"),
        F.sum(F.col("square_b") + n * off_b * off_b).alias("square_b"),
        F.sum(F.col("product") + n * off_a * off_b).alias("product"),
    )


def metrics_of(states: DataFrame, metrics: Sequence[Metric], names: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``by`` columns and each metric of the merged states under its name."""
    ids = [identity(m) for m in metrics]
    value = F.lit(None).cast("double")
    for m, own in zip(metrics, ids):
        value = F.when(F.col(METRIC) == own, m.state.finish().cast("double")).otherwise(value)
    rows = merged_states(states.where(F.col(METRIC).isin(ids)), by).withColumn("_value", value)
    picked = [F.max(F.when(F.col(METRIC) == own, F.col("_value"))).alias(n) for own, n in zip(ids, names)]
    return rows.groupBy(*map(ref, by)).agg(*picked)
