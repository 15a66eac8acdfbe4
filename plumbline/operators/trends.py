"""Metrics over time: how far the newest change of a metric lies from the changes before it.

A series is one metric of one table (rule, part) with a point per run or period. What is judged is the
change against the point ``season`` points earlier (1: the run before; 7: the same day a week ago), so a
steady drift, of which every change is alike, is no deviation, and neither is a weekly pattern. The
``window`` changes before a point give what to expect: their median, and as a unit of spread their median
absolute deviation, scaled to a standard deviation; neither is moved by single outliers among them. The
unit is never less than ``tolerance`` of the point compared with, so that noise in a very steady metric counts
for little.

A point keeps at most ``window`` earlier changes beside it; a series is as long as there were runs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from plumbline.functions.columns import ref
from plumbline.operators.metric import FRAME, Metric

WINDOW, SEASON, LEAST, TOLERANCE = 14, 1, 5, 0.01
# Fixed value: median absolute deviation of a normal distribution to its standard deviation.
TO_SIGMA = 1.4826


def median(values: Column) -> Column:
    """Median of an array of numbers; NULL of an empty one."""
    ordered, n = F.sort_array(values), F.size(values)
    upper = F.get(ordered, F.floor(n / 2).cast("int"))
    lower = F.get(ordered, F.floor((n - 1) / 2).cast("int"))
    return F.when(n > 0, (lower + upper) / 2)


def deviations(
    points: DataFrame,
    keys: Sequence[str],
    run: str,
    metric: str,
    window: int = WINDOW,
    season: int = SEASON,
    least: int = LEAST,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """``keys``, run, metric, ``change``, ``expected``, ``spread`` and ``deviation``, a row per key and run.

    Rows of one key and run are one point, their mean; points without a run or without a number are none.
    ``deviation`` is NULL where fewer than ``least`` changes came before.
    """
    value = ref(metric).cast("double")
    named = points.select(*map(ref, keys), ref(run).alias("_run"), value.alias("_metric"))
    series = (
        named.where(F.col("_run").isNotNull() & F.col("_metric").isNotNull() & ~F.isnan("_metric"))
        .groupBy(*map(ref, keys), "_run")
        .agg(F.avg("_metric").alias("_metric"))
    )
    over = Window.partitionBy(*(list(map(ref, keys)) or [F.lit(0)])).orderBy("_run")
    before = F.lag("_metric", season).over(over)
    history = F.collect_list("change").over(over.rowsBetween(-window, -1))
    unit = F.greatest(F.lit(TO_SIGMA) * F.col("_mad"), F.lit(tolerance) * F.abs(F.col("_before")))
    off = F.abs(F.col("change") - F.col("expected"))
    return (
        series.withColumn("_before", before)
        .withColumn("change", F.col("_metric") - F.col("_before"))
        .withColumn("_history", history)
        .withColumn("expected", median(F.col("_history")))
        .withColumn("_mad", median(F.transform("_history", lambda c: F.abs(c - F.col("expected")))))
        .withColumn("spread", unit)
        .withColumn(
            "deviation",
            F.when(F.size("_history") < least, None)
            .when(off == 0, 0.0)
            .when(F.col("spread") == 0, float("inf"))
            .otherwise(F.try_divide(off, "spread")),
        )
        .select(
            *map(ref, keys),
            F.col("_run").alias(run),
            F.col("_metric").alias(metric),
            "change",
            "expected",
            "spread",
            "deviation",
        )
    )


def newest_deviation(
    df: DataFrame, aggregate: Column, period: Column, by: Sequence[str] = (), **options
) -> DataFrame:
    """Per part ``metric``: how far the aggregate of the newest period deviates; 0 while there is too little before it."""
    points = df.groupBy(*map(ref, by), period.alias("_period")).agg(aggregate.cast("double").alias("_value"))
    found = deviations(points, by, "_period", "_value", **options)
    newest = F.max_by(F.coalesce("deviation", F.lit(0.0)), "_period")
    return found.groupBy(*map(ref, by)).agg(newest.alias("metric"))


def metric_change(aggregate: str, period: str, columns: Sequence[str], **options) -> Metric:
    return Metric(
        FRAME,
        ("metric_change", aggregate, period, *options.items()),
        tuple(columns),
        build=lambda df, by: newest_deviation(df, F.expr(aggregate), F.expr(period), by, **options),
    )
