"""Exact quantiles by refining ranges: no sort, no gathered values.

The value of a rank lies somewhere between the least and the greatest. A pass counts the rows in each of
``buckets`` equal parts of that range, with the least and greatest value that each part really has; the
part that holds the rank is the next range. Tasks count before the shuffle, so a pass hands on a row
per part and task, whatever the number of rows and however many share one value. A range whose least and
greatest value are one is the answer. Since both ends of a range fall into different parts, every pass
narrows it, usually by the number of parts.

All quantiles asked for share the passes: where they lie in different ranges, these are apart.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from plumbline.functions.columns import is_numeric, ref
from plumbline.operators.metric import FRAME, Metric, RuleError

BUCKETS = 1024


def _offset(value: Column, low: Column, dtype: T.DataType) -> Column:
    """How far a value lies above the least one, as a double that is 0 for that one only."""
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        # halves first, as the difference of two doubles may be beyond all doubles
        return value.cast("double") / 2 - low.cast("double") / 2
    whole = dtype if isinstance(dtype, T.DecimalType) else T.DecimalType(20, 0)
    wide = T.DecimalType(min(38, whole.precision + 1), whole.scale)
    return (value.cast(wide) - low.cast(wide)).cast("double")


def exact_quantiles(df: DataFrame, col: str, quantiles: Sequence[float], buckets: int = BUCKETS) -> list:
    """For each share the least value that as large a share of the values does not exceed; None of no values.

    NULL and NaN are no values.
    """
    dtype = df.schema[col].dataType
    if not is_numeric(dtype):
        raise RuleError(f"column {col!r} is not numeric")
    if any(not 0 <= q <= 1 for q in quantiles):
        raise RuleError("a quantile lies between 0 and 1")
    values = df.select(ref(col).alias("v")).where("v IS NOT NULL")
    finite = F.lit(True)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        # adding zero makes one value of both zeros
        values = values.where(~F.isnan("v")).select((F.col("v") + F.lit(0).cast(dtype)).alias("v"))
        finite = F.abs("v") < float("inf")
    inside = F.when(finite, F.col("v"))
    whole = values.agg(
        F.count("v").alias("n"),
        F.count_if(~finite & (F.col("v") < 0)).alias("below"),
        F.count_if(~finite & (F.col("v") > 0)).alias("above"),
        F.min(inside).alias("low"),
        F.max(inside).alias("high"),
    ).first()
    n, below = whole["n"], whole["below"]
    if not n:
        return [None] * len(quantiles)
    values = values.where(finite)
    # of each quantile its rank within its range, counted from 1
    wanted = []
    for q in quantiles:
        rank = max(1, math.ceil(q * n))
        if rank <= below:
            wanted.append((rank, (-math.inf, -math.inf)))
        elif rank > n - whole["above"]:
            wanted.append((rank, (math.inf, math.inf)))
        else:
            wanted.append((rank - below, (whole["low"], whole["high"])))
    while open_ := sorted({r for _, r in wanted if r[0] != r[1]}):
        number = F.lit(None).cast("int")
        part = F.lit(None).cast("int")
        for i, (low, high) in enumerate(open_):
            lo, hi = F.lit(low).cast(dtype), F.lit(high).cast(dtype)
            inside = F.col("v").between(lo, hi)
            share = _offset(F.col("v"), lo, dtype) / _offset(hi, lo, dtype)
            number = F.when(inside, F.lit(i)).otherwise(number)
            part = F.when(inside, F.least(F.floor(share * buckets), F.lit(buckets - 1)).cast("int")).otherwise(part)
        counted = (
            values.select("v", number.alias("range"), part.alias("part"))
            .where("range IS NOT NULL")
            .groupBy("range", "part")
            .agg(F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        )
        parts: dict[int, list] = {}
        for row in sorted(counted.collect(), key=lambda r: (r["range"], r["part"])):  # a row per part of a range
            parts.setdefault(row["range"], []).append(row)
        narrowed = []
        for rank, own in wanted:
            if own[0] != own[1]:
                for row in parts[open_.index(own)]:
                    if rank <= row["n"]:
                        own = (row["low"], row["high"])
                        break
                    rank -= row["n"]
            narrowed.append((rank, own))
        wanted = narrowed
    return [own[0] for _, own in wanted]


def exact_quantile(col: str, q: float) -> Metric:
    def build(df: DataFrame, by: Sequence[str]) -> DataFrame:
        if by:
            raise RuleError("an exact quantile is not taken per partition")
        (value,) = exact_quantiles(df, col, [q])
        return df.sparkSession.range(0, 1, 1, 1).select(F.lit(value).cast("double").alias("metric"))

    return Metric(FRAME, ("exact_quantile", col, q), (col,), build=build)
