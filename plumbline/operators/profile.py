"""Column profiles: one row per column.

Plain aggregates of all columns in one code-generated aggregate, and sketches (distinct
counts, quantiles) in another; both yield one row per column. Which text columns read as
numbers depends on the first, so those rows (one per column) come to the driver. Values are
counted of the columns that have few, as the sketches tell, or that the caller names: all of them in one
shuffle, and they stay rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from plumbline.functions.columns import (
    compact_key,
    identifier,
    is_flat,
    is_numeric,
    is_string,
    literal,
    mean_sql,
    ref,
    sum_sql,
)
from plumbline.functions.predicates import shape_sql
from plumbline.functions.rows import rows_frame
from plumbline.scratch import scratch_path

RSD = 0.05
QUANTILES = [i / 100 for i in range(1, 101)]
KLL_K = 800
# Numeric statistics and the aggregates they are, none of which overflows.
NUMBERS = {
    "minimum": "CAST(min({c}) AS DOUBLE)".format,
    "maximum": "CAST(max({c}) AS DOUBLE)".format,
    "mean": lambda c: mean_sql(c),
    "sum": lambda c: sum_sql(c),
    "std_dev": "stddev_pop(CAST({c} AS DOUBLE))".format,
}
# Aggregates of one pass, below the code generator's limit of 100 fields, and of one column.
PER_PASS, PER_NUMBER, PER_TEXT, PER_OTHER = 80, 10, 5, 2
SKETCHED_COLUMNS = 36
# Values up to which a column counts as one of few.
MAX_COUNTED = 120

_SUMMARY = (
    "column_name string, data_type string, is_inferred boolean, rows bigint, cells bigint, "
    "nans bigint, boolean bigint, fractional bigint, integral bigint, minimum double, maximum double, "
    "mean double, sum double, std_dev double, approx_distinct bigint, "
    "approx_percentiles array<double>"
)


def _struct(parts: dict[str, str]) -> Column:
    """One SQL expression per column of the table keeps building the plan cheap."""
    return F.expr(f"struct({', '.join(f'{sql} AS {name}' for name, sql in parts.items())})")


def _kind(dtype: T.DataType) -> str:
    """Profile kind of a typed column."""
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "Integral"
    if is_numeric(dtype):
        return "Fractional"
    if isinstance(dtype, T.BooleanType):
        return "Boolean"
    if is_string(dtype):
        return "String"
    return "Unknown"


def _plain(field: T.StructField) -> Column:
    c = identifier(field.name)
    parts = {
        "column_name": literal(field.name),
        "schema_type": literal(_kind(field.dataType)),
        "rows": "count(1)",
        "cells": f"count({c})",
        "nans": "0L",
        "boolean": "CAST(NULL AS BIGINT)",
        "fractional": "CAST(NULL AS BIGINT)",
        "integral": "CAST(NULL AS BIGINT)",
        **dict.fromkeys(NUMBERS, "CAST(NULL AS DOUBLE)"),
    }
    if is_string(field.dataType):
        parts |= {name: f"count_if({test})" for name, test in shape_sql(c).items()}
    if is_numeric(field.dataType):
        if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            parts["nans"] = f"count_if(isnan({c}))"
            c = f"nullif({c}, CAST('NaN' AS {field.dataType.simpleString()}))"
        parts |= {name: call(c=c) for name, call in NUMBERS.items()}
    return _struct(parts)


def _weight(field: T.StructField) -> int:
    """Aggregates that a column takes."""
    if is_numeric(field.dataType):
        return PER_NUMBER
    return PER_TEXT if is_string(field.dataType) else PER_OTHER


def _sketches(field: T.StructField, rsd: float) -> Column:
    c = identifier(field.name)
    parts = {
        "column_name": literal(field.name),
        "approx_distinct": "CAST(NULL AS BIGINT)",
        "approx_percentiles": "CAST(NULL AS ARRAY<DOUBLE>)",
    }
    if is_flat(field.dataType):
        parts["approx_distinct"] = f"approx_count_distinct({c}, {rsd}D)"
    if is_numeric(field.dataType):
        sketch = f"kll_sketch_agg_double(CAST({c} AS DOUBLE), {KLL_K})"
        ranks = f"array({', '.join(f'{q}D' for q in QUANTILES)})"
        # Sketches pass over NULL and NaN, and an empty one cannot be read.
        taken = f"{c} IS NOT NULL AND NOT isnan(CAST({c} AS DOUBLE))"
        parts["approx_percentiles"] = (
            f"CASE WHEN count_if({taken}) > 0 THEN kll_sketch_get_quantile_double({sketch}, {ranks}) END"
        )
    return _struct(parts)


def _rows(df: DataFrame, structs: Sequence[Column], weights: Sequence[int], most: int) -> DataFrame:
    """One aggregate per ``most`` weights, each reading only its own columns."""
    passes: list[list[Column]] = []
    room = 0
    for struct, weight in zip(structs, weights):
        if weight > room:
            passes.append([])
            room = most
        passes[-1].append(struct)
        room -= weight
    parts = [
        df.agg(F.array(*own).alias("_rows")).select(F.inline("_rows")) for own in passes
    ]
    united = parts[0]
    for part in parts[1:]:
        united = united.unionByName(part)
    return united


def _inferred() -> Column:
    """Kind of a string column from the shapes of its values."""
    boolean, fractional, integral = F.col("boolean"), F.col("fractional"), F.col("integral")
    number = fractional + integral
    return (
        F.when(F.col("schema_type") != "String", F.col("schema_type"))
        .when(F.col("cells") == 0, "Unknown")
        .when((boolean + number < F.col("cells")) | ((boolean > 0) & (number > 0)), "String")
        .when(boolean > 0, "Boolean")
        .when(fractional > 0, "Fractional")
        .otherwise("Integral")
    )


def summary(df: DataFrame, rsd: float = RSD) -> DataFrame:
    """First pass, lazily: one row per column without histograms."""
    fields = list(df.schema)
    plain = _rows(df, [_plain(f) for f in fields], list(map(_weight, fields)), PER_PASS)
    sketches = _rows(df, [_sketches(f, rsd) for f in fields], [1] * len(fields), SKETCHED_COLUMNS)
    found = _inferred()
    return (
        plain.join(sketches, "column_name")
        .withColumn("data_type", found)
        .withColumn(
            "is_inferred",
            (F.col("schema_type") == "String") & ~F.col("data_type").isin("String", "Unknown"),
        )
        .drop("schema_type")
        .select(*[c.split()[0] for c in _SUMMARY.split(", ")])
    )


def inferred_numbers(df: DataFrame, columns: Sequence[str], rsd: float = RSD) -> DataFrame:
    """Numeric statistics of string columns whose values all read as numbers."""
    numbers = df.select(*[ref(c).try_cast("double").alias(c) for c in columns])
    return summary(numbers, rsd).select("column_name", *NUMBERS, "approx_percentiles")


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column_name, value, count)`` of the given columns in one shuffle; NULL is a value."""
    texts = df.select(*[ref(c).cast("string").alias(c) for c in columns])
    long = texts.unpivot([], list(map(ref, columns)), "column_name", "value")
    return long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("count"))


def few_valued(df: DataFrame, profiled: DataFrame | None = None, most: int = MAX_COUNTED) -> list[str]:
    """Columns that seem to have ``most`` values at most: by the profile's estimate, with room for its error."""
    fitting = [f.name for f in df.schema if is_flat(f.dataType)]
    if profiled is None:
        rows = df.agg(F.array(*[F.approx_count_distinct(ref(c), RSD) for c in fitting]).alias("n")).first()
        estimates = dict(zip(fitting, rows["n"] if fitting else ()))
    else:
        estimates = {r.column_name: r.approx_distinct for r in profiled.select("column_name", "approx_distinct").collect()}
    return [c for c in fitting if (estimates.get(c) or 0) <= most * (1 + 4 * RSD)]


def counted_values(df: DataFrame, profiled: DataFrame | None = None, most: int = MAX_COUNTED) -> DataFrame:
    """``value_counts`` of all columns of few values, whatever their type; no column need be named.

    An estimate picks the columns, one pass counts the values of these, and what has more than ``most``
    after all is left out. The counts, a few rows, are written once, since several readers follow.
    """
    columns = few_valued(df, profiled, most)
    if not columns:
        return df.sparkSession.createDataFrame([], "column_name string, value string, count bigint")
    path = scratch_path(df.sparkSession, "value_counts")
    value_counts(df, columns).coalesce(1).write.parquet(path)
    counts = df.sparkSession.read.schema("column_name string, value string, count bigint").parquet(path)
    sizes = counts.groupBy("column_name").agg(F.count("value").alias("n"))
    over = [r.column_name for r in sizes.where(F.col("n") > most).collect()]  # some columns' names
    return counts.where(~F.col("column_name").isin(over)) if over else counts


def heavy_hitters(df: DataFrame, share: float, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column_name, value, count, ratio)``: every value that at least a share of the rows have, with its exact count.

    However many values a column has: a frequent-items sketch per column, merged over tasks, keeps every value
    that is twice its error frequent, so none is missed; what it keeps (about ``8 / share`` values a column) is
    counted exactly in a second scan, in which nothing else is shuffled. Long texts go by digest in both.
    """
    if not 0 < share <= 1:
        raise ValueError("a share lies between 0 and 1")
    names = [f.name for f in df.schema if is_flat(f.dataType)] if columns is None else list(columns)
    texts = df.select(
        *[ref(c).cast("string").alias(c) for c in names],
        *[compact_key(ref(c).cast("string"), T.StringType()).alias(f"_key{i}") for i, c in enumerate(names)],
    )
    tracked = min(1_000_000, math.ceil(8 / share))
    sketches = [F.expr(f"approx_top_k(_key{i}, {tracked}, {tracked})").alias(f"_top{i}") for i in range(len(names))]
    row = texts.agg(F.count(F.lit(1)).alias("n"), *sketches).first()
    found = [(i, x["item"]) for i in range(len(names)) for x in row[f"_top{i}"] or () if x["item"] is not None]
    kept = df.sparkSession.createDataFrame(found, "_column int, _key string")
    cells = [F.struct(F.lit(i).alias("_column"), F.col(f"_key{i}").alias("_key"), ref(c).alias("value")) for i, c in enumerate(names)]
    counted = (
        texts.select(F.inline(F.array(*cells)))
        .join(F.broadcast(kept), ["_column", "_key"])  # 8 / share rows a column
        .groupBy("_column", "_key")
        .agg(F.count(F.lit(1)).alias("count"), F.first("value").alias("value"))
    )
    name = F.get(F.array(*map(F.lit, names)), F.col("_column"))
    ratio = F.col("count") / F.lit(row["n"])
    return counted.where(F.col("count") >= share * row["n"]).select(name.alias("column_name"), "value", "count", ratio.alias("ratio"))


def histograms(
    df: DataFrame, columns: Sequence[str] | None = None, profiled: DataFrame | None = None, most: int = MAX_COUNTED
) -> DataFrame:
    """``(column_name, value, count, ratio)``: every bin of the columns of few values, or of the named ones.

    Ratios are over all rows; NULL is a bin.
    """
    rows = df.agg(F.count(F.lit(1))).scalar()
    counts = counted_values(df, profiled, most) if columns is None else value_counts(df, columns)
    return counts.withColumn("ratio", F.col("count") / rows)


def profile(df: DataFrame, counted: Sequence[str] = (), rsd: float = RSD) -> DataFrame:
    """One row per column, sorted by name.

    ``counted``: columns whose values are counted, for an exact ``distinct``; ``value_counts``
    and ``histograms`` give the values themselves, whole. ``is_counted`` says which they were.
    Numeric statistics are those of the numbers; NaN counts in ``nans`` alone.
    """
    spark = df.sparkSession
    rows = sorted(summary(df, rsd).collect(), key=lambda r: r.column_name)  # one row per column
    first = rows_frame(spark, rows, _SUMMARY)

    numeric_texts = [
        r.column_name for r in rows if r.is_inferred and r.data_type in ("Integral", "Fractional")
    ]
    if numeric_texts:
        names = (*NUMBERS, "approx_percentiles")
        numbers = inferred_numbers(df, numeric_texts, rsd)
        numbers = numbers.withColumnsRenamed({n: f"_{n}" for n in names})
        first = (
            first.join(numbers, "column_name", "left")
            .withColumns({n: F.coalesce(n, f"_{n}") for n in names})
            .drop(*[f"_{n}" for n in names])
        )

    if counted:
        # by digest where texts are long: how many there are is asked, not which
        keys = df.select(*[compact_key(ref(c), df.schema[c].dataType).alias(c) for c in counted])
        exact = value_counts(keys, counted).groupBy("column_name").agg(F.count("value").alias("distinct"))
        first = first.join(exact, "column_name", "left")
    else:
        first = first.withColumn("distinct", F.lit(None).cast("bigint"))

    text = F.col("boolean").isNotNull()
    shapes = F.map_from_arrays(
        F.array(*[F.lit(n) for n in ("Boolean", "Fractional", "Integral", "String", "Unknown")]),
        F.array(
            "boolean",
            "fractional",
            "integral",
            F.col("cells") - F.col("boolean") - F.col("fractional") - F.col("integral"),
            F.col("rows") - F.col("cells"),
        ),
    )
    numeric = F.col("data_type").isin("Integral", "Fractional")
    found = first.select(
        "column_name",
        F.when(numeric, "Numeric").otherwise("Standard").alias("profile_type"),
        "data_type",
        F.col("is_inferred").alias("is_data_type_inferred"),
        "rows",
        "cells",
        F.try_divide("cells", "rows").alias("completeness"),
        "approx_distinct",
        "distinct",
        F.col("column_name").isin(*counted).alias("is_counted") if counted else F.lit(False).alias("is_counted"),
        "nans",
        F.when(text, shapes).alias("type_counts"),
        "minimum",
        "maximum",
        "mean",
        "sum",
        "std_dev",
        "approx_percentiles",
    )
    # without a join the rows are in order as they are
    return found.orderBy("column_name") if numeric_texts or counted else found
