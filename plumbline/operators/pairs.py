"""Checks over two data sets.

Row-level comparisons are written as a union of both sides followed by grouped sums in
place of a join: both sides combine on the map side, so a key repeated millions of times
costs one partial row per task and never multiplies against its copies.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from plumbline.functions.columns import compact_key, every, is_string, ref
from plumbline.operators.grouped import key_names


def _texts(
    df: DataFrame, cols: Sequence[str], other: DataFrame, other_cols: Sequence[str]
) -> list[bool]:
    """Which column pairs are texts on both sides, and so may be compared by digest."""
    return [
        is_string(df.schema[a].dataType) and is_string(other.schema[b].dataType)
        for a, b in zip(cols, other_cols)
    ]


def _key(c: Column, text: bool) -> Column:
    return compact_key(c, T.StringType()) if text else c


def _integrity_by(
    df: DataFrame, cols: Sequence[str], parent: DataFrame, parent_cols: Sequence[str], by: Sequence[str]
) -> DataFrame:
    """The same per partition: its keys are counted first, so a key meets the parent once for each."""
    keys = key_names(len(cols))
    texts = _texts(df, cols, parent, parent_cols)
    child = df.select(
        *map(ref, by), *[_key(ref(c), t).alias(k) for c, k, t in zip(cols, keys, texts)]
    )
    complete = every(F.col(k).isNotNull() for k in keys)
    sizes = child.groupBy(*map(ref, by), *keys).agg(
        F.count_if(complete).alias("n")  # partitions without a complete key stay, with none
    )
    known = (
        parent.select(*[_key(ref(c), t).alias(k) for c, k, t in zip(parent_cols, keys, texts)])
        .distinct()
        .withColumn("known", F.lit(1))
    )
    checked, matched = F.sum("n"), F.sum(F.when(F.col("known") == 1, F.col("n")).otherwise(0))
    return (
        sizes.join(known, keys, "left")
        .groupBy(*map(ref, by))
        .agg(
            checked.alias("checked"),
            matched.alias("matched"),
            F.try_divide(matched, checked).alias("metric"),
        )
    )


def referential_integrity(
    df: DataFrame,
    cols: Sequence[str],
    parent: DataFrame,
    parent_cols: Sequence[str],
    by: Sequence[str] = (),
) -> DataFrame:
    """``checked`` child rows with a complete key, those ``matched`` in the parent, ``metric``.

    ``by``: columns of the child to give a row for each part of; the parent stays whole.
    """
    if by:
        return _integrity_by(df, cols, parent, parent_cols, by)
    keys = key_names(len(cols))
    texts = _texts(df, cols, parent, parent_cols)

    def side(frame: DataFrame, names: Sequence[str], rows: int, known: int) -> DataFrame:
        return (
            frame.select(*[_key(ref(c), t).alias(k) for c, k, t in zip(names, keys, texts)])
            .where(every(F.col(k).isNotNull() for k in keys))
            .withColumns({"n": F.lit(rows).cast("long"), "known": F.lit(known)})
        )

    merged = (
        side(df, cols, 1, 0)
        .unionByName(side(parent, parent_cols, 0, 1))
        .groupBy(*keys)
        .agg(F.sum("n").alias("n"), F.max("known").alias("known"))
    )
    checked = F.coalesce(F.sum("n"), F.lit(0))
    matched = F.coalesce(F.sum(F.col("n") * F.col("known")), F.lit(0))
    return merged.agg(
        checked.alias("checked"),
        matched.alias("matched"),
        F.try_divide(matched, checked).alias("metric"),
    )


def row_count_match(df: DataFrame, other: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``rows``, ``reference_rows`` (of the whole reference) and their ratio as ``metric``."""
    counted = other.agg(F.count(F.lit(1))).scalar()
    return df.groupBy(*map(ref, by)).agg(F.count(F.lit(1)).alias("rows")).select(
        *map(ref, by),
        "rows",
        counted.alias("reference_rows"),
        F.try_divide(F.col("rows"), counted).alias("metric"),
    )


def aggregate_match(
    df: DataFrame, expression: str, other: DataFrame, other_expression: str, by: Sequence[str] = ()
) -> DataFrame:
    """``value``, ``reference_value`` (of the whole reference) and their ratio as ``metric``."""
    reference = other.agg(F.expr(other_expression).cast("double")).scalar()
    return df.groupBy(*map(ref, by)).agg(F.expr(expression).cast("double").alias("value")).select(
        *map(ref, by),
        "value",
        reference.alias("reference_value"),
        F.try_divide(F.col("value"), reference).alias("metric"),
    )


def dataset_match(
    df: DataFrame,
    other: DataFrame,
    keys: Sequence[str],
    match: Sequence[str] = (),
    by: Sequence[str] = (),
) -> DataFrame:
    """How far ``df`` agrees with the reference rows of ``other``, NULL equal to NULL.

    ``matched`` reference rows have a partner agreeing on ``match``; ``changed`` ones only
    on ``keys``; ``missing`` ones have none; ``extra`` rows stand in ``df`` alone. Copies
    of a key pair off one to one. ``by``: columns of both data sets, whose parts are compared
    with each other.
    """
    match = list(match) or [c for c in other.columns if c not in (*keys, *by)]
    cols = [*by, *[k for k in keys if k not in by], *[c for c in match if c not in by]]

    texts = _texts(df, cols, other, cols)

    def side(frame: DataFrame, in_reference: int) -> DataFrame:
        return frame.select(
            *[_key(ref(c), t).alias(c) for c, t in zip(cols, texts)],
            F.lit(in_reference).cast("long").alias("_r"),
            F.lit(1 - in_reference).cast("long").alias("_d"),
        )

    same = F.least("_r", "_d")
    rows = (
        side(other, 1)
        .unionByName(side(df, 0))
        .groupBy(*map(ref, cols))
        .agg(F.sum("_r").alias("_r"), F.sum("_d").alias("_d"))
        .withColumns({"_same": same, "_r": F.col("_r") - same, "_d": F.col("_d") - same})
    )
    # Rows without a remainder need no second look by key: they fold into one group.
    clean = (F.col("_r") == 0) & (F.col("_d") == 0)
    names = key_names(len(keys))
    per_key = (
        rows.withColumn("_clean", clean)
        .groupBy(
            *map(ref, by), "_clean", *[F.when(~clean, ref(k)).alias(n) for k, n in zip(keys, names)]
        )
        .agg(*[F.sum(c).alias(c) for c in ("_same", "_r", "_d")])
    )
    changed = F.least("_r", "_d")
    whole = per_key.groupBy(*map(ref, by)).agg(
        *[
            F.coalesce(F.sum(e), F.lit(0)).alias(n)
            for n, e in {
                "matched": F.col("_same"),
                "changed": changed,
                "missing": F.col("_r") - changed,
                "extra": F.col("_d") - changed,
            }.items()
        ]
    )
    reference_rows = F.col("matched") + F.col("changed") + F.col("missing")
    return whole.select("*", F.try_divide(F.col("matched"), reference_rows).alias("metric"))


# Buckets of one level of a digest tree as a power of two, its levels, and differing buckets that are looked into.
DIGEST_BITS, DIGEST_LEVELS, DIGEST_OPEN = 10, 3, 1024


def _hashable(c: Column, dtype: T.DataType) -> Column:
    """Equal numbers hash alike: adding zero makes one value of both zeros."""
    return c + F.lit(0).cast(dtype) if isinstance(dtype, (T.FloatType, T.DoubleType)) else c


def _differing(rows: DataFrame, bucket: Column) -> DataFrame:
    """Buckets whose rows are not the same on both sides, by order-free digests.

    A bucket's digest is its number of rows and the sums of the halves of two hashes of each row, with
    the reference's rows added and the others' taken away: a row per task and bucket is shuffled.
    """
    sign = F.col("_r") - F.col("_d")
    low, high = F.lit(0xFFFFFFFF), 32
    halves = [e for h in ("_h", "_g") for e in (F.col(h).bitwiseAND(low), F.shiftrightunsigned(h, high))]
    sums = [F.sum(sign).alias("s"), *[F.sum(sign * e).alias(f"s{i}") for i, e in enumerate(halves)]]
    digests = rows.groupBy(bucket.alias("_b")).agg(*sums)
    unequal = F.lit(False)
    for name in ("s", *[f"s{i}" for i in range(len(halves))]):
        unequal = unequal | (F.col(name) != 0)
    return digests.where(unequal).select("_b")


def digest_match(df: DataFrame, other: DataFrame, keys: Sequence[str], match: Sequence[str] = ()) -> DataFrame:
    """``dataset_match`` of two large tables that are mostly the same.

    Rows fall into buckets by a hash of their keys. Where the digests of a bucket agree, its rows do
    (but for a chance of about 2^-128 a bucket), and they all match; only differing buckets are parted
    further, level by level, and only their rows are compared one by one. Each level is one scan of both
    tables, of which no rows are shuffled. Looking stops where more than ``DIGEST_OPEN`` buckets differ.
    """
    match = list(match) or [c for c in other.columns if c not in keys]
    cols = [*keys, *[c for c in match if c not in keys]]
    texts = _texts(df, cols, other, cols)

    def side(frame: DataFrame, in_reference: int) -> DataFrame:
        own = [_key(ref(c), t).alias(c) for c, t in zip(cols, texts)]
        flags = [F.lit(in_reference).cast("long").alias("_r"), F.lit(1 - in_reference).cast("long").alias("_d")]
        return frame.select(*own, *flags)

    # united first, so that both sides are hashed in one type
    united = side(other, 1).unionByName(side(df, 0))
    values = [_hashable(ref(c), united.schema[c].dataType) for c in cols]
    # a hash passes over NULL, so which values are NULL is hashed too
    nulls = [v.isNull() for v in values]
    rows = united.withColumns(
        {
            "_k": F.xxhash64(*values[: len(keys)]),
            "_h": F.xxhash64(*values, *nulls),
            "_g": F.xxhash64(F.lit("second"), *nulls, *values),
        }
    )
    spark = df.sparkSession
    reference_rows = other.count()
    level, open_ = 0, None
    while level < DIGEST_LEVELS:
        bucket = F.col("_k").bitwiseAND((1 << DIGEST_BITS * (level + 1)) - 1)
        found = [r["_b"] for r in _differing(rows, bucket).limit(100_001).collect()]
        if len(found) > 100_000:
            break
        level, open_ = level + 1, found
        if not found or len(found) > DIGEST_OPEN or level == DIGEST_LEVELS:
            break
        own = spark.createDataFrame([(b,) for b in found], "_o bigint")
        rows = rows.join(F.broadcast(own), bucket == F.col("_o"), "left_semi")
    if open_ is None:  # nearly every bucket differs
        return dataset_match(df, other, keys, match)
    if open_:
        mask = (1 << DIGEST_BITS * level) - 1
        own = F.broadcast(spark.createDataFrame([(b,) for b in open_], "_o bigint"))
        left = rows.join(own, F.col("_k").bitwiseAND(mask) == F.col("_o"), "left_semi").select(*map(ref, cols), "_r")
    else:
        left = rows.where(F.lit(False)).select(*map(ref, cols), "_r")
    reference, rest = left.where("_r = 1").drop("_r"), left.where("_r = 0").drop("_r")
    compared = dataset_match(rest, reference, keys, match)
    looked_at = F.col("matched") + F.col("changed") + F.col("missing")
    matched = F.col("matched") + F.lit(reference_rows) - looked_at
    return compared.select(
        matched.alias("matched"),
        "changed",
        "missing",
        "extra",
        F.try_divide(matched, F.lit(reference_rows)).alias("metric"),
    )


def schema_conformance(df: DataFrame, other: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per column of ``other``: ``cells`` with a value in ``df`` and the share readable in its type."""
    present = set(df.columns)

    def row(field) -> Column:
        if field.name in present:
            cells = F.count(ref(field.name))
            readable = F.count_if(ref(field.name).try_cast(field.dataType).isNotNull())
        else:
            cells, readable = F.count(F.lit(None)), F.lit(0).cast("long")
        return F.struct(
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("expected_type"),
            F.lit(field.name in present).alias("present"),
            cells.alias("cells"),
            readable.alias("castable"),
        )

    rows = df.groupBy(*map(ref, by)).agg(F.array(*map(row, other.schema)).alias("rows"))
    share = F.when(~F.col("present"), 0.0).otherwise(F.try_divide("castable", "cells"))
    return rows.select(*map(ref, by), F.inline("rows")).withColumn("metric", share)


def schema_share(df: DataFrame, other: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One ``metric``: mean share over the columns; a column without values conforms."""
    per_column = schema_conformance(df, other, by)
    return per_column.groupBy(*map(ref, by)).agg(F.avg(F.coalesce("metric", F.lit(1.0))).alias("metric"))


def dropped_columns(df: DataFrame, expected: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Per partition ``by``, the ``expected`` columns that hold no value at all."""
    present = set(df.columns)
    counts = [
        F.struct(
            F.lit(c).alias("column_name"),
            (F.count(ref(c)) if c in present else F.count(F.lit(None))).alias("cells"),
        )
        for c in expected
    ]
    return (
        df.groupBy(*map(ref, by))
        .agg(F.array(*counts).alias("counts"))
        .select(*map(ref, by), F.inline("counts"))
        .where("cells = 0")
        .drop("cells")
    )


def custom_sql(
    spark: SparkSession, sql: str, datasets: Mapping[str, DataFrame]
) -> DataFrame:
    """Scalar result of a query as ``metric``; ``{name}`` stands for a data set.

    A query of several rows has no metric; ``error`` then says how many there are.
    """
    views = {}
    for name, frame in datasets.items():
        if "{" + name + "}" in sql:
            views[name] = f"plumbline_{uuid.uuid4().hex}"
            frame.createOrReplaceTempView(views[name])
            sql = sql.replace("{" + name + "}", views[name])
    try:
        result = spark.sql(sql)
        n, value = F.col("n"), F.col("value")
        rows = result.select(ref(result.columns[0]).try_cast("double").alias("value"))
        return rows.agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("value")).select(
            F.when(n == 1, value).alias("metric"),
            F.when(n > 1, F.format_string("the query gives %d rows, one is needed", n)).alias("error"),
        )
    finally:
        for view in views.values():
            spark.catalog.dropTempView(view)
