"""Small Column helpers used everywhere in the package."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, functions as F, types as T

NUMERIC = (
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
    T.DecimalType,
)
STRING = (T.StringType, T.CharType, T.VarcharType)
# The collation under which texts are equal if their bytes are.
BINARY = "UTF8_BINARY"


def ref(name: str) -> Column:
    """Top-level column by its exact name, whatever characters it holds."""
    return F.col(identifier(name))


def identifier(name: str) -> str:
    """A column name as it is written in an SQL expression."""
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    """A text as it is written in an SQL expression."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def share(predicate: Column) -> Column:
    """Aggregate: rows meeting ``predicate`` over all rows; NULL on no rows.

    A NULL predicate counts as not met.
    """
    return F.try_divide(F.count_if(predicate), F.count(F.lit(1)))


def every(predicates: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, predicates)


def some(predicates: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, predicates)


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, NUMERIC)


def is_string(dtype: T.DataType) -> bool:
    return isinstance(dtype, STRING)


def is_flat(dtype: T.DataType) -> bool:
    """Types that can be grouped on and shown as one text value."""
    return not isinstance(
        dtype, (T.ArrayType, T.MapType, T.StructType, T.BinaryType, T.VariantType)
    )


# Bytes up to which a text is not longer than its digest.
LONG_TEXT = 64


def compact_key(c: Column, dtype: T.DataType) -> Column:
    """Grouping key that is equal where the values are: long texts give way to their SHA-256.

    A digest is longer than the longest text kept, so it equals no such text; shuffles
    then carry at most 68 bytes per text in place of whole documents. NULL stays NULL.
    A text under a collation is grouped by itself at any length, since texts of different
    bytes may be equal there.
    """
    if not is_string(dtype) or getattr(dtype, "collation", BINARY) != BINARY:
        return c
    digest = F.concat(F.lit("sha:"), F.sha2(c, 256))
    return F.when(F.octet_length(c) > LONG_TEXT, digest).otherwise(c)


def sum_sql(c: str) -> str:
    """Sum as a double, in SQL: exact as long as the column's own type holds it, never an overflow."""
    return f"coalesce(CAST(try_sum({c}) AS DOUBLE), sum(CAST({c} AS DOUBLE)))"


def mean_sql(c: str) -> str:
    """Mean as a double, in SQL, likewise."""
    return f"coalesce(CAST(try_avg({c}) AS DOUBLE), avg(CAST({c} AS DOUBLE)))"


def typed(value: object, dtype: T.DataType) -> Column:
    """Literal in the type of the column it is compared with.

    A text that the type cannot hold becomes NULL, so it equals nothing.
    """
    if is_string(dtype):
        return F.lit(str(value))
    return F.lit(str(value)).try_cast(dtype)
