"""Bringing a table to the types declared in its warehouse."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from plumbline.functions.columns import ref
from plumbline.functions.ddl import spark_type


def cast_to_ddl(df: DataFrame, declared: Sequence[tuple[str, str]]) -> DataFrame:
    """The declared columns in their Spark types; what does not fit becomes NULL."""
    return df.select(*[ref(c).try_cast(spark_type(t)).alias(c) for c, t in declared])


def cast_losses(df: DataFrame, declared: Sequence[tuple[str, str]]) -> DataFrame:
    """Per declared column, how many values it holds and how many the type cannot hold."""
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(t).alias("ddl_type"),
            F.lit(spark_type(t)).alias("spark_type"),
            F.count(ref(c)).alias("cells"),
            F.count_if(
                ref(c).isNotNull() & ref(c).try_cast(spark_type(t)).isNull()
            ).alias("lost"),
        )
        for c, t in declared
    ]
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))
