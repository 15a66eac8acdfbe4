"""Shared by the operators: rows through Arrow, written steps, checked names."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from itertools import chain
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from plumbline.scratch import scratch_path

#: Prefix of the columns an operator adds for itself, so that no column of the input is hidden.
OWN = "__own_"


def mapped(df: DataFrame) -> DataFrame:
    """The frame, about to be mapped in Python: workers that see this folder find the package in it.

    A cluster without a shared folder for code gets the package by ``--py-files``.
    """
    environment = df.sparkSession.sparkContext.environment
    root = str(Path(__file__).resolve().parents[2])
    known = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([*known, root])
    return df


def kind(df: DataFrame, column: str) -> T.DataType:
    """The type of a column, names compared as Spark compares them."""
    return df.select(column).schema[0].dataType


def text_rows(df: DataFrame, key: str, text: str) -> DataFrame:
    """The two columns an operator reads, under fixed names."""
    return df.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: lineage ends there, a lost executor costs nothing before it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def raw(column: pa.Array) -> list[bytes | None]:
    """The bytes of a text column, as they are stored, be they UTF-8 or not."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def strings(column: pa.Array) -> list[str | None]:
    """The texts of a column; bytes that are no UTF-8 become U+FFFD, as Spark's own functions read them."""
    try:
        return column.to_pylist()
    except UnicodeDecodeError:
        return [None if b is None else b.decode("utf-8", "replace") for b in raw(column)]


def _text(dtype: pa.DataType) -> bool:
    return pa.types.is_string(dtype) or pa.types.is_large_string(dtype)


def decodable(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The batch, with U+FFFD for what is no UTF-8 in its text columns.

    Spark reads such bytes from Parquet without complaint, and hands them on; Python cannot decode them.
    """
    columns = list(batch.columns)
    for i, column in enumerate(columns):
        if _text(column.type):
            try:
                column.validate(full=True)
            except pa.ArrowInvalid:
                columns[i] = pa.array(strings(column), type=column.type)
    return pa.RecordBatch.from_arrays(columns, schema=batch.schema)


def map_batches(
    df: DataFrame,
    make: Callable[[], Callable[[pa.RecordBatch | None], Iterator[dict] | dict | None]],
    schema: T.StructType,
    finish: bool = False,
    as_stored: bool = False,
) -> DataFrame:
    """Each Arrow batch through a function made once per task; it gives columns as lists or arrays.

    With ``finish`` the function is called once more, with None, after a task's last batch. Texts are
    decodable, unless the function asks for them ``as_stored`` and reads them by ``raw`` or ``strings``.
    """
    arrow = T_to_arrow(schema)

    def run(batches):
        work = make()
        for batch in chain(batches, [None]) if finish else batches:
            made = work(batch if batch is None or as_stored else decodable(batch))
            for columns in [made] if isinstance(made, dict) else made or ():
                yield pa.RecordBatch.from_arrays(
                    [
                        c if isinstance(c, pa.Array) else pa.array(c, type=f.type)
                        for c, f in zip((columns[f.name] for f in arrow), arrow)
                    ],
                    schema=arrow,
                )

    return mapped(df).mapInArrow(run, schema)


def T_to_arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def fold(key: Column, parts: int) -> Column:
    """The fold of a key: CRC-32 of its text, modulo the number of folds."""
    return F.pmod(F.crc32(F.encode(key.cast("string"), "UTF-8")), F.lit(parts))
