"""Data sets to be judged, and where their rows came from."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plumbline.functions.columns import ref

# Conditions under which a path holds no data, as opposed to being misused.
NO_DATA = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "TABLE_OR_VIEW_NOT_FOUND"}


def read_path(spark: SparkSession, path: str) -> DataFrame | None:
    """Parquet folder as a DataFrame; None when there is nothing to read."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in NO_DATA:
            return None
        raise


def read_table(spark: SparkSession, database: str, table: str) -> DataFrame | None:
    try:
        return spark.table(f"`{database}`.`{table}`")
    except AnalysisException as error:
        if error.getCondition() in NO_DATA:
            return None
        raise


def read_sql(spark: SparkSession, sql: str) -> DataFrame:
    return spark.sql(sql)


def read_source(spark: SparkSession, source: Mapping) -> DataFrame | None:
    """A path, a catalog table or a query, told apart by the key it is given under."""
    for key, value in source.items():
        if key == "SQL":
            return read_sql(spark, value["SQL"] if isinstance(value, Mapping) else value)
        if key.endswith("Table"):
            return read_table(spark, value["DatabaseName"], value["TableName"])
        if key.endswith(("Path", "Url")):
            return read_path(spark, value)
    raise ValueError(f"no path, table or query in data source {dict(source)!r}")


def read_partition(
    spark: SparkSession, base: str, table: str, template: str, batch_id: str
) -> DataFrame | None:
    """The part of a table that a batch delivered.

    ``Dyymmdd`` in the template stands for the last dot-separated part of the batch id;
    the filter on the partition column prunes the folders listed and read.
    """
    df = read_path(spark, f"{base}/{table}")
    if df is None:
        return None
    return df.where(F.col("partition") == partition_name(template, batch_id))


def partition_name(template: str, batch_id: str) -> str:
    return template.replace("Dyymmdd", batch_id.split(".")[-1])


def _path_parts(path: Column) -> Column:
    """Parts of a file path as named on disk; the path column comes URL-encoded."""
    decoded = F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.split(F.coalesce(decoded, path), "/")


def tag_origin(
    df: DataFrame, table_part: int = 4, partition_count: int = 1, file_path: Column | None = None
) -> DataFrame:
    """Adds ``table_name`` and ``partition_0..n`` taken from each row's file path.

    ``table_part`` counts the parts of the reported path from 0 (in ``s3a://lake/folder/t``
    the table is part 4); negative counts from the file name backwards. Partitions are the
    last folders before the file.
    """
    parts = _path_parts(F.col("_metadata.file_path") if file_path is None else file_path)
    position = F.lit(table_part + 1 if table_part >= 0 else table_part)
    added = {"table_name": F.try_element_at(parts, position)}
    for i in range(partition_count):
        added[f"partition_{i}"] = F.try_element_at(parts, F.lit(i - partition_count - 1))
    return df.select(*map(ref, df.columns), *[c.alias(n) for n, c in added.items()])


def file_inventory(
    spark: SparkSession, base: str, pattern: str = ".", expand_folders: bool = False
) -> DataFrame:
    """Files below ``base`` whose path matches: per folder (or file) how many, bytes, newest.

    Only path, length and time are selected, so no file content is read.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(base)
        .select("path", "length", "modificationTime")
        .where(F.col("path").rlike(pattern))
    )
    name = F.col("path") if expand_folders else F.regexp_extract("path", "^(.*/)", 1)
    return (
        files.groupBy(name.alias("name"))
        .agg(
            F.count(F.lit(1)).alias("files"),
            F.sum("length").alias("bytes"),
            F.max("modificationTime").alias("newest"),
        )
        .orderBy("name")
    )
