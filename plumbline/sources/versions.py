"""Data sets in versions: what is published is seen whole or not at all.

Rows are written to a new folder first; the version then is one small record, appended to ``versions``, that
lists the folders which make up the data set. Readers take the newest record, so a write that fails midway
leaves the old version as it was, and a reader keeps reading the one it began with. Folders of an
earlier version are listed again where they stay, not copied; partitions that a version replaces are
hidden in them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from plumbline.functions.columns import ref
from plumbline.sources.readers import read_path, tag_origin

MODES = ("append", "replace", "refresh", "partitions")
VERSION = "number bigint, folders array<struct<folder:string,hidden:array<string>,schema:string>>"


def _partition(columns: Sequence[str]) -> Column:
    """The partition of a row as one text, with NULL apart from every value."""
    named = [F.coalesce(F.concat(F.lit(f"{c}="), ref(c).cast("string")), F.lit(f"{c}")) for c in columns]
    return F.concat_ws("\u0001", *named)


def _records(spark: SparkSession, path: str) -> DataFrame | None:
    records = read_path(spark, f"{path}/versions")
    return None if records is None else records.orderBy(F.desc("number"), "id")


def newest_version(spark: SparkSession, path: str) -> tuple[int, list[tuple[str, list[str], str]]]:
    """Number and folders of what is published: the partitions hidden in each, and its schema; nothing is version 0."""
    records = _records(spark, path)
    row = records.first() if records is not None else None
    return (row["number"], [(f["folder"], list(f["hidden"]), f["schema"]) for f in row["folders"]]) if row else (0, [])


def publish_version(
    df: DataFrame,
    path: str,
    partition_cols: Sequence[str] = (),
    mode: str = "replace",
    pattern: str = ".",
) -> int:
    """Publishes a data set below ``path`` as its next version, whose number it gives back.

    append -- the rows are added to what is there
    replace -- these rows only
    refresh -- the rows whose source folder matches the pattern only; ``df`` is the read of that source
    partitions -- like append, but partitions that the rows belong to are replaced

    One publisher at a time: of two that publish the same number, the one whose id comes first counts.
    """
    spark = df.sparkSession
    if mode not in MODES:
        raise ValueError(f"mode is {', '.join(MODES[:-1])} or {MODES[-1]}, not {mode!r}")
    if mode == "refresh":
        matching = df.where(F.regexp_extract("_metadata.file_path", "^(.*/)", 1).rlike(pattern))
        df = tag_origin(matching, partition_count=len(partition_cols)).drop("table_name")
        for i, name in enumerate(partition_cols):
            df = df.withColumnRenamed(f"partition_{i}", name)
    number, folders = newest_version(spark, path)
    own = f"{path}/data/{uuid.uuid4().hex}"
    writer = df.write.partitionBy(*partition_cols) if partition_cols else df.write
    writer.parquet(own)
    if mode in ("replace", "refresh"):
        folders = []
    elif mode == "partitions":
        written = spark.read.schema(df.schema).parquet(own).select(_partition(partition_cols).alias("p")).distinct()
        replaced = [r.p for r in written.collect()]  # a row per partition
        folders = [(f, sorted({*hidden, *replaced}), schema) for f, hidden, schema in folders]
    record = (number + 1, [*folders, (own, [], df.schema.json())])
    # a folder of its own, so that publishers share no temporary files
    place = f"{path}/versions/id=v-{uuid.uuid4().hex}"
    spark.createDataFrame([record], VERSION).coalesce(1).write.parquet(place)
    return number + 1


def read_version(spark: SparkSession, path: str, partition_cols: Sequence[str] = ()) -> DataFrame | None:
    """The newest version whole; None when nothing has been published.

    ``partition_cols`` as published: a filter on them lists only matching folders, and hidden partitions
    are not read.
    """
    _, folders = newest_version(spark, path)
    parts = []
    for folder, hidden, schema in folders:
        rows = spark.read.schema(T.StructType.fromJson(json.loads(schema))).parquet(folder)
        if hidden:
            rows = rows.where(~_partition(partition_cols).isin(hidden))
        parts.append(rows)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts) if parts else None


def unused_folders(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Folders that none of the newest ``keep`` versions lists: what failed writes and old versions left."""
    records = _records(spark, path)
    if records is None:
        return []
    listed = {f["folder"] for r in records.limit(keep).collect() for f in r["folders"]}
    data = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/data")
    files = data.getFileSystem(spark._jsc.hadoopConfiguration())
    there = files.listStatus(data) if files.exists(data) else []
    names = {f.rsplit("/", 1)[-1] for f in listed}
    return [s.getPath().toString() for s in there if s.getPath().getName() not in names]


def drop_unused(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Removes them; readers of versions older than those kept must be done."""
    folders = unused_folders(spark, path, keep)
    for folder in folders:
        place = spark._jvm.org.apache.hadoop.fs.Path(folder)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    return len(folders)
