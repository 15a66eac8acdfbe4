"""Writing result rows and publishing data sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from plumbline.sources.readers import tag_origin

RESULT_PARTITIONS = ("table_name", "partition")


def result_partition(batch_id: str) -> str:
    """Last and last but one part of the batch id: date, then step."""
    parts = batch_id.split(".")
    return f"{parts[-1]}.{parts[-2]}"


def write_results(results: DataFrame, path: str, batch_id: str) -> None:
    """Appends flat results (a row per rule) under their table and batch partition.

    One writer at a time: a batch writes the results of all its tables in one go.
    """
    (
        results.withColumn("partition", F.lit(result_partition(batch_id)))
        .hint("rebalance")
        .write.mode("append")
        .partitionBy(*RESULT_PARTITIONS)
        .parquet(path)
    )


def publish(
    df: DataFrame,
    path: str,
    partition_cols: list[str],
    mode: str = "append",
    pattern: str = ".",
) -> None:
    """Publishes a data set below ``path`` in one of three ways.

    append -- add the rows to what is there
    replace -- drop everything there, keep these rows only
    refresh -- drop everything there, keep the rows whose source folder matches the
               pattern; ``df`` is the read of that source (which lies outside of ``path``),
               partitions come from its folders
    """
    if mode == "refresh":
        matching = df.where(
            F.regexp_extract("_metadata.file_path", "^(.*/)", 1).rlike(pattern)
        )
        df = tag_origin(matching, partition_count=len(partition_cols)).drop("table_name")
        for i, name in enumerate(partition_cols):
            df = df.withColumnRenamed(f"partition_{i}", name)
    elif mode not in ("append", "replace"):
        raise ValueError(f"mode is append, replace or refresh, not {mode!r}")
    (
        df.write.mode("append" if mode == "append" else "overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(*partition_cols)
        .parquet(path)
    )


def publish_partitions(df: DataFrame, path: str, partition_cols: list[str]) -> None:
    """Replaces just the partitions that ``df`` has rows for."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_cols)
        .parquet(path)
    )
