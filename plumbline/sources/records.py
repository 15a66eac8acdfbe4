"""Records in append-only tables: every write is a new version, the newest one counts."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from plumbline.functions.columns import ref
from plumbline.operators.trends import deviations
from plumbline.sources.readers import read_path

EXPIRY_DAYS = 32
WRITE = "write_id"


def _utc(moment: datetime) -> str:
    """A moment as text; one without a zone is UTC already."""
    if moment.tzinfo is not None:
        moment = moment.astimezone(timezone.utc).replace(tzinfo=None)
    return moment.isoformat(sep=" ")


def append_record(
    record: DataFrame, path: str, written_at: datetime | None = None, partition_cols: Sequence[str] = ()
) -> None:
    """Adds a version of one or more records; ``written_at`` is UTC, now by default.

    Every write has a folder of its own: writers that share an output folder also share
    its temporary files, and the first to finish would remove those of the others.
    """
    stamp = F.current_timestamp() if written_at is None else F.lit(_utc(written_at) + "Z")
    folder = f"{path}/{WRITE}=w-{uuid.uuid4().hex}"
    stamped = record.withColumn("written_at", stamp.cast("timestamp"))
    (stamped.write.partitionBy(*partition_cols) if partition_cols else stamped.write).parquet(folder)


def read_records(spark: SparkSession, path: str) -> DataFrame | None:
    """All versions of all records; None when nothing has been written."""
    versions = read_path(spark, path)
    return None if versions is None else versions.drop(WRITE)


def latest_by_key(
    records: DataFrame, key: Sequence[str], order: Sequence[str] = ("written_at",)
) -> DataFrame:
    """The newest version of every record.

    The aggregate combines on the map side: each task hands on one row per key, however
    many versions a key has.
    """
    rest = [c for c in records.columns if c not in key]
    newest = F.max_by(F.struct(*map(ref, rest)), F.struct(*map(ref, order)))
    grouped = records.groupBy(*map(ref, key)).agg(newest.alias("_newest"))
    picked = grouped.select(*map(ref, key), *[F.col("_newest")[c].alias(c) for c in rest])
    return picked.select(*map(ref, records.columns))


def first_written(records: DataFrame, key: Sequence[str]) -> DataFrame:
    """Creation and last-change time of every record."""
    return records.groupBy(*map(ref, key)).agg(
        F.min("written_at").alias("CreatedOn"), F.max("written_at").alias("LastModifiedOn")
    )


# Tables up to which the newest run of each is sent to every task.
SENT_TABLES, SALTS = 100_000, 64


def latest_view(
    results: DataFrame,
    table: str = "table_name",
    run: str = "run_ts",
    sent_tables: int = SENT_TABLES,
) -> DataFrame:
    """Rows of the newest run of each table, all of them.

    The newest run per table is a row per table. These are counted: up to ``sent_tables`` they are
    sent to the rows, which then are not shuffled at all. More are joined under a salt from where the
    row is read, since all rows of one run have the same key.
    """
    newest = results.groupBy(ref(table).alias("_t")).agg(F.max(ref(run)).alias("_r"))
    same = ref(table).eqNullSafe(F.col("_t")) & (ref(run) == F.col("_r"))
    if newest.limit(sent_tables + 1).count() <= sent_tables:
        return results.join(F.broadcast(newest), same, "left_semi")
    salt = F.pmod(F.xxhash64(*[ref(c).cast("string") for c in (table, run)], F.spark_partition_id()), F.lit(SALTS))
    every = newest.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = results.withColumn("_salt", salt.cast("int"))
    return salted.join(every, same & (F.col("_salt") == F.col("_s")), "left_semi").drop("_salt")


def series_view(
    results: DataFrame,
    metric: str | None = None,
    keys: Sequence[str] = ("table_name", "rule_text"),
    run: str = "run_ts",
    **options,
) -> DataFrame:
    """All runs of every table; with ``metric``, how its value moved from run to run under each of ``keys``.

    See ``trends.deviations`` for the columns and ``options``.
    """
    return results if metric is None else deviations(results, keys, run, metric, **options)


def expire(records: DataFrame, as_of: Column | datetime, days: int = EXPIRY_DAYS) -> DataFrame:
    """Records still alive ``days`` days after they were written."""
    if isinstance(as_of, datetime):
        dtype = records.schema["written_at"].dataType
        zone = "Z" if isinstance(dtype, T.TimestampType) else ""
        as_of = F.lit(_utc(as_of) + zone).cast(dtype)
    return records.where(F.col("written_at") > as_of - F.make_dt_interval(F.lit(days)))


def compact_records(
    spark: SparkSession,
    path: str,
    target: str,
    as_of: Column | datetime | None = None,
    days: int = EXPIRY_DAYS,
) -> None:
    """Writes the versions still alive to ``target``, a new folder, with one folder per day.

    The many small folders of single writes are left as they are; writers go on in ``target``.
    A read of some days there lists these days' folders only (``write_id`` is ``d-`` and the day).
    """
    versions = read_records(spark, path)
    if versions is None:
        return
    living = expire(versions, F.current_timestamp() if as_of is None else as_of, days)
    day = F.concat(F.lit("d-"), F.date_format("written_at", "yyyy-MM-dd"))
    living.withColumn(WRITE, day).repartition(WRITE).write.partitionBy(WRITE).parquet(target)


def flatten(records: DataFrame, nested: str) -> DataFrame:
    """Nested record lists (profiles, suggestions, rule results) as flat rows."""
    outer = [c for c in records.columns if c != nested]
    exploded = records.select(*map(ref, outer), F.explode(ref(nested)).alias("_row"))
    return exploded.select(*map(ref, outer), "_row.*")
