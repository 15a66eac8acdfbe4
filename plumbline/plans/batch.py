"""Batches of tables: opened by an event, worked on in steps, rolled up to one status.

Events have ``BatchId``, ``NameList array<string>`` and ``process_parms``; the batch table
has one row per batch (``ObjectId`` = ``BatchId``) and one per table; steps are a long
table of ``batch_id, object_id, step, step_no, status, ...``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# How item statuses decide the status of the batch, strongest first.
PRECEDENCE = [
    ("FAILED", ("FAILED", "INVALID")),
    ("PARTIAL", ("INGESTED",)),
    ("RUNNING", ("PENDING", "RUNNING")),
]
# Statuses that jobs write but the rollup above would take for success.
STRICTER = {"FAILED": ("ERROR",), "PARTIAL": ("WARNING",)}
STEP_SCHEMA = (
    "batch_id string, object_id string, step string, step_no int, status string, "
    "status_msg string, run_id string, time timestamp"
)


def open_batch(events: DataFrame, batches: DataFrame) -> DataFrame:
    """Header and item rows of the events whose batch is not there yet.

    The newest parameters of a known batch come back as a header row only, to be appended.
    """
    event = events.select("BatchId", "NameList", F.col("process_parms").alias("ProcessParms"))
    header = event.select("BatchId", F.col("BatchId").alias("ObjectId"), "ProcessParms")
    items = event.select(
        "BatchId",
        F.explode("NameList").alias("ObjectId"),
        F.lit(None).cast(event.schema["ProcessParms"].dataType).alias("ProcessParms"),
    )
    known = batches.where("BatchId = ObjectId")
    new = header.unionByName(items).join(known, "BatchId", "left_anti")
    changed = header.join(
        known.select("BatchId", F.col("ProcessParms").alias("_old")), "BatchId"
    ).where(~F.col("ProcessParms").eqNullSafe(F.col("_old")))
    return new.unionByName(changed.drop("_old"))


def read_batch(batches: DataFrame, batch_id: str) -> tuple[DataFrame, DataFrame]:
    """Header row and item rows of one batch."""
    batch = batches.where(F.col("BatchId") == batch_id)
    header = F.col("BatchId") == F.col("ObjectId")
    return batch.where(header), batch.where(~header)


def step_log(spark: SparkSession, steps: Sequence[Mapping]) -> DataFrame:
    """Step rows to append: per item and step its status, message, run and time."""
    fields = [f.split()[0] for f in STEP_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(s.get(f) for f in fields) for s in steps], STEP_SCHEMA)


def item_status(steps: DataFrame) -> DataFrame:
    """COMPLETED unless a step is not: then the status of the last such step."""
    open_ = F.col("status") != "COMPLETED"
    last_open = F.max_by(F.when(open_, F.col("status")), F.when(open_, F.col("step_no")))
    return steps.groupBy("batch_id", "object_id").agg(
        F.coalesce(last_open, F.lit("COMPLETED")).alias("status")
    )


def _rank(status: Column, strict_reference: bool) -> Column:
    """0 for success, higher for a status that outweighs others."""
    rank = F.lit(0)
    for weight, (outcome, members) in enumerate(reversed(PRECEDENCE), start=1):
        if not strict_reference:
            members = (*members, *STRICTER.get(outcome, ()))
        rank = F.when(status.isin(*members), weight).otherwise(rank)
    return rank


def batch_status(items: DataFrame, strict_reference: bool = False) -> DataFrame:
    """Status of each batch, and how many items have which status.

    ``strict_reference`` leaves ERROR and WARNING items without weight.
    """
    # Counted per status first: a batch then has as many rows as it has statuses.
    per_status = items.groupBy("batch_id", "status").agg(F.count(F.lit(1)).alias("n"))
    entry = F.struct(F.col("status").alias("key"), F.col("n").alias("value"))
    outcome = F.lit("SUCCEEDED")
    for weight, (name, _) in enumerate(reversed(PRECEDENCE), start=1):
        outcome = F.when(F.col("_rank") == weight, name).otherwise(outcome)
    return (
        per_status.groupBy("batch_id")
        .agg(
            F.max(_rank(F.col("status"), strict_reference)).alias("_rank"),
            F.sum("n").alias("items"),
            F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("file_counts"),
        )
        .select("batch_id", outcome.alias("status"), "items", "file_counts")
    )


def status_records(items: DataFrame, strict_reference: bool = False) -> DataFrame:
    """What is recorded of a batch: each item's status, and a row of the batch with its rollup.

    ``file_counts`` of the batch's row has its items by status and, under ``BATCH``, all of them.
    """
    total = F.create_map(F.lit("BATCH"), F.col("items"))
    whole = batch_status(items, strict_reference).select(
        "batch_id",
        F.col("batch_id").alias("object_id"),
        "status",
        F.map_concat("file_counts", total).alias("file_counts"),
    )
    none = F.lit(None).cast("map<string,bigint>").alias("file_counts")
    return items.select("batch_id", "object_id", "status", none).unionByName(whole)
