"""Batch bookkeeping on events: a day is a batch, a user an item, an event a step."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.gallery.common import Registry, table
from plumbline.gallery.profiles import ORDER_SUGGESTIONS_SQL
from plumbline.plans import batch as B
from plumbline.plans.jobs import BatchJobs
from plumbline.plans.runs import DataQuality
from plumbline.scratch import scratch_path
from plumbline.sources.records import append_record, latest_by_key, read_records

_R = Registry()
QUERIES, ORACLES = _R.queries, _R.oracles

_STATUS = """CASE event_type WHEN 'purchase' THEN 'INGESTED' WHEN 'signup' THEN 'PENDING'
    WHEN 'error' THEN 'FAILED' ELSE 'COMPLETED' END"""
_STEPS_SQL = f"""(SELECT ts::DATE::VARCHAR AS batch_id, user_id::VARCHAR AS object_id, event_id AS step_no,
    {_STATUS} AS status FROM events)"""
_ITEMS_SQL = f"""(SELECT batch_id, object_id, coalesce(arg_max(status, step_no) FILTER
    (WHERE status <> 'COMPLETED'), 'COMPLETED') AS status FROM {_STEPS_SQL} GROUP BY 1, 2)"""


def _steps(spark, d):
    return table(spark, d, "events").select(
        F.to_date("ts").cast("string").alias("batch_id"),
        F.col("user_id").cast("string").alias("object_id"),
        F.col("event_type").alias("step"),
        F.col("event_id").alias("step_no"),
        F.expr(_STATUS).alias("status"),
    )


def _opened(spark, d):
    """One event per day naming that day's event types (a handful), and its parameters."""
    names = F.array_sort(F.collect_set("event_type"))
    return (
        table(spark, d, "events")
        .groupBy(F.to_date("ts").cast("string").alias("BatchId"))
        .agg(names.alias("NameList"), F.struct(F.lit("new").alias("ExecName")).alias("process_parms"))
    )


def _known(spark, d):
    """Batches of the first days, opened earlier: some with the parameters they have now."""
    days = _opened(spark, d).where("BatchId < '2024-01-11'")
    exec_name = F.when(F.col("BatchId") < "2024-01-06", "new").otherwise("old")
    return days.select(
        "BatchId",
        F.col("BatchId").alias("ObjectId"),
        F.struct(exec_name.alias("ExecName")).alias("ProcessParms"),
    )


_R.add(
    "b01_open_batch",
    lambda spark, d: B.open_batch(_opened(spark, d), _known(spark, d)).select(
        "BatchId", "ObjectId", F.col("ProcessParms")["ExecName"].alias("exec_name")
    ),
    """WITH e AS (SELECT DISTINCT ts::DATE::VARCHAR AS day, event_type FROM events)
    SELECT day AS "BatchId", event_type AS "ObjectId", NULL AS exec_name FROM e WHERE day >= '2024-01-11'
    UNION ALL SELECT DISTINCT day, day, 'new' FROM e WHERE day >= '2024-01-06'""",
)
_R.add(
    "b02_item_status",
    lambda spark, d: B.item_status(_steps(spark, d)),
    f"SELECT batch_id, object_id, status FROM {_ITEMS_SQL}",
)
_R.add(
    "b03_batch_status",
    lambda spark, d: B.batch_status(B.item_status(_steps(spark, d))).select(
        "batch_id",
        "status",
        "items",
        *[
            F.coalesce(F.col("file_counts")[s], F.lit(0)).alias(s.lower())
            for s in ("COMPLETED", "INGESTED", "PENDING", "FAILED")
        ],
    ),
    f"""SELECT batch_id, CASE WHEN count(*) FILTER (WHERE status = 'FAILED') > 0 THEN 'FAILED'
        WHEN count(*) FILTER (WHERE status = 'INGESTED') > 0 THEN 'PARTIAL'
        WHEN count(*) FILTER (WHERE status = 'PENDING') > 0 THEN 'RUNNING' ELSE 'SUCCEEDED' END AS status,
    count(*) AS items, count(*) FILTER (WHERE status = 'COMPLETED') AS completed,
    count(*) FILTER (WHERE status = 'INGESTED') AS ingested, count(*) FILTER (WHERE status = 'PENDING') AS pending,
    count(*) FILTER (WHERE status = 'FAILED') AS failed FROM {_ITEMS_SQL} GROUP BY batch_id""",
)


@_R.query(
    "b03_recorded_status",
    f"""WITH i AS (SELECT batch_id, object_id, status FROM {_ITEMS_SQL})
    SELECT batch_id, object_id, status, NULL::BIGINT AS items, NULL::BIGINT AS failed FROM i
    UNION ALL SELECT batch_id, batch_id, CASE WHEN count(*) FILTER (WHERE status = 'FAILED') > 0 THEN 'FAILED'
        WHEN count(*) FILTER (WHERE status = 'INGESTED') > 0 THEN 'PARTIAL'
        WHEN count(*) FILTER (WHERE status = 'PENDING') > 0 THEN 'RUNNING' ELSE 'SUCCEEDED' END,
    count(*), nullif(count(*) FILTER (WHERE status = 'FAILED'), 0) FROM i GROUP BY batch_id""",
)
def _recorded(spark, d):
    """Status of every item and rollup of every batch, recorded twice and read back."""
    path = scratch_path(spark, "statuses")
    steps = _steps(spark, d)
    append_record(B.status_records(B.item_status(steps.where("step_no = 1"))), path)
    append_record(B.status_records(B.item_status(steps)), path)
    newest = latest_by_key(read_records(spark, path), ["batch_id", "object_id"])
    return newest.select(
        "batch_id",
        "object_id",
        "status",
        F.col("file_counts")["BATCH"].alias("items"),
        F.col("file_counts")["FAILED"].alias("failed"),
    )


@_R.query(
    "b04_step_log",
    f"""SELECT batch_id, object_id, arg_max(status, step_no) AS status, max(step_no) AS step_no
    FROM {_STEPS_SQL} GROUP BY 1, 2""",
)
def _step_log(spark, d):
    """Steps appended to the log, then the newest step of every item."""
    path = scratch_path(spark, "steps")
    append_record(_steps(spark, d), path)
    newest = latest_by_key(read_records(spark, path), ["batch_id", "object_id"], ["step_no"])
    return newest.select("batch_id", "object_id", "status", "step_no")


@_R.query(
    "b05_read_batch",
    """SELECT 'header' AS part, '2024-01-15' AS "BatchId", '2024-01-15' AS "ObjectId"
    FROM events WHERE ts::DATE = DATE '2024-01-15' HAVING count(*) > 0
    UNION ALL SELECT DISTINCT 'item', '2024-01-15', event_type FROM events WHERE ts::DATE = DATE '2024-01-15'""",
)
def _read_batch(spark, d):
    batches = B.open_batch(_opened(spark, d), _known(spark, d))
    header, items = B.read_batch(batches, "2024-01-15")
    rows = header.withColumn("part", F.lit("header")).unionByName(
        items.withColumn("part", F.lit("item"))
    )
    return rows.select("part", "BatchId", "ObjectId")


@_R.query(
    "b_four_jobs",
    f"""SELECT 'orders.parquet' AS table_name, 'PASS' AS "Result", count(*) AS rules, 'COMPLETED' AS step_status
    FROM ({ORDER_SUGGESTIONS_SQL})""",
)
def _four_jobs(spark, d):
    """Profile, suggest, recommend and evaluate as recorded jobs of a batch of one table."""
    store = scratch_path(spark, "store")
    parms = {"Base": d, "Partition": "", "ExecName": "run-1"}
    event = {"BatchId": "FEED.EVAL.D240131", "NameList": ["orders.parquet"], "process_parms": parms}
    jobs = BatchJobs(DataQuality(spark, store), event)
    jobs.open()
    jobs.profile()
    jobs.suggest({"orders.parquet": ["o_orderstatus", "o_orderpriority"]})
    jobs.recommend()
    jobs.evaluate(f"{store}/flat")
    steps = jobs.steps().where("step = 'Step-Evaluate'")
    results = spark.read.parquet(f"{store}/flat")
    counted = results.groupBy("table_name", "Result").agg(F.count(F.lit(1)).alias("rules"))
    status = steps.select(F.col("object_id").alias("table_name"), F.col("status").alias("step_status"))
    return counted.join(status, "table_name").select("table_name", "Result", "rules", "step_status")
