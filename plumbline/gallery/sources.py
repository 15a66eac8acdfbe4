"""Sources, sinks and record tables. Written tables go to the session's scratch folder."""

from __future__ import annotations

import uuid
from datetime import datetime
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, functions as F

from plumbline.gallery.common import Registry, table
from plumbline.gallery.rulesets import SLICE, SLICE_SQL
from plumbline.operators.casting import cast_losses, cast_to_ddl
from plumbline.plans import score as S
from plumbline.plans.evaluate import evaluate
from plumbline.scratch import scratch_path
from plumbline.sources import readers, records, sinks
from plumbline.sources.keyed_store import KeyedStore
from plumbline.sources.versions import publish_version, read_version

_R = Registry()
QUERIES, ORACLES = _R.queries, _R.oracles

_STATUS_SQL = "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1"


def _by_status(df):
    return df.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


_R.add(
    "s01_read_path",
    lambda spark, d: _by_status(readers.read_path(spark, f"{d}/orders.parquet")),
    _STATUS_SQL,
)


@_R.query("s02_read_table", _STATUS_SQL)
def _read_table(spark, d):
    """Orders through a catalog entry that points at their files."""
    path = f"{d}/orders.parquet"
    name = "plumbline_orders_" + uuid.uuid4().hex[:8]
    spark.catalog.createTable(f"default.{name}", path=path, source="parquet")
    try:
        found = _by_status(readers.read_table(spark, "default", name))
        # the plan that was made of the entry reads its files, which are not the catalog's and stay
        found.schema
        return found
    finally:
        spark.sql(f"DROP TABLE default.{name}")


_R.add(
    "s03_read_sql",
    lambda spark, d: readers.read_sql(
        spark,
        f"SELECT o_orderstatus, count(*) AS n FROM parquet.`{d}/orders.parquet` GROUP BY o_orderstatus",
    ),
    _STATUS_SQL,
)


def _stored(spark, d, name: str, partition: str):
    """Orders written below a folder per ``partition`` (an SQL expression)."""
    base = scratch_path(spark, name)
    orders = table(spark, d, "orders").withColumn("partition", F.expr(partition))
    orders.write.partitionBy("partition").parquet(f"{base}/orders")
    return base


@_R.query(
    "s04_tag_origin",
    """SELECT 'orders' AS table_name, 'partition=' || o_orderpriority AS partition_0, count(*) AS n
    FROM orders GROUP BY o_orderpriority""",
)
def _tag_origin(spark, d):
    base = _stored(spark, d, "origin", "o_orderpriority")
    tagged = readers.tag_origin(spark.read.parquet(f"{base}/orders"), table_part=-3)
    return tagged.groupBy("table_name", "partition_0").agg(F.count(F.lit(1)).alias("n"))


@_R.query(
    "s05_read_partition",
    "SELECT o_orderstatus, count(*) AS n FROM orders WHERE year(o_orderdate) = 1997 GROUP BY 1",
)
def _read_partition(spark, d):
    base = _stored(spark, d, "daily", "concat('Full.D', date_format(o_orderdate, 'yy'), '0101')")
    year = readers.read_partition(spark, base, "orders", "Full.Dyymmdd", "FEED.EVAL.D970101")
    return _by_status(year)


@_R.query(
    "s06_write_results",
    f"""SELECT "Name", "Result", table_name, 'D240131.EVAL' AS "partition", 2 AS copies FROM (
    SELECT 'Rule_' || rule_no AS "Name", result AS "Result", 'lineitem' AS table_name FROM ({SLICE_SQL}))""",
)
def _write_results(spark, d):
    """Flat results appended twice, read back from their partition."""
    path = scratch_path(spark, "results")
    results = evaluate(table(spark, d, "lineitem"), SLICE, name="lineitem")
    moment = datetime(2024, 1, 31)
    nested = S.result_records(results, "run-1", {"Path": d}, moment, moment)
    for _ in range(2):
        sinks.write_results(S.flat_results(nested, "lineitem"), path, "FEED.EVAL.D240131")
    written = spark.read.parquet(path).where("table_name = 'lineitem'")
    return written.groupBy("Name", "Result", "table_name", "partition").agg(
        F.count(F.lit(1)).cast("int").alias("copies")
    )


def _published(spark, d, mode: str):
    path = scratch_path(spark, f"publish-{mode}")
    orders = table(spark, d, "orders")
    sinks.publish(orders.where("o_orderstatus = 'F'"), path, ["o_orderstatus"])
    if mode == "refresh":
        source = scratch_path(spark, "publish-source")
        orders.withColumn("folder", F.col("o_orderstatus")).write.partitionBy("folder").parquet(source)
        files = spark.read.option("recursiveFileLookup", "true").parquet(source)
        sinks.publish(files, path, ["origin"], mode, "folder=[OP]")
        return _by_status(spark.read.parquet(path))
    sinks.publish(orders.where("o_orderstatus IN ('F', 'O')"), path, ["o_orderstatus"], mode)
    return _by_status(spark.read.parquet(path))


_R.add(
    "s07_publish_append",
    lambda spark, d: _published(spark, d, "append"),
    """SELECT o_orderstatus, count(*) * CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 1 END AS n
    FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY o_orderstatus""",
)
_R.add(
    "s07_publish_replace",
    lambda spark, d: _published(spark, d, "replace"),
    "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY 1",
)
_R.add(
    "s07_publish_refresh",
    lambda spark, d: _published(spark, d, "refresh"),
    "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderstatus IN ('O', 'P') GROUP BY 1",
)


def _broken(df):
    """The rows, of which some raise when they are written."""
    return df.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 7 == 3, F.raise_error(F.lit("broken"))).otherwise(F.col("o_totalprice")))


@_R.query(
    "s07_versions",
    """SELECT step, o_orderstatus, n FROM (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1),
        (VALUES ('first', ['F']), ('failed', ['F']), ('added', ['F', 'O']), ('partition', ['F', 'O']), ('replaced', ['P'])) v(step, kept)
    WHERE list_contains(kept, o_orderstatus)""",
)
def _versions(spark, d):
    """Published version by version, one of them with a write that fails midway: readers see whole versions only."""
    path = scratch_path(spark, "versions")
    orders = table(spark, d, "orders")
    seen = []

    def look(step):
        # what is read is the version of that moment, whatever is published later
        seen.append(_by_status(read_version(spark, path, ["o_orderstatus"])).withColumn("step", F.lit(step)))

    publish_version(orders.where("o_orderstatus = 'F'"), path, ["o_orderstatus"])
    look("first")
    try:
        publish_version(_broken(orders), path, ["o_orderstatus"])
    except PySparkException:
        look("failed")
    publish_version(orders.where("o_orderstatus = 'O'"), path, ["o_orderstatus"], "append")
    look("added")
    publish_version(orders.where("o_orderstatus = 'O'"), path, ["o_orderstatus"], "partitions")
    look("partition")
    publish_version(orders.where("o_orderstatus = 'P'"), path, ["o_orderstatus"], "replace")
    look("replaced")
    return reduce(DataFrame.unionByName, seen)


_R.add(
    "s07_publish_partitions",
    lambda spark, d: _by_status(_partitions_replaced(spark, d)),
    """SELECT o_orderstatus, count(*) FILTER (WHERE o_orderstatus <> 'O' OR o_custkey % 2 = 0) AS n FROM orders GROUP BY 1""",
)


def _partitions_replaced(spark, d):
    path = scratch_path(spark, "publish-partitions")
    orders = table(spark, d, "orders")
    sinks.publish(orders, path, ["o_orderstatus"])
    sinks.publish_partitions(orders.where("o_orderstatus = 'O' AND o_custkey % 2 = 0"), path, ["o_orderstatus"])
    return spark.read.parquet(path)


@_R.query(
    "s09_file_inventory",
    """SELECT DISTINCT 'partition=' || o_orderstatus AS folder, true AS filled FROM orders
    WHERE o_orderstatus IN ('F', 'P') ORDER BY folder""",
)
def _inventory(spark, d):
    base = _stored(spark, d, "inventory", "o_orderstatus")
    found = readers.file_inventory(spark, base, "partition=[FP]/.*parquet$")
    return found.select(
        F.regexp_extract("name", "([^/]+)/$", 1).alias("folder"),
        ((F.col("files") > 0) & (F.col("bytes") > 0)).alias("filled"),
    )


@_R.query(
    "s10_append_record",
    """SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'rushed' ELSE o_orderstatus END AS o_orderstatus
    FROM orders""",
)
def _append(spark, d):
    """Every order recorded, the urgent ones again with another status; the newest counts."""
    path = scratch_path(spark, "records")
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    records.append_record(orders, path, datetime(2024, 1, 1))
    urgent = orders.where("o_orderpriority = '1-URGENT'")
    records.append_record(
        urgent.withColumn("o_orderstatus", F.lit("rushed")), path, datetime(2024, 1, 2)
    )
    newest = records.latest_by_key(records.read_records(spark, path), ["o_orderkey"])
    return newest.select("o_orderkey", "o_orderstatus")


@_R.query(
    "s10_keyed_store",
    """SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY user_id""",
)
def _keyed_store(spark, d):
    """Events by user, written day by day in part, compacted in between, then written on: the newest of each user."""
    store = KeyedStore(spark, scratch_path(spark, "keyed"), ["user_id"])
    events = table(spark, d, "events").select("user_id", "event_id", "ts", "value")
    for n, part in enumerate(("event_id % 3 = 0", "event_id % 3 = 1", "event_id % 3 = 2")):
        newest = records.latest_by_key(events.where(part), ["user_id"], ["ts", "event_id"])
        store.append(newest, datetime(2024, 1, 1 + n))
        if n == 1:
            # each record's versions are ordered by what they hold, so all of them stay
            store.copy_to(store.path + "-copy", as_of=datetime(2024, 1, 9))
            store = KeyedStore(spark, store.path + "-copy", ["user_id"])
    return records.latest_by_key(store.read(), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "value")


_R.add(
    "s11_latest_by_key",
    lambda spark, d: records.latest_by_key(
        table(spark, d, "events"), ["user_id"], ["ts", "event_id"]
    ),
    """SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, max(ts) AS ts,
    arg_max(event_type, (ts, event_id)) AS event_type, arg_max(value, (ts, event_id)) AS value,
    arg_max(props, (ts, event_id)) AS props FROM events GROUP BY user_id""",
)


def _runs(spark, d):
    """Events as results: the event type stands for the table, the day for the run."""
    return table(spark, d, "events").select(
        F.col("event_type").alias("table_name"), F.to_date("ts").alias("run_ts"), "event_id"
    )


_R.add(
    "s13_latest_view",
    lambda spark, d: records.latest_view(_runs(spark, d)),
    """SELECT table_name, run_ts, event_id FROM (SELECT event_type AS table_name, ts::DATE AS run_ts, event_id,
    dense_rank() OVER (PARTITION BY event_type ORDER BY ts::DATE DESC) AS r FROM events) WHERE r = 1""",
)
_R.add(
    "s13_series_view",
    lambda spark, d: records.series_view(_runs(spark, d))
    .groupBy("table_name", "run_ts")
    .agg(F.count(F.lit(1)).alias("n")),
    "SELECT event_type AS table_name, ts::DATE AS run_ts, count(*) AS n FROM events GROUP BY 1, 2",
)
def _deviations_sql(points: str, keys: str = "", window: int = 14, season: int = 1) -> str:
    """Deviations of ``(keys, run, metric)`` rows, one per key and run."""
    part = f"PARTITION BY {keys}" if keys else ""
    over = f"OVER ({part} ORDER BY run)"
    lead = f"{keys}, " if keys else ""
    return f"""(SELECT {lead}run, metric, change, expected, unit AS spread, CASE WHEN len(h) < 5 THEN NULL
        WHEN change = expected THEN 0 WHEN unit = 0 THEN 'inf'::DOUBLE ELSE abs(change - expected) / unit END AS deviation
        FROM (SELECT *, greatest(1.4826 * list_aggregate(list_transform(h, lambda x: abs(x - expected)), 'median'),
            0.01 * abs(before)) AS unit
        FROM (SELECT *, list_aggregate(h, 'median') AS expected
        FROM (SELECT *, coalesce(list(change) FILTER (WHERE change IS NOT NULL)
            OVER ({part} ORDER BY run ROWS BETWEEN {window} PRECEDING AND 1 PRECEDING), []) AS h
        FROM (SELECT *, metric - before AS change
        FROM (SELECT *, lag(metric, {season}) {over} AS before FROM ({points})))))))"""


_R.add(
    "s13_metric_series",
    lambda spark, d: records.series_view(
        evaluate(
            table(spark, d, "events").withColumn("day", F.to_date("ts")),
            ["HasSize > 0", 'HasSum "value" > 0', 'HasNumberOfDistinctValues "user_id" > 0'],
            by=["event_type", "day"],
        ),
        "metric",
        ("event_type", "rule_type"),
        "day",
        window=7,
    ).select(
        "event_type", "rule_type", "day",
        *[F.round(c, 4).alias(c) for c in ("metric", "change", "expected", "spread", "deviation")],
    ),
    "SELECT event_type, rule_type, run AS day, round(metric, 4) AS metric, round(change, 4) AS change, "
    "round(expected, 4) AS expected, round(spread, 4) AS spread, round(deviation, 4) AS deviation FROM "
    + _deviations_sql(
        " UNION ALL ".join(
            f"SELECT event_type, '{name}' AS rule_type, ts::DATE AS run, {value}::DOUBLE AS metric FROM events GROUP BY 1, 3"
            for name, value in (
                ("HasSize", "count(*)"),
                ("HasSum", "sum(value)"),
                ("HasNumberOfDistinctValues", "count(DISTINCT user_id)"),
            )
        ),
        "event_type, rule_type",
        window=7,
    ),
)

# Events with the newest day five times over, beside the day's number: a jump and a steady drift.
_PLANTED = """(SELECT *, date_diff('day', DATE '2024-01-01', ts::DATE) AS drift FROM events JOIN range({n}) r(i)
    ON i = 0 OR ts::DATE = (SELECT max(ts::DATE) FROM events))"""
_CHANGES = [
    ("count(*)", "count(*)", 1, 5),
    ("avg(drift)", "avg(drift)", 1, 5),
    ("count(*)", "count(*)", 7, 1),
]


@_R.query(
    "s13_metric_change",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS rules, round(deviation, 4) AS metric, CASE WHEN deviation <= 8 THEN 'PASS' ELSE 'FAIL' END AS result
        FROM (SELECT coalesce(arg_max(deviation, run), 0) AS deviation FROM {_deviations_sql(
            f"SELECT ts::DATE AS run, {sql}::DOUBLE AS metric FROM {_PLANTED.format(n=n)} GROUP BY 1", season=season)})"""
        for name, (_, sql, season, n) in zip(("jump", "drift", "season"), _CHANGES)
    ),
)
def _metric_change(spark, d):
    """A jump of the newest day's rows fails, a steady drift and the days as they are pass."""
    events = table(spark, d, "events")
    newest = events.where(F.to_date("ts") == events.agg(F.max(F.to_date("ts"))).scalar())
    parts = []
    for name, (aggregate, _, season, n) in zip(("jump", "drift", "season"), _CHANGES):
        rows = events
        for _ in range(n - 1):
            rows = rows.unionByName(newest)
        rows = rows.withColumn("drift", F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")))
        rule = f'MetricChange "{aggregate}" "to_date(ts)" "{season}" <= 8'
        parts.append(evaluate(rows, [rule]).select(F.lit(name).alias("rules"), F.round("metric", 4).alias("metric"), "result"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_R.add(
    "s14_expire",
    lambda spark, d: records.expire(
        table(spark, d, "events").withColumnRenamed("ts", "written_at"), datetime(2024, 2, 11, 12)
    ).select("event_id"),
    "SELECT event_id FROM events WHERE ts > TIMESTAMP '2024-02-11 12:00:00' - INTERVAL 32 DAY",
)

_DECLARED = [
    ("p_partkey", "BIGINT"),
    ("p_brand", "integer"),
    ("p_name", "varchar(55)"),
    ("p_size", "smallint"),
    ("p_retailprice", "numeric(12,2)"),
]


def _raw_parts(spark, d):
    """Parts as texts, with the brand of some cut down to its number."""
    part = table(spark, d, "part")
    texts = part.select(*[F.col(c).cast("string").alias(c) for c in part.columns])
    return texts.withColumn("p_brand", F.expr("replace(p_brand, 'Brand#1', '1')"))


_R.add(
    "t01_cast_to_ddl",
    lambda spark, d: cast_to_ddl(_raw_parts(spark, d), _DECLARED),
    """SELECT p_partkey::BIGINT AS p_partkey, TRY_CAST(replace(p_brand, 'Brand#1', '1') AS INT) AS p_brand,
    p_name, p_size::SMALLINT AS p_size, p_retailprice::DECIMAL(12,2) AS p_retailprice FROM part""",
)
_R.add(
    "t01_cast_losses",
    lambda spark, d: cast_losses(_raw_parts(spark, d), _DECLARED),
    """SELECT 'p_partkey' AS column_name, 'BIGINT' AS ddl_type, 'long' AS spark_type, count(*) AS cells, 0::BIGINT AS lost FROM part
    UNION ALL SELECT 'p_brand', 'integer', 'int', count(*),
        count(*) FILTER (WHERE TRY_CAST(replace(p_brand, 'Brand#1', '1') AS INT) IS NULL) FROM part
    UNION ALL SELECT 'p_name', 'varchar(55)', 'string', count(*), 0 FROM part
    UNION ALL SELECT 'p_size', 'smallint', 'short', count(*), 0 FROM part
    UNION ALL SELECT 'p_retailprice', 'numeric(12,2)', 'decimal(12,2)', count(*), 0 FROM part""",
)
