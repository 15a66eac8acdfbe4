"""Reading, writing, records, casting, streams."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from plumbline import evaluate, scratch
from plumbline.functions.ddl import spark_type
from plumbline.operators.casting import cast_losses, cast_to_ddl
from plumbline.sources import readers, records, sinks
from plumbline.streaming.arriving import FILE, evaluate_arriving

RULES = ["HasSize > 0", 'IsComplete "v"', 'IsUnique "k"']


@pytest.fixture
def numbers(spark):
    return spark.range(0, 60, 1, 4).select(F.col("id").alias("k"), F.when(F.col("id") % 4 != 0, 1).alias("v"))


def test_no_data_is_told_apart_from_misuse(spark, tmp_path):
    assert readers.read_path(spark, str(tmp_path / "nowhere")) is None
    (tmp_path / "empty").mkdir()
    assert readers.read_path(spark, str(tmp_path / "empty")) is None
    assert readers.read_table(spark, "default", "no_such_table") is None
    with pytest.raises(AnalysisException):
        readers.read_sql(spark, "SELECT nothing")
    with pytest.raises(ValueError):
        readers.read_source(spark, {"Bucket": "x"})


def test_sources_by_kind(spark, numbers, tmp_path):
    path = str(tmp_path / "n")
    numbers.write.parquet(path)
    for source in ({"Path": path}, {"FolderUrl": path}, {"SQL": f"SELECT * FROM parquet.`{path}`"}):
        assert readers.read_source(spark, source).count() == 60


def test_origin_of_plain_folders(spark, numbers, tmp_path):
    numbers.where("k < 20").write.parquet(str(tmp_path / "sales tab" / "D240101"))
    numbers.where("k >= 20").write.parquet(str(tmp_path / "sales tab" / "D240102+x"))
    df = spark.read.option("recursiveFileLookup", "true").parquet(str(tmp_path / "sales tab"))
    tagged = readers.tag_origin(df, table_part=-3)
    found = {tuple(r) for r in tagged.groupBy("table_name", "partition_0").count().collect()}
    assert found == {("sales tab", "D240101", 20), ("sales tab", "D240102+x", 40)}
    assert readers.tag_origin(df, partition_count=2).columns == ["k", "v", "table_name", "partition_0", "partition_1"]
    deep = len(f"file:{tmp_path}".split("/"))
    assert readers.tag_origin(df, table_part=deep).select("table_name").distinct().first()[0] == "sales tab"


def test_partition_filter_prunes(spark, numbers, tmp_path):
    days = numbers.withColumn("partition", F.format_string("D24010%d", F.col("k") % 3 + 1))
    days.write.partitionBy("partition").parquet(str(tmp_path / "t"))
    day = readers.read_partition(spark, str(tmp_path), "t", "Dyymmdd", "A.B.D240102")
    assert day.count() == 20
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(partition" in plan


def test_publish_modes(spark, numbers, tmp_path):
    path = str(tmp_path / "p")
    tagged = numbers.withColumn("part", F.when(F.col("k") < 30, "a").otherwise("b"))
    counts = lambda: dict(tuple(r) for r in spark.read.parquet(path).groupBy("part").count().collect())
    sinks.publish(tagged, path, ["part"])
    sinks.publish(tagged.where("part = 'a'"), path, ["part"])
    assert counts() == {"a": 60, "b": 30}
    sinks.publish_partitions(tagged.where("part = 'a'"), path, ["part"])
    assert counts() == {"a": 30, "b": 30}
    sinks.publish(tagged.where("part = 'b'"), path, ["part"], "replace")
    assert counts() == {"b": 30}
    source = str(tmp_path / "source")
    for day in ("Full.D1", "Delta.D1", "Delta.D2"):
        numbers.write.parquet(f"{source}/{day}")
    files = spark.read.option("recursiveFileLookup", "true").parquet(source)
    sinks.publish(files, path, ["part"], "refresh", "Delta")
    assert counts() == {"Delta.D1": 60, "Delta.D2": 60}
    with pytest.raises(ValueError):
        sinks.publish(tagged, path, ["part"], "sideways")


def test_inventory_reads_no_content(spark, numbers, tmp_path):
    for day in ("D1", "D2"):
        numbers.coalesce(1).write.parquet(str(tmp_path / "x" / day))
    found = readers.file_inventory(spark, str(tmp_path / "x"), "parquet$")
    assert [(r.name.split("/")[-2], r.files) for r in found.collect()] == [("D1", 1), ("D2", 1)]
    assert "content" not in found._jdf.queryExecution().optimizedPlan().toString().split("Relation")[0]
    each = readers.file_inventory(spark, str(tmp_path / "x"), "D2/.*parquet$", expand_folders=True)
    assert each.count() == 1


def test_newest_version_counts(spark, tmp_path):
    path = str(tmp_path / "r")
    schema = "Name string, n int"
    records.append_record(spark.createDataFrame([("a", 1), ("b", 1)], schema), path, datetime(2024, 1, 1))
    records.append_record(spark.createDataFrame([("a", 2)], schema), path, datetime(2024, 3, 1))
    stored = records.read_records(spark, path)
    newest = {r.Name: r.n for r in records.latest_by_key(stored, ["Name"]).collect()}
    assert newest == {"a": 2, "b": 1}
    written = {r.Name: (r.CreatedOn, r.LastModifiedOn) for r in records.first_written(stored, ["Name"]).collect()}
    assert written["a"] == (datetime(2024, 1, 1), datetime(2024, 3, 1))
    assert records.expire(stored, datetime(2024, 2, 2)).count() == 1
    assert records.expire(stored, datetime(2024, 2, 1)).count() == 3


def test_writers_at_the_same_time(spark, tmp_path):
    path = str(tmp_path / "r")
    one = lambda i: records.append_record(spark.createDataFrame([(str(i), i)], "Name string, n int"), path)
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(one, range(40)))
    assert {r.n for r in records.read_records(spark, path).collect()} == set(range(40))
    assert records.read_records(spark, str(tmp_path / "none")) is None


def test_latest_view_keeps_every_row_of_the_newest_run(spark):
    rows = [("t", 1, "x"), ("t", 2, "y"), ("t", 2, "z"), (None, 1, "w"), ("u", 5, "v")]
    df = spark.createDataFrame(rows, "table_name string, run_ts int, x string")
    assert {r.x for r in records.latest_view(df).collect()} == {"y", "z", "w", "v"}
    assert records.series_view(df).count() == 5


def test_flatten(spark):
    df = spark.createDataFrame([("a", [(1, "x"), (2, "y")]), ("b", [])], "id string, rows array<struct<n:int,t:string>>")
    assert [tuple(r) for r in records.flatten(df, "rows").collect()] == [("a", 1, "x"), ("a", 2, "y")]


# Warehouse types and the Spark types they are read as.
TYPES = {
    "BIGINT": "long",
    "integer": "int",
    "int": "int",
    "smallint": "short",
    "date": "date",
    "timestamp": "timestamp",
    "double precision": "double",
    "numeric(18,0)": "long",
    "numeric(12, 2)": "decimal(12,2)",
    "decimal(5,1)": "decimal(5,1)",
    "character varying(20)": "string",
    "char(3)": "string",
    "boolean": "boolean",
}


def test_warehouse_types(spark):
    assert {t: spark_type(t) for t in TYPES} == TYPES
    with pytest.warns(UserWarning, match="geometry"):
        assert spark_type("geometry") == "string"


def test_casting_counts_what_is_lost(spark):
    df = spark.createDataFrame([("1", "1.25"), ("x", "9999999.5"), (None, "2")], "n string, d string")
    declared = [("n", "integer"), ("d", "numeric(5,2)")]
    assert [tuple(r) for r in cast_to_ddl(df, declared).select("n").collect()] == [(1,), (None,), (None,)]
    losses = {r.column_name: (r.cells, r.lost) for r in cast_losses(df, declared).collect()}
    assert losses == {"n": (2, 1), "d": (3, 1)}


def stream(spark, numbers, tmp_path, **kwargs):
    evaluate_arriving(
        spark, str(tmp_path / "in"), numbers.schema, RULES, str(tmp_path / "out"), str(tmp_path / "cp"), **kwargs
    ).awaitTermination()
    return spark.read.parquet(str(tmp_path / "out"))


def rows_of(results):
    return sorted((r.rule_no, r.metric, r.result) for r in results.collect())


def test_arriving_equals_batch_and_rerun_adds_nothing(spark, numbers, tmp_path):
    numbers.write.parquet(str(tmp_path / "in"))
    first = stream(spark, numbers, tmp_path)
    want = rows_of(evaluate(numbers, RULES))
    assert rows_of(first) == want
    assert rows_of(stream(spark, numbers, tmp_path)) == want
    later = numbers.withColumn("k", F.lit(7).cast("long"))
    later.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    both = stream(spark, numbers, tmp_path)
    assert both.count() == 2 * len(RULES)
    assert rows_of(both.where("batch_id = 1")) == rows_of(evaluate(later, RULES))


def test_each_arriving_file_is_judged(spark, numbers, tmp_path):
    numbers.repartition(3).write.parquet(str(tmp_path / "in"))
    results = stream(spark, numbers, tmp_path, per_file=True, max_files=2)
    sizes = results.where("rule_type = 'HasSize'")
    assert sizes.select(FILE).distinct().count() == 3
    assert sizes.agg(F.sum("metric")).first()[0] == 60.0
    assert results.select("batch_id").distinct().count() == 2


def test_scratch_tables_are_dropped_when_asked(spark):
    path = scratch.scratch_path(spark, "table")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3
    assert scratch.drop_scratch(spark) >= 1 and readers.read_path(spark, path) is None
    assert scratch.drop_scratch(spark) == 0


def test_a_local_folder_is_refused_on_a_cluster(spark, monkeypatch):
    class Conf:
        def get(self, name, default=None):
            return "file:/tmp/warehouse" if name == "spark.sql.warehouse.dir" else None

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)
        setCheckpointDir = staticmethod(lambda root: None)

    class Session:
        conf, sparkContext, _jvm, _jsc = Conf(), Context(), spark._jvm, spark._jsc

    with pytest.raises(ValueError):
        scratch.scratch_root(Session())
    Session.sparkContext.master = "local[4]"
    assert scratch.scratch_root(Session()) == "file:/tmp/warehouse/_scratch"
