"""Versions that are seen whole, and a store read by key."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from plumbline.sources.keyed_store import KeyedStore
from plumbline.sources.versions import drop_unused, publish_version, read_version, unused_folders
from tests.test_plans import plan


def rows(spark, path, cols=("p",)):
    return sorted(map(tuple, read_version(spark, path, cols).select("k", "p").collect()), key=str)


def frame(spark, *values):
    return spark.createDataFrame(list(values), "k long, p string")


def test_modes_and_hidden_partitions(spark, tmp_path):
    path = str(tmp_path / "d")
    assert read_version(spark, path) is None
    assert publish_version(frame(spark, (1, "a"), (2, "1"), (3, None)), path, ["p"]) == 1
    assert publish_version(frame(spark, (4, "2"), (5, "a")), path, ["p"], "append") == 2
    assert rows(spark, path) == [(1, "a"), (2, "1"), (3, None), (4, "2"), (5, "a")]
    assert publish_version(frame(spark, (6, "a"), (7, None)), path, ["p"], "partitions") == 3
    assert rows(spark, path) == [(2, "1"), (4, "2"), (6, "a"), (7, None)]
    publish_version(frame(spark, (8, "x")), path, ["p"], "replace")
    assert rows(spark, path) == [(8, "x")]
    with pytest.raises(ValueError):
        publish_version(frame(spark, (8, "x")), path, ["p"], "other")


def test_a_write_that_fails_midway_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "d")
    publish_version(frame(spark, (1, "a"), (2, "b")), path, ["p"])
    reader = read_version(spark, path, ["p"])
    bad = frame(spark, *[(i, "c") for i in range(50)]).repartition(4).withColumn(
        "k", F.when(F.col("k") == 33, F.raise_error(F.lit("no")).cast("long")).otherwise(F.col("k"))
    )
    for mode in ("replace", "append", "partitions"):
        with pytest.raises(PySparkException):
            publish_version(bad, path, ["p"], mode)
        assert rows(spark, path) == [(1, "a"), (2, "b")]
    publish_version(frame(spark, (9, "z")), path, ["p"])
    assert reader.count() == 2  # one that began before goes on with its version
    assert len(unused_folders(spark, path)) == 3 and drop_unused(spark, path, keep=1) == 4
    assert rows(spark, path) == [(9, "z")]


def test_partition_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "d")
    publish_version(frame(spark, (1, "a"), (2, "b")), path, ["p"])
    publish_version(frame(spark, (3, "b")), path, ["p"], "partitions")
    found = plan(read_version(spark, path, ["p"]).where("p = 'a'"))
    assert found.count("PartitionFilters: [") == 2 and found.count("(p#") >= 2


def store(spark, path):
    return KeyedStore(spark, str(path), ["k"], buckets=8)


def values(df):
    return sorted((r.k, r.v) for r in df.collect())


def test_one_bucket_is_read(spark, tmp_path):
    s = store(spark, tmp_path)
    assert s.get("a") is None and s.read() is None
    s.append(spark.createDataFrame([(f"k{i}", i) for i in range(50)], "k string, v int"), datetime(2024, 1, 1))
    s.append(spark.createDataFrame([("k7", 70)], "k string, v int"), datetime(2024, 1, 2))
    found = s.get("k7")
    assert values(found) == [("k7", 70)] and s.get("none").count() == 0
    assert "key_bucket" in plan(found).split("PartitionFilters: [")[1].split("]")[0]


def test_compaction_is_swapped_in(spark, tmp_path):
    s = store(spark, tmp_path)
    for day in (1, 2, 3):
        s.append(spark.createDataFrame([("a", day), (f"b{day}", day)], "k string, v int"), datetime(2024, 1, day))
    before = values(s.newest())
    reader = s.newest()  # one that began before the compaction
    s.compact(as_of=datetime(2024, 1, 4))
    assert values(reader) == values(s.newest()) == before
    assert s.read().count() == 4 and values(s.get("a")) == [("a", 3)]
    s.append(spark.createDataFrame([("a", 9)], "k string, v int"), datetime(2024, 1, 5))
    assert values(s.get("a")) == [("a", 9)] and s.read().count() == 5
    s.compact(as_of=datetime(2024, 2, 3, 12))  # the first days' records have expired
    assert values(s.newest()) == [("a", 9), ("b3", 3)]
    assert s.drop_taken() == 5 and values(s.newest()) == [("a", 9), ("b3", 3)]


def test_a_write_during_compaction_is_kept(spark, tmp_path, monkeypatch):
    s = store(spark, tmp_path)
    s.append(spark.createDataFrame([("a", 1)], "k string, v int"), datetime(2024, 1, 1))
    swap = s._swap_in

    def late(*args):
        s.append(spark.createDataFrame([("b", 2)], "k string, v int"), datetime(2024, 1, 2))
        assert values(s.newest()) == [("a", 1), ("b", 2)]
        swap(*args)

    monkeypatch.setattr(s, "_swap_in", late)
    s.compact(as_of=datetime(2024, 1, 3))
    assert values(s.newest()) == [("a", 1), ("b", 2)] and s.read().count() == 2
