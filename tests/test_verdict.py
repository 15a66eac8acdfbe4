"""Cases that data sets at hand do not meet: cards among digits, collations, failing rules, many tables."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from plumbline import evaluate
from plumbline.functions import predicates as P
from plumbline.operators import aggregates as A
from plumbline.plans.runs import DataQuality
from plumbline.sources.records import append_record, compact_records, latest_by_key, latest_view, read_records


def metrics(df, rules, **options):
    rows = evaluate(df, rules, **options).collect()
    return {r.rule_no: (r.metric, r.result) for r in rows}


@pytest.mark.parametrize(
    "text, found",
    [
        ("4111 1111 1111 1111 12/25", True),
        ("4111111111111111 123", True),
        ("no 12 4111-1111-1111-1111 here", True),
        ("00004111111111111111", False),
        ("4111111111111112", False),
        ("x4111111111111111", False),
        ("4111111111111111", True),
        ("1 2 3", False),
        (None, None),
    ],
)
def test_cards(spark, text, found):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(P.contains_credit_card_number(F.col("t"))).first()[0] is found


def test_length_bounds_keep_their_fraction(spark):
    df = spark.createDataFrame([("abc",)], "t string")
    rules = [f'ColumnLength "t" {e}' for e in (">= 3.5", "= 3.5", "< 3.5", ">= 3", "between 2.5 and 3.5")]
    assert [r for _, (_, r) in sorted(metrics(df, rules).items())] == ["FAIL", "FAIL", "PASS", "PASS", "PASS"]


@pytest.mark.parametrize("size", [4, 101])
def test_collated_texts_are_equal_at_any_length(spark, size):
    df = spark.sql(f"SELECT v COLLATE UTF8_LCASE AS t FROM VALUES (repeat('a', {size})), (repeat('A', {size})) AS x(v)")
    assert metrics(df, ['HasNumberOfDistinctValues "t" = 1'])[0] == (1.0, "PASS")


def test_trailing_line_breaks_are_no_numbers(spark):
    df = spark.createDataFrame([("12\n",), ("false\n",), ("1.5\n",)], "t string")
    assert metrics(df, ['HasDataType "t" = "Integral" with threshold > 0', 'HasDataType "t" = "Boolean" with threshold > 0'])[0][0] == 0.0


def test_a_broken_rule_leaves_the_others(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "t string, n int")
    other = spark.createDataFrame([("a",)], "k string")
    rules = [
        "HasSize = 2",
        'HasPattern "t" matches "[a"',
        'IsLessThan "t" "n"',
        'CustomSql "SELECT n FROM {primary}" > 0',
        'ReferentialIntegrity "n" "o.k"',
        'CustomSql "SELECT max(n) FROM {primary}" = 2',
        'DatasetMatch "o" "n" "t"',
    ]
    found = metrics(df, rules, references={"o": other})
    assert [found[i][1] for i in range(7)] == ["PASS", "ERROR", "ERROR", "ERROR", "ERROR", "PASS", "ERROR"]


def test_a_run_that_fails_says_so(spark, tmp_path):
    dq = DataQuality(spark, str(tmp_path / "store"))
    bad = tmp_path / "bad.parquet"
    bad.write_text("no parquet")
    with pytest.raises(Exception):
        dq.start_data_quality_profile_run({"Path": str(bad)})
    runs = dq.table("runs").orderBy("written_at").collect()
    assert runs[-1].Status == "FAILED" and runs[-1].StatusMsg


def test_newest_runs_leave_the_rows_where_they_are(spark):
    rows = spark.range(2000).select(
        (F.col("id") % 7).cast("string").alias("table_name"), (F.col("id") % 5).alias("run_ts"), F.col("id")
    )
    few, many = latest_view(rows), latest_view(rows, sent_tables=3)
    plan = few._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and "broadcast" in plan
    want = {r.id for r in rows.where("run_ts = 4").collect()}
    assert {r.id for r in few.collect()} == {r.id for r in many.collect()} == want
    assert few.columns == many.columns == rows.columns


def test_bucket_counts(spark):
    df = spark.range(1001).select(F.col("id").cast("double").alias("x"))
    rows = A.kll_buckets(df, "x", 10).orderBy("bucket").collect()
    assert [(r.low, r.high) for r in rows] == [(100.0 * i, 100.0 * (i + 1)) for i in range(10)]
    assert sum(r["count"] for r in rows) == pytest.approx(1001, abs=2)
    assert all(abs(r["count"] - 100) <= 5 for r in rows)
    assert A.kll_buckets(df.where("x < 0"), "x").collect() == []


def test_compaction_keeps_living_versions_in_a_folder_per_day(spark, tmp_path):
    path, target = str(tmp_path / "many"), str(tmp_path / "few")
    for day in (1, 5, 5, 6, 6):
        row = spark.createDataFrame([("k", day)], "key string, n int")
        append_record(row, path, datetime(2024, 1, day))
    compact_records(spark, path, target, as_of=datetime(2024, 1, 10), days=6)
    folders = sorted(p.name for p in (tmp_path / "few").iterdir() if p.is_dir())
    assert folders == ["write_id=d-2024-01-05", "write_id=d-2024-01-06"]
    found = read_records(spark, target)
    assert found.count() == 4 and latest_by_key(found, ["key"]).first().n == 6
    compact_records(spark, str(tmp_path / "none"), str(tmp_path / "nothing"))
    dq = DataQuality(spark, str(tmp_path / "store"))
    dq.update_data_quality_ruleset("r", "HasSize > 0")
    moved = dq.compact_to(str(tmp_path / "moved"))
    assert moved.get_data_quality_ruleset("r")["Ruleset"] == "HasSize > 0"
