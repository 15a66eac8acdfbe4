"""Two-table checks against brute force on small fixtures."""

from __future__ import annotations

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from plumbline import Check, evaluate
from plumbline.operators import pairs as X

SCHEMA = "k int, a string, b int"
rows = st.lists(
    st.tuples(
        st.sampled_from([None, 1, 2, 3, 4]), st.sampled_from([None, "x", "y"]), st.sampled_from([0, 1])
    ),
    max_size=25,
)


def brute_match(df, ref):
    left, right = Counter(df), Counter(ref)
    same = left & right
    left, right = left - same, right - same
    by_key = lambda c: Counter(r[0] for r in c.elements())
    changed = by_key(left) & by_key(right)
    return (
        sum(same.values()),
        sum(changed.values()),
        sum((by_key(right) - changed).values()),
        sum((by_key(left) - changed).values()),
    )


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(df=rows, ref=rows)
def test_dataset_match(spark, df, ref):
    got = X.dataset_match(
        spark.createDataFrame(df, SCHEMA), spark.createDataFrame(ref, SCHEMA), ["k"]
    ).first()
    assert (got.matched, got.changed, got.missing, got.extra) == brute_match(df, ref)
    if ref:
        assert got.metric == pytest.approx(got.matched / len(ref))
    else:
        assert got.metric is None


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(child=rows, parent=rows)
def test_referential_integrity(spark, child, parent):
    got = X.referential_integrity(
        spark.createDataFrame(child, SCHEMA), ["k", "a"], spark.createDataFrame(parent, SCHEMA), ["k", "a"]
    ).first()
    complete = [r[:2] for r in child if None not in r[:2]]
    known = {r[:2] for r in parent}
    assert got.checked == len(complete)
    assert got.matched == sum(r in known for r in complete)


def test_hot_key_does_not_multiply(spark):
    """A hundred thousand copies of one key on both sides: counted, never paired."""
    df = spark.range(0, 150000, 1, 8).select(
        F.when(F.col("id") < 100000, 0).otherwise(F.col("id")).alias("k"), F.lit(1).alias("v")
    )
    ref = df.where("k = 0 OR k < 140000")
    got = X.dataset_match(df, ref, ["k"]).first()
    assert (got.matched, got.changed, got.missing, got.extra) == (140000, 0, 0, 10000)
    child = X.referential_integrity(df, ["k"], ref, ["k"]).first()
    assert (child.checked, child.matched) == (150000, 140000)


def test_dropped_column_of_a_written_partition(spark, tmp_path):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "k int, a string")
    df.write.parquet(str(tmp_path / "t" / "day=1"))
    df.drop("a").write.parquet(str(tmp_path / "t" / "day=2"))
    merged = spark.read.option("mergeSchema", "true").parquet(str(tmp_path / "t"))
    found = {tuple(r) for r in X.dropped_columns(merged, ["k", "a", "z"], ["day"]).collect()}
    assert found == {(1, "z"), (2, "a"), (2, "z")}


def test_schema_conformance(spark):
    df = spark.createDataFrame([("1", "2024-01-01"), ("x", None)], "n string, d string")
    other = spark.createDataFrame([], "n int, d date, z string")
    found = {r.column_name: (r.present, r.cells, r.castable, r.metric) for r in X.schema_conformance(df, other).collect()}
    assert found == {"n": (True, 2, 1, 0.5), "d": (True, 1, 1, 1.0), "z": (False, 0, 0, 0.0)}


def test_custom_sql_leaves_no_view_behind(spark):
    df = spark.createDataFrame([(1,), (2,)], "n int")
    before = {t.name for t in spark.catalog.listTables()}
    assert X.custom_sql(spark, "SELECT sum(n) FROM {primary}", {"primary": df}).first().metric == 3.0
    assert {t.name for t in spark.catalog.listTables()} == before


def test_two_table_rules(spark):
    df = spark.createDataFrame([(1, 10), (2, 20), (9, 30)], "k int, v int")
    ref = spark.createDataFrame([(1, 10), (2, 21)], "k int, v int")
    texts = [
        'ReferentialIntegrity "k" "ref.k" >= 0.6',
        'RowCountMatch "ref" = 1.5',
        'AggregateMatch "sum(v)" "ref" "sum(v)" between 1 and 2',
        'DatasetMatch "ref" "k" >= 0.5',
        'DatasetMatch "ref" "k" "v" = 0.5',
        'SchemaMatch "ref"',
        'CustomSql "SELECT count(*) FROM {primary} JOIN {ref} USING (k)" = 2',
    ]
    rows = {r.rule_no: r for r in evaluate(df, texts, references={"ref": ref}).collect()}
    assert [rows[i].result for i in range(len(texts))] == ["PASS"] * len(texts)
    check = (
        Check("c")
        .referentialIntegrity(["k"], "ref", ["k"], ">= 0.6")
        .rowCountMatch("ref", 1.5)
        .aggregateMatch("sum(v)", "ref", "sum(v)", "between 1 and 2")
        .datasetMatch("ref", ["k"], assertion=">= 0.5")
        .datasetMatch("ref", ["k"], ["v"], 0.5)
        .schemaMatch("ref")
        .customSql("SELECT count(*) FROM {primary} JOIN {ref} USING (k)", 2)
    )
    built = {r.rule_no: r for r in evaluate(df, check, references={"ref": ref}).collect()}
    assert {i: (r.metric, r.result) for i, r in built.items()} == {
        i: (r.metric, r.result) for i, r in rows.items()
    }


@pytest.mark.parametrize("drift", [0, 1, 40, 3000])
def test_digests_give_the_counts_of_the_full_comparison(spark, drift, monkeypatch):
    i = F.col("id")
    reference = spark.range(3000).select(
        i.cast("int").alias("k"), (i % 7).alias("a"), F.when(i % 5 != 0, (i % 3).cast("double")).alias("b"), F.lit("t" * 90).alias("c")
    )
    spread = F.pmod(F.xxhash64("k"), F.lit(3000)) < drift
    df = reference.withColumn("a", F.when(spread & (F.col("k") % 3 == 0), None).otherwise(F.col("a"))).where(
        ~(spread & (F.col("k") % 3 == 1))
    )
    df = df.unionByName(df.where(spread & (F.col("k") % 3 == 2))).withColumn("k", F.col("k").cast("long"))
    looked = []
    whole = X.dataset_match
    monkeypatch.setattr(X, "dataset_match", lambda d, o, *a: (looked.append(o), whole(d, o, *a))[1])
    got = X.digest_match(df, reference, ["k"]).first()
    assert tuple(got) == tuple(whole(df, reference, ["k"]).first())
    assert looked[0].count() <= max(4 * drift, 0)


def test_digests_tell_null_from_its_place_and_count_copies(spark):
    a = spark.createDataFrame([(1, None, 5), (2, 3, 3), (2, 3, 3), (3, 0, None)], "k int, x int, y int")
    b = spark.createDataFrame([(1, 5, None), (2, 3, 3), (3, 0, None)], "k int, x int, y int")
    for left, right in ((a, b), (b, a), (a, a), (a.limit(0), a), (a, a.limit(0))):
        assert tuple(X.digest_match(left, right, ["k"]).first()) == tuple(X.dataset_match(left, right, ["k"]).first())
