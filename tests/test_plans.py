"""What the plans look like: no crossed rows, no Python, narrow scans, generated code."""

from __future__ import annotations

import re

import pytest

from plumbline import evaluate
from plumbline.gallery import QUERIES
from plumbline.gallery.rulesets import SLICE
from plumbline.operators import pairs as X

UNWANTED = re.compile(
    r"CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroups"
)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_crossed_rows_and_no_python(spark, name):
    found = plan(QUERIES[name](spark, "/root/testdata/sf0.001"))
    assert not UNWANTED.search(found)


def read_schemas(text):
    return [set(re.findall(r"(\w+):", s)) for s in re.findall(r"ReadSchema: struct<([^>]*)>", text)]


def test_branches_read_only_their_columns(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    found = read_schemas(plan(evaluate(lines, SLICE)))
    assert sorted(map(sorted, found)) == [
        ["l_discount", "l_quantity", "l_returnflag", "l_shipdate"],
        ["l_orderkey"],
    ]


def test_filters_reach_the_scan(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").where("l_quantity > 49")
    found = plan(evaluate(lines, ["HasSize > 0", 'IsUnique "l_orderkey"']))
    assert found.count("GreaterThan(l_quantity,49.0)") == 2


def test_wide_rule_sets_stay_in_generated_code(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    rules = [f'Satisfies "l_quantity > {i}" >= 0' for i in range(200)]
    results = evaluate(lines, rules)
    results.collect()
    found = plan(results).split("Initial Plan")[0]
    partial = [line for line in found.splitlines() if "HashAggregate" in line and "partial_" in line]
    assert len(partial) == 3
    assert all("*(" in line for line in partial)


def test_comparing_tables_shuffles_partial_counts(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    found = plan(X.referential_integrity(lines, ["l_orderkey"], orders, ["o_orderkey"]))
    assert "Join" not in found
    assert "partial_sum(n" in found.split("Exchange hashpartitioning")[1]
    assert found.count("Exchange hashpartitioning") == 1


def test_key_sets_share_one_scan_and_one_exchange(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    rules = [f'IsUnique "{c}"' for c in lines.columns]
    pairs = zip(lines.columns, lines.columns[1:])
    rules += [f'HasDistinctness "{a}" "{b}" > 0' for a, b in pairs if a != "l_suppkey"]
    assert len(rules) == 20
    found = plan(evaluate(lines, rules)).split("Initial Plan")[0]
    assert found.count("Scan parquet") == 1
    assert found.count("ENSURE_REQUIREMENTS") == 3  # groups, statistics of a set, all in one row
    assert "partial_count" in found and "Expand" not in found
