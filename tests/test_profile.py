"""Profiles, suggestions, and the loop back to evaluation."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from plumbline import evaluate, profile, recommend, suggest
from plumbline.functions.rows import rows_frame
from plumbline.operators.profile import counted_values, heavy_hitters, histograms, value_counts
from plumbline.operators.quantiles import exact_quantiles
from plumbline.operators.suggest import suggest_unique, suggested_values, value_sets


@pytest.fixture(scope="module")
def mixed(spark):
    """Every kind of column, with NULLs, in 1000 rows."""
    i = F.col("id")
    return spark.range(0, 1000, 1, 4).select(
        i.alias("id"),
        F.when(i % 10 != 0, i).alias("sparse"),
        i.cast("string").alias("whole_text"),
        F.when(i % 2 == 0, (i / 4).cast("string")).otherwise(F.lit("7")).alias("number_text"),
        F.when(i % 2 == 0, "TRUE").otherwise("false").alias("flag_text"),
        F.when(i % 100 == 0, 'rare "x", (y)').when(i % 3 == 0, "b, B c").otherwise("a").alias("category"),
        F.lit(None).cast("int").alias("empty"),
        (i - 500).alias("signed"),
        F.array(i).alias("list"),
        (i % 7 == 0).alias("flag"),
        (i % 130).cast("string").alias("many"),
    )


@pytest.fixture(scope="module")
def profiled(mixed):
    return {r.column_name: r for r in profile(mixed, counted=["category", "flag", "many"]).collect()}


def test_sorted_one_row_per_column(mixed):
    names = [r.column_name for r in profile(mixed).collect()]
    assert names == sorted(mixed.columns)


def test_kinds(profiled):
    kinds = {n: (r.profile_type, r.data_type, r.is_data_type_inferred) for n, r in profiled.items()}
    assert kinds == {
        "id": ("Numeric", "Integral", False),
        "sparse": ("Numeric", "Integral", False),
        "whole_text": ("Numeric", "Integral", True),
        "number_text": ("Numeric", "Fractional", True),
        "flag_text": ("Standard", "Boolean", True),
        "category": ("Standard", "String", False),
        "empty": ("Numeric", "Integral", False),
        "signed": ("Numeric", "Integral", False),
        "list": ("Standard", "Unknown", False),
        "flag": ("Standard", "Boolean", False),
        "many": ("Numeric", "Integral", True),
    }


def test_numbers(profiled):
    assert (profiled["sparse"].completeness, profiled["sparse"].cells) == (0.9, 900)
    signed = profiled["signed"]
    assert (signed.minimum, signed.maximum, signed.sum) == (-500.0, 499.0, -500.0)
    assert signed.std_dev == pytest.approx(math.sqrt((1000**2 - 1) / 12))
    assert len(signed.approx_percentiles) == 100
    for q in (10, 50, 90):
        assert abs(signed.approx_percentiles[q - 1] - (q * 10 - 501)) <= 20
    text = profiled["whole_text"]
    assert (text.minimum, text.maximum, text.mean) == (0.0, 999.0, 499.5)
    empty = profiled["empty"]
    assert (empty.completeness, empty.minimum, empty.approx_percentiles, empty.distinct) == (0.0, None, None, None)


def test_type_counts_add_up(profiled):
    for row in profiled.values():
        if row.type_counts:
            assert sum(row.type_counts.values()) == row.rows


def test_histograms(mixed, profiled):
    bins = {}
    for r in histograms(mixed, ["category", "many", "id"]).collect():
        bins.setdefault(r.column_name, {})[r.value] = (r["count"], r.ratio)
    assert bins["category"] == {"a": (660, 0.66), "b, B c": (330, 0.33), 'rare "x", (y)': (10, 0.01)}
    assert len(bins["many"]) == 130 and len(bins["id"]) == 1000, "no column is cut"
    assert {n: r.distinct for n, r in profiled.items() if r.is_counted} == {"category": 3, "flag": 2, "many": 130}
    assert profiled["id"].distinct is None and not profiled["id"].is_counted


@pytest.mark.parametrize("n", [121, 150])
def test_any_number_of_categories(spark, n):
    """Most rows have the first 50 of many values, all alike often."""
    i = F.col("id")
    df = spark.range(0, 20_000).select(
        F.concat(F.lit("v"), F.when(i % 100 < 95, i % 50).otherwise(50 + F.floor(i / 100) % (n - 50))).alias("v")
    )
    counts, found = value_counts(df, ["v"]), profile(df)
    distinct = df.distinct().count()
    rules = {r.suggesting_rule for r in suggest(found, counts).collect()}
    assert {"CategoricalRangeRule", "FractionalCategoricalRangeRule"} <= rules
    values = suggested_values(found, counts).groupBy("suggesting_rule").count().collect()
    sizes = {r.suggesting_rule: r["count"] for r in values}
    assert sizes["CategoricalRangeRule"] == distinct > 120
    assert 40 <= sizes["FractionalCategoricalRangeRule"] <= 60


def test_sums_do_not_overflow(spark):
    df = spark.createDataFrame([(2**62, 1.0), (2**62, float("nan")), (2**62, 3.0), (2**62, None)], "h long, f double")
    rows = {r.column_name: r for r in profile(df).collect()}
    assert rows["h"].sum == 4.0 * 2**62 and rows["h"].mean == 2.0**62
    assert (rows["f"].nans, rows["f"].minimum, rows["f"].maximum, rows["f"].sum) == (1, 1.0, 3.0, 4.0)
    results = evaluate(df, ["HasSize > 0", 'HasSum "h" > 0', 'IsPositive "f"', 'ColumnValues "f" > 0']).collect()
    assert [r.result for r in sorted(results, key=lambda r: r.rule_no)] == ["PASS", "PASS", "FAIL", "FAIL"]
    wide = spark.sql("SELECT CAST('99999999999999999999999999999999999999' AS DECIMAL(38,0)) AS d FROM range(3)")
    assert profile(wide).first().sum == pytest.approx(3e38)


def test_empty_table(spark):
    rows = profile(spark.createDataFrame([], "a int, b string")).collect()
    assert [(r.column_name, r.rows, r.completeness) for r in rows] == [("a", 0, None), ("b", 0, None)]
    assert suggest(profile(spark.createDataFrame([], "a int, b string"))).collect() == []


def test_suggested_rules_hold_on_their_own_data(mixed):
    found = profile(mixed)
    counts = value_counts(mixed, ["category", "many"])
    suggestions = suggest(found, counts).unionByName(suggest_unique(mixed, found))
    values = suggested_values(found, counts)
    rules = {(r.column_name, r.suggesting_rule): r.dqdl_rule for r in suggestions.collect()}
    assert rules[("sparse", "RetainCompletenessRule")] == 'HasCompleteness "sparse" >= 0.88'
    assert rules[("whole_text", "RetainTypeRule")] == 'HasDataType "whole_text" = "Integral"'
    assert rules[("category", "CategoricalRangeRule")] == (
        'IsContainedIn "category" in ["a","b, B c","rare ""x"", (y)"]'
    )
    assert rules[("category", "FractionalCategoricalRangeRule")] == (
        'IsContainedIn "category" in ["a","b, B c"] with threshold >= 0.98'
    )
    assert rules[("id", "UniqueIfUniqueRule")] == 'IsUnique "id"'
    assert ("signed", "NonNegativeNumbersRule") not in rules
    assert ("number_text", "UniqueIfUniqueRule") not in rules
    rulesets = recommend(suggestions.withColumn("table_name", F.lit("mixed")), "run-1")
    (ruleset,) = rulesets.collect()
    assert ruleset.Name == "mixed_generated"
    assert ruleset.Tags == {"SuggestionRunId": "run-1"}
    kept = {}
    for r in values.collect():
        kept.setdefault((r.column_name, r.suggesting_rule), set()).add(r.value)
    assert kept == {
        ("category", "CategoricalRangeRule"): {"a", "b, B c", 'rare "x", (y)'},
        ("category", "FractionalCategoricalRangeRule"): {"a", "b, B c"},
    }
    results = evaluate(mixed, rulesets, references=value_sets(suggestions, values)).collect()
    assert len(results) == len(rules)
    assert {r.result for r in results} == {"PASS"}
    assert {r.rule_text for r in results} == set(rules.values())


def test_same_profile_however_partitioned(mixed):
    exact = ["column_name", "data_type", "rows", "cells", "minimum", "maximum", "approx_distinct"]
    want = profile(mixed).select(*exact).collect()
    assert profile(mixed.repartition(13)).select(*exact).collect() == want


def test_columns_of_few_values_are_found_and_counted_once(spark, mixed):
    counts = counted_values(mixed, profile(mixed))
    few = {"flag_text", "category", "empty", "flag"}
    assert {r.column_name for r in counts.select("column_name").distinct().collect()} == few
    again = {(r.column_name, r.value): r["count"] for r in value_counts(mixed, sorted(few)).collect()}
    assert {(r.column_name, r.value): r["count"] for r in counts.collect()} == again
    assert all("/value_counts-" in f for f in counts.inputFiles())
    assert {r.column_name for r in counted_values(mixed, most=2).collect()} == {"flag", "flag_text", "empty"}
    assert histograms(mixed).count() == counts.count()


def test_long_lists_and_line_breaks_go_by_name(spark):
    i = F.col("id")
    df = spark.range(0, 20_000).select(
        F.concat(F.lit("v"), (i % 150).cast("string")).alias("many"),
        F.concat(F.lit("line\n"), (i % 3).cast("string")).alias("broken"),
        F.concat(F.lit('"q, ]" '), (i % 3).cast("string")).alias("odd"),
    )
    found = profile(df)
    counts = value_counts(df, ["many", "broken", "odd"])
    suggestions = suggest(found, counts).where("suggesting_rule = 'CategoricalRangeRule'")
    kinds = {r.column_name: r.dqdl_rule.split(" ")[0] for r in suggestions.collect()}
    assert kinds == {"many": "ReferentialIntegrity", "broken": "ReferentialIntegrity", "odd": "IsContainedIn"}
    sets = value_sets(suggestions, suggested_values(found, counts))
    assert set(sets) == {"values of many", "values of broken"}
    results = evaluate(df, recommend(suggestions.withColumn("table_name", F.lit("t"))), references=sets)
    assert [r.result for r in results.collect()] == ["PASS"] * 3


@pytest.mark.parametrize("kind", ["long", "int", "double", "float", "decimal(20,2)"])
def test_exact_quantiles(spark, kind):
    rng = random.Random(3)
    pools = [
        [rng.gauss(0, 1000) for _ in range(500)],
        [7.0] * 300 + [rng.random() for _ in range(99)],
        [1e-9 * rng.random() for _ in range(50)] + [1e9, -1e9, 0.0, -0.0],
        [5.0],
    ]
    for pool in pools:
        df = spark.createDataFrame([(x,) for x in [*pool, None]], "v double").select(F.col("v").cast(kind))
        ordered = sorted(r.v for r in df.where("v IS NOT NULL").collect())
        shares = [0, 0.001, 0.25, 0.5, 1 / 3, 0.9, 1]
        want = [ordered[max(1, math.ceil(q * len(ordered))) - 1] for q in shares]
        assert exact_quantiles(df, "v", shares, buckets=16) == want


def test_exact_quantiles_at_the_ends_of_types(spark):
    df = spark.createDataFrame([(2**63 - 1, 1e308), (-(2**63), -1e308), (2**63 - 2, float("nan")), (0, float("inf"))], "l long, d double")
    assert exact_quantiles(df, "l", [0, 0.5, 0.75, 1]) == [-(2**63), 0, 2**63 - 2, 2**63 - 1]
    assert exact_quantiles(df, "d", [0, 0.5, 1]) == [-1e308, 1e308, float("inf")]
    assert exact_quantiles(df.limit(0), "l", [0.5]) == [None]
    rules = ['HasExactQuantile "l" "0.5" = 0', 'HasExactQuantile "l" "2" = 0']
    assert [r.result for r in sorted(evaluate(df, rules).collect(), key=lambda r: r.rule_no)] == ["PASS", "ERROR"]


@pytest.mark.parametrize("share", [0.001, 0.02, 0.3])
def test_heavy_hitters_are_all_found_and_counted(spark, share):
    i = F.col("id")
    df = spark.range(0, 30_000, 1, 8).select(
        F.when(i % 3 == 0, "hot").otherwise(i.cast("string")).alias("third"),
        F.floor(F.sqrt(i)).cast("int").alias("spread"),
        F.when(i % 50 == 1, F.lit("long text " * 30)).when(i % 7 != 0, F.concat(F.lit("text " * 20), i.cast("string"))).alias("long"),
        F.floor(i * i % 9973 / 100).alias("even"),
        F.array(i).alias("list"),
    )
    got = {(r.column_name, r.value): r["count"] for r in heavy_hitters(df, share).collect()}
    flat = [c for c in df.columns if c != "list"]
    every = value_counts(df, flat).where(f"value IS NOT NULL AND count >= {share * 30_000}")
    assert got == {(r.column_name, r.value): r["count"] for r in every.collect()}
    assert ("third", "hot") in got


def test_columns_that_turn_out_to_have_more_values_are_left_out(spark):
    df = spark.range(60).selectExpr("id % 3 AS few", "id % 23 AS many")
    assert {r.column_name for r in counted_values(df, most=22).collect()} == {"few"}
    assert {r.column_name for r in counted_values(df, most=23).collect()} == {"few", "many"}


def test_rows_of_metadata_are_part_of_the_plan(spark):
    schema = "name string, n bigint, xs array<double>"
    df = rows_frame(spark, [("a", 1, [0.5, None]), (None, None, None)], schema)
    assert [tuple(r) for r in df.collect()] == [("a", 1, [0.5, None]), (None, None, None)]
    assert "LocalTableScan" in df.where("n = 1")._jdf.queryExecution().executedPlan().toString()
    assert rows_frame(spark, [], schema).collect() == []
