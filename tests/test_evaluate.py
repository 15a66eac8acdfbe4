"""Evaluation: the golden example, fusion, edge cases, partitions, scores."""

from __future__ import annotations

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from plumbline import evaluate, evaluate_many, profile
from plumbline.plans import score as S

# The one published example, its rules and rows.
GOLDEN = [
    "HasSize >= 3",
    'HasMin "b" = 0',
    'IsComplete "c"',
    'IsUnique "a"',
    'IsContainedIn "a" in ["foo","bar","baz"]',
    'IsNonNegative "b"',
]


@pytest.fixture
def golden(spark):
    return spark.createDataFrame([("foo", 1, 5), ("bar", 2, 6), ("baz", 3, None)], "a string, b int, c int")


def outcome(results):
    return {
        (r.ruleset_name, r.rule_no): (None if r.metric is None else round(r.metric, 9), r.result)
        for r in results.collect()
    }


def test_golden_example(golden):
    results = evaluate(golden, GOLDEN)
    found = {r.rule_no: (round(r.metric, 6), r.result) for r in results.collect()}
    assert found == {
        0: (3.0, "PASS"),
        1: (1.0, "FAIL"),
        2: (0.666667, "FAIL"),
        3: (1.0, "PASS"),
        4: (1.0, "PASS"),
        5: (1.0, "PASS"),
    }
    tally = S.tally(results).first()
    assert tally.tally == {"RULES": 6, "PASS": 4, "FAIL": 2}
    assert tally.score == pytest.approx(4 / 6)
    assert S.check_status(results).first().status == "Error"
    constraints = S.check_results(results, "Warning").collect()
    assert {(r.check_status, r.check_level) for r in constraints} == {("Warning", "Warning")}
    assert sum(r.constraint_status == "Success" for r in constraints) == 4
    failing = {r.rule_no: r.message for r in S.failing(results).collect()}
    assert failing[1] == "value 1.0 does not meet: = 0"
    assert set(failing) == {1, 2}


def test_result_records_keep_rule_order(golden):
    moment = datetime(2024, 1, 31, 12)
    records = S.result_records(evaluate(golden, GOLDEN, name="g"), "run", {"Path": "p"}, moment, moment)
    (record,) = records.collect()
    assert record.ResultId == "dqresult-2024-01-31T12:00:00.000000Z-g"
    assert [r.Name for r in record.RuleResults] == [f"Rule_{i}" for i in range(6)]
    assert [r.Description for r in record.RuleResults] == [t.strip() for t in GOLDEN]
    assert record.Tally == {"RULES": 6, "PASS": 4, "FAIL": 2}


EVERY = [
    *GOLDEN,
    'HasMax "b" = 3',
    'HasMean "b" = 2',
    'HasSum "b" = 6',
    'HasStandardDeviation "b" < 1',
    'HasCorrelation "b" "c" > 0',
    'HasMinLength "a" = 3',
    'HasMaxLength "a" = 3',
    'HasApproxCountDistinct "a" = 3',
    'HasApproxQuantile "b" "0.5" = 2',
    'KllSketchSatisfies "b" "0.5" = 2',
    'KllSketchSatisfies "b" "rank" "2" > 0.6',
    'AreComplete "a" "b"',
    'AreAnyComplete "b" "c"',
    'IsPositive "b"',
    'IsLessThan "b" "c"',
    'Satisfies "b * 2 > c" >= 0.3',
    'HasPattern "a" matches "^ba" with threshold > 0.5',
    'HasDataType "a" = "int" with threshold = 0',
    'ColumnValues "b" between 0 and 4',
    'ColumnLength "a" = 3',
    'HasUniqueness "a" "b"',
    'HasDistinctness "c" = 1',
    'HasUniqueValueRatio "c" = 1',
    'HasNumberOfDistinctValues "c" = 2',
    'IsPrimaryKey "a"',
    'IsPrimaryKey "c"',
    'HasEntropy "a" > 1',
    'HasMutualInformation "a" "b" > 1',
    'HasHistogramValues "a" = 3',
    'HasHistogramValues "a" "foo" > 0.3',
    'ColumnExists "a"',
    'ColumnExists "z"',
    "ColumnCount = 3",
]


def test_fused_equals_one_by_one(golden):
    fused = outcome(evaluate(golden, EVERY))
    assert len(fused) == len(EVERY)
    for i, rule in enumerate(EVERY):
        assert outcome(evaluate(golden, [rule]))[("rules", 0)] == fused[("rules", i)], rule


def test_partitioning_does_not_matter(golden):
    want = outcome(evaluate(golden, EVERY))
    for frame in (golden.repartition(7), golden.coalesce(1), golden.orderBy(F.desc("b"))):
        assert outcome(evaluate(frame, EVERY)) == want


def test_more_rules_than_one_aggregate_holds(golden):
    rules = [f'HasMin "b" > {i}' for i in range(20)] + [
        f'Satisfies "b > {i}" >= 0' for i in range(200)
    ]
    found = outcome(evaluate(golden, rules))
    assert len(found) == 220
    assert found[("rules", 20)] == (1.0, "PASS")
    assert found[("rules", 22)] == (pytest.approx(1 / 3), "PASS")


def test_empty_table_fails_with_a_message(golden):
    rows = evaluate(golden.where("false"), EVERY).collect()
    found = {r.rule_text: r for r in rows}
    assert len(rows) == len(EVERY)
    assert found["HasSize >= 3"].metric == 0.0
    for rule in ('IsComplete "c"', 'IsUnique "a"', 'HasMin "b" = 0', 'HasEntropy "a" > 1'):
        assert (found[rule].metric, found[rule].result) == (None, "FAIL")
        assert "no value" in found[rule].message


def test_all_null_column(spark):
    df = spark.createDataFrame([(None, None), (None, None)], "n int, t string")
    found = {r.rule_text: r for r in evaluate(
        df,
        [
            'IsComplete "n"',
            'HasMin "n" > 0',
            'IsUnique "n"',
            'IsContainedIn "t" in ["a"]',
            'IsNonNegative "n"',
            'HasDataType "t" = "int"',
            'HasApproxQuantile "n" "0.5" > 0',
            'KllSketchSatisfies "n" "0.5" > 0',
            'HasMutualInformation "n" "t" = 0',
            'IsPrimaryKey "n"',
        ],
    ).collect()}
    assert found['IsComplete "n"'].metric == 0.0
    assert found['IsContainedIn "t" in ["a"]'].result == "PASS"
    assert found['IsNonNegative "n"'].result == "PASS"
    assert found['IsPrimaryKey "n"'].metric == 0.0
    for rule in ('HasMin "n" > 0', 'IsUnique "n"', 'HasDataType "t" = "int"', 'KllSketchSatisfies "n" "0.5" > 0'):
        assert (found[rule].metric, found[rule].result) == (None, "FAIL"), rule


def test_nan_meets_no_demand(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    (row,) = evaluate(df, ['HasMax "x" > 0']).collect()
    assert row.result == "FAIL"
    only = df.where("isnan(x)")
    found = {r.rule_no: r.metric for r in evaluate(only, ['KllSketchSatisfies "x" "0.5" > 0', "HasSize = 1"]).collect()}
    assert found == {0: None, 1: 1.0}
    assert profile(only).first().approx_percentiles is None


def test_list_values_with_blanks_commas_quotes_brackets(spark):
    awkward = ["a b", "c,d", 'e"f', "g (h)", "[i]", "it's", "back\\slash", "$1"]
    df = spark.createDataFrame([(v,) for v in awkward], "t string")
    listed = ",".join('"' + v.replace('"', '""') + '"' for v in awkward)
    (row,) = evaluate(df, [f'IsContainedIn "t" in [{listed}]']).collect()
    assert (row.metric, row.result) == (1.0, "PASS")


def test_list_values_take_the_type_of_the_column(spark):
    df = spark.createDataFrame([(1, 1.0, True), (2, 2.5, False)], "i int, d double, b boolean")
    rows = evaluate(
        df,
        [
            'IsContainedIn "i" in [1,2]',
            'IsContainedIn "d" in ["1","2.5"]',
            'IsContainedIn "b" in ["true","false"]',
            'IsContainedIn "i" in ["one","2"] with threshold = 0.5',
        ],
    ).collect()
    assert [r.result for r in rows] == ["PASS"] * 4


def test_values_compare_as_numbers(spark):
    df = spark.createDataFrame(
        [(1, 1.5, "1.0"), (2, 2.5, "x"), (3, 3.5, None)], "i int, d double, t string"
    ).withColumns({"m": F.col("d").cast("decimal(5,2)"), "day": F.expr("date_add(DATE '2023-12-31', i)")})
    rules = {
        'ColumnValues "i" between 0 and 4': 1.0,
        'ColumnValues "i" between 1 and 3': 1 / 3,
        'ColumnValues "i" >= 2': 2 / 3,
        'ColumnValues "i" > 1.5': 2 / 3,
        'ColumnValues "i" = 3': 1 / 3,
        'ColumnValues "d" < 2.5': 1 / 3,
        'ColumnValues "m" <= 2.5': 2 / 3,
        'ColumnValues "t" > 0': 2 / 3,
        'ColumnValues "t" = "x"': 2 / 3,
        'ColumnValues "t" in ["x","y"]': 2 / 3,
        'ColumnValues "t" matches "^[0-9]"': 2 / 3,
        'ColumnLength "t" between 0 and 2': 1 / 3,
        'ColumnValues "day" >= "2024-01-02"': 2 / 3,
        'ColumnValues "day" < "2024-01-02"': 1 / 3,
    }
    found = {r.rule_text: r.metric for r in evaluate(df, list(rules)).collect()}
    assert found == {text: pytest.approx(share) for text, share in rules.items()}


def test_awkward_column_names(spark):
    df = spark.createDataFrame([(1, 2)], ["a.b", 'c "d"'])
    rows = evaluate(df, ['HasMin "a.b" = 1', 'IsUnique "c ""d"""', 'IsComplete "a.b"']).collect()
    assert [r.result for r in rows] == ["PASS"] * 3


def test_by_partition_equals_each_part(spark, golden):
    days = golden.withColumn("day", F.when(F.col("b") < 3, "mon").otherwise("tue"))
    rules = list(EVERY)
    parts = evaluate(days, rules, by=["day"])
    for day in ("mon", "tue"):
        want = outcome(evaluate(days.where(F.col("day") == day).drop("day"), rules))
        got = outcome(parts.where(F.col("day") == day))
        differing = {k for k in want if want[k] != got[k]} - {("rules", rules.index("ColumnCount = 3"))}
        assert not differing


def test_queries_over_whole_data_sets_are_refused_per_partition(golden):
    rules = ['CustomSql "SELECT 1" = 1', 'HasHistogramValues "a" = 1', "HasSize > 0"]
    rows = evaluate(golden, rules, by=["b"]).collect()
    assert sorted(r.result for r in rows) == ["ERROR"] + ["PASS"] * 6


def test_rulesets_share_passes(spark, golden, tmp_path):
    """Rules of all rulesets cost one plain aggregate and one grouped count per key set."""
    rulesets = {
        f"r{i}": ["HasSize > 0", 'IsComplete "c"', 'IsUnique "a"', 'HasMin "b" > 0'] for i in range(5)
    }
    golden.write.parquet(str(tmp_path / "g"))
    stored = spark.read.parquet(str(tmp_path / "g"))
    results = evaluate_many(stored, rulesets)
    plan = results._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2
    assert len(outcome(results)) == 20


def test_tally_names_empty_rulesets(spark, golden):
    results = evaluate_many(golden, {"full": "HasSize = 3"})
    names = spark.createDataFrame([("full",), ("empty",)], "ruleset_name string")
    found = {r.ruleset_name: (r.rules, r.score) for r in S.tally(results, names=names).collect()}
    assert found == {"full": (1, 1.0), "empty": (0, None)}


def test_score_ignores_skipped_and_broken_rules(golden):
    results = evaluate(golden, ["HasColour = 1", 'IsComplete "gone"', "HasSize = 3"])
    assert S.score(results).first().score == 1.0
    nothing = evaluate(golden, ["HasColour = 1"])
    assert S.score(nothing).first().score is None


def test_no_rules(golden):
    assert evaluate(golden, []).collect() == []


def test_rules_that_do_not_fit_leave_the_others_alone(spark):
    df = spark.createDataFrame([(1, [1], {"a": 1})], "n int, l array<int>, m map<string,int>")
    texts = ['HasMin "n" = 1', 'IsLessThan "n" "l"', 'IsUnique "m"', 'IsUnique "l"', 'IsComplete "m"']
    found = [r.result for r in sorted(evaluate(df, texts).collect(), key=lambda r: r.rule_no)]
    assert found == ["PASS", "ERROR", "PASS", "PASS", "PASS"]


def test_long_texts_group_like_short_ones(spark):
    long = ["x" * n + tail for n in (63, 64, 65, 5000) for tail in ("", "a", "b")]
    rows = [(t,) for t in (*long, *long[:5], "", None, "sha:" + "0" * 60)]
    df = spark.createDataFrame(rows, "t string")
    found = outcome(evaluate(df, ['HasUniqueness "t" > 0', 'HasNumberOfDistinctValues "t" > 0']))
    values = [r[0] for r in rows if r[0] is not None]
    assert found[("rules", 1)][0] == len(set(values))
    single = sum(values.count(v) == 1 for v in set(values))
    assert found[("rules", 0)][0] == pytest.approx(single / len(values))


def test_freshness_in_every_time_type_and_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql(
            """SELECT TIMESTAMP '2024-01-30T01:00:00Z' AS zoned, TIMESTAMP_NTZ '2024-01-30 01:00:00' AS plain,
            DATE '2024-01-30' AS day"""
        )
        as_of = datetime(2024, 1, 31)
        for hours, fresh in ((23, "PASS"), (22, "FAIL")):
            rules = [f'DataFreshness "{c}" <= {hours} hours' for c in ("zoned", "plain")]
            for moment in (as_of, as_of.replace(tzinfo=timezone.utc)):
                found = {r.result for r in evaluate(df, rules, as_of=moment).collect()}
                assert found == {fresh}
        days = ['DataFreshness "day" <= 1 day', 'DataFreshness "day" <= 0 days']
        found = {r.rule_no: r.result for r in evaluate(df, days, as_of=as_of).collect()}
        assert found == {0: "PASS", 1: "FAIL"}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_hot_key_counts_are_whole(spark):
    """A third of the rows under one key, spread over many tasks."""
    df = spark.range(0, 90000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
        (F.col("id") % 5).alias("v"),
    )
    found = outcome(evaluate(df, ['IsUnique "k"', 'HasNumberOfDistinctValues "k" > 0', 'HasEntropy "k" > 0']))
    assert found[("rules", 0)][0] == pytest.approx(2 / 3)
    assert found[("rules", 1)][0] == 60001
