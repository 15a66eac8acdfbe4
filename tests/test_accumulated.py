"""Rules over all batches from kept states, against the same rules over all rows at once."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from plumbline import evaluate
from plumbline.operators.keyed import KeyedState
from plumbline.streaming.accumulated import evaluate_so_far
from plumbline.streaming.arriving import evaluate_arriving

ROWS = [
    (1, "a", 1.0, "x"), (1, "b", 2.0, None), (2, None, None, "y"), (None, None, 4.0, None), (3, "c", 8.0, "z"),
    (3, "c", -1.0, "long " * 40), (4, "d", 0.5, "long " * 40), (2, "b", 7.0, "x"), (5, "", 3.0, None), (None, "q", 1.0, "x"),
]
SCHEMA = "k long, s string, v double, t string"
RULES = [
    "HasSize > 0", 'HasMean "v" > 0', 'HasSum "v" > 0', 'HasMin "v" > 0', 'HasMax "v" > 0', 'HasStandardDeviation "v" > 0',
    'HasCorrelation "k" "v" > 0', 'IsComplete "s"', 'HasCompleteness "t" > 0.5', 'HasMaxLength "t" > 3', 'HasPattern "t" matches "x"',
    'IsUnique "k"', 'IsUnique "s"', 'HasUniqueness "k" "s" > 0', 'HasDistinctness "t" > 0', 'HasUniqueValueRatio "s" > 0',
    'HasNumberOfDistinctValues "t" > 0', 'IsPrimaryKey "k"', 'IsPrimaryKey "k" "v"', 'HasEntropy "t" > 0', 'IsUnique "v"',
]


def results(df):
    return {r.rule_no: (r.rule_text, r.metric, r.result, r.message) for r in df.collect()}


def same(got, want):
    assert got.keys() == want.keys()
    for n, (text, metric, result, _) in want.items():
        assert got[n][0] == text and got[n][2] == result, (got[n], want[n])
        assert got[n][1] == metric or math.isclose(got[n][1], metric, rel_tol=1e-9, abs_tol=1e-12), (got[n], want[n])


@pytest.mark.parametrize("cut, compact_every", [(1, 0), (4, 2)])
def test_batches_add_up_to_the_whole(spark, tmp_path, cut, compact_every):
    batches = [ROWS[i : i + cut] for i in range(0, len(ROWS), cut)]
    if cut == 1:
        batches = batches[:3]
    for n, batch in enumerate(batches):
        df = spark.createDataFrame(batch, SCHEMA)
        got = results(evaluate_so_far(df, RULES, str(tmp_path / "s"), n, compact_every=compact_every))
    rows = [r for b in batches for r in b]
    same(got, results(evaluate(spark.createDataFrame(rows, SCHEMA), RULES)))


def test_a_batch_given_again_counts_once(spark, tmp_path):
    for n, batch in enumerate([ROWS[:4], ROWS[4:], ROWS[4:]]):
        df = spark.createDataFrame(batch, SCHEMA)
        got = results(evaluate_so_far(df, RULES, str(tmp_path), min(n, 1), compact_every=2))
    same(got, results(evaluate(spark.createDataFrame(ROWS, SCHEMA), RULES)))


def test_rules_that_need_all_rows_and_new_rules(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA)
    rules = ['HasMutualInformation "k" "s" > 0', 'DataFreshness "k" <= 3 days', "HasColour = 1", "HasSize = 10"]
    got = results(evaluate_so_far(df, rules, str(tmp_path), 0))
    assert [got[i][2] for i in range(4)] == ["ERROR", "ERROR", "SKIP", "PASS"]
    assert got[0][3] == "is not kept over batches"
    got = results(evaluate_so_far(df, ['IsUnique "t"', "HasSize = 20"], str(tmp_path), 1))
    assert got[1][2] == "PASS" and got[0][1] == 2 / 7


def test_parts_are_judged_on_their_own(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA).withColumn("p", F.coalesce("k", F.lit(0)) % 2)
    rules = ["HasSize > 0", 'HasMean "v" > 0', 'HasStandardDeviation "v" > 0', 'IsUnique "t"']
    for n, part in enumerate((df.where("v < 3"), df.where("v >= 3 OR v IS NULL"))):
        got = evaluate_so_far(part, rules, str(tmp_path), n, by=["p"])
    key = lambda r: (r.p, r.rule_no)
    want = evaluate(df, rules, by=["p"])
    for a, b in zip(sorted(got.collect(), key=key), sorted(want.collect(), key=key), strict=True):
        assert (a.p, a.rule_no, a.result) == (b.p, b.rule_no, b.result) and math.isclose(a.metric, b.metric)


def test_three_files_sharing_a_key_also_after_a_restart(spark, tmp_path):
    base = str(tmp_path)

    def arrive(rows):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{base}/in")
        evaluate_arriving(
            spark, f"{base}/in", spark.createDataFrame([], SCHEMA).schema, RULES, f"{base}/out", f"{base}/check",
            state_path=f"{base}/state", max_files=1,
        ).awaitTermination()

    spark.createDataFrame(ROWS[:3], SCHEMA).coalesce(1).write.parquet(f"{base}/in")
    arrive(ROWS[3:6])  # two files, two batches
    arrive(ROWS[6:])  # another query on the same checkpoint
    out = spark.read.parquet(f"{base}/out")
    assert sorted(r.batch_id for r in out.select("batch_id").distinct().collect()) == [0, 1, 2]
    same(results(out.where("batch_id = 2")), results(evaluate(spark.createDataFrame(ROWS, SCHEMA), RULES)))


def test_no_old_file_is_read(spark, tmp_path):
    for n, batch in enumerate((ROWS[:5], ROWS[5:])):
        spark.createDataFrame(batch, SCHEMA).write.parquet(f"{tmp_path}/data/{n}")
        got = evaluate_so_far(spark.read.parquet(f"{tmp_path}/data/{n}"), RULES, f"{tmp_path}/state", n)
    places = got.inputFiles()
    assert places and all("/state/" in p for p in places)
    state = KeyedState(spark, f"{tmp_path}/state/keys")
    assert state.sizes(0) is None
