"""What arrives is taken in by the same number of micro-batches, and over all cores, at any size."""

from __future__ import annotations

import pytest

from plumbline import evaluate
from plumbline.gallery import QUERIES, rulesets as R
from plumbline.operators import grouped as G, keyed as K
from plumbline.streaming.accumulated import evaluate_so_far
from tests.test_accumulated import ROWS, RULES, SCHEMA, results, same


def test_three_micro_batches_however_many_files(spark, tmp_path, monkeypatch):
    rows = [(k, n, k % 7, (k + n) % 11, float(n), 10.0 * n + k, 0.05, "AN"[k % 2]) for k in range(1, 41) for n in range(1, 8)]
    schema = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_tax double, l_returnflag string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(R, "scratch_path", lambda s, name: f"{tmp_path}/{name}")
    monkeypatch.setattr(R, "_ROWS_PER_FILE", 30)
    got = {r.rule_no: r.metric for r in QUERIES["r11_all_arrived"](spark, str(tmp_path)).collect()}
    assert got[5] == 280 and got[1] == 1.0 and got[2] == round(7 / 280, 6)
    out = spark.read.parquet(f"{tmp_path}/so-far/out")
    assert sorted(r.batch_id for r in out.select("batch_id").distinct().collect()) == [0, 1, 2]


@pytest.mark.parametrize("sent", [0, 100_000])
def test_sent_or_summed_by_key(spark, tmp_path, monkeypatch, sent):
    """Earlier sizes of a batch's keys, by sending few groups and by one exchange of both sides."""
    monkeypatch.setattr(K, "SENT", sent, raising=False)
    monkeypatch.setattr(K, "ROWS_PER_TASK", 2, raising=False)
    for n, part in enumerate((ROWS[:4], ROWS[4:7], ROWS[7:])):
        got = evaluate_so_far(spark.createDataFrame(part, SCHEMA), RULES, str(tmp_path), n)
    same(results(got), results(evaluate(spark.createDataFrame(ROWS, SCHEMA), RULES)))


def test_a_batch_of_one_partition_is_counted_by_many_tasks(spark, monkeypatch):
    """One file is one task's to read; the rows under all key sets are not that task's alone."""
    given = []
    counted = K.tagged_sizes
    monkeypatch.setattr(K, "tagged_sizes", lambda df, *a: given.append(df) or counted(df, *a))
    df = spark.range(0, 1000, 1, 1).selectExpr("id % 7 AS a", "id AS b")
    metrics = [G.grouped("uniqueness", s, [df.schema[c].dataType for c in s]) for s in (("a",), ("a", "b"))]
    assert K.batch_sizes(df, metrics).count() == 7 + 1000
    assert given[0].rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism > 1
