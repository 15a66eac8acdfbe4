"""Numbers whose products leave 64 bits: order keys as large as in sixty copies of the tables."""

from __future__ import annotations

import pytest

from plumbline.gallery import QUERIES


@pytest.fixture
def big_keys(spark, tmp_path):
    keys = [1, 8_388_608, 36_000_000]  # 2**23 and beyond: times 2**40 leaves a long
    spark.createDataFrame([(k,) for k in keys], "o_orderkey bigint").write.parquet(str(tmp_path / "orders.parquet"))
    return str(tmp_path), keys


def test_sum_beyond_64_bits(spark, big_keys):
    d, keys = big_keys
    rows = {r["rule_no"] if "rule_no" in r else i: r for i, r in enumerate(QUERIES["c13_sum_beyond_64_bits"](spark, d).collect())}
    metrics = sorted(float(r["metric"]) for r in rows.values())
    assert metrics == [3.0, float(sum(keys) << 40)]


def test_profile_numbers_beyond_64_bits(spark, big_keys):
    d, keys = big_keys
    (row,) = QUERIES["p05_numbers_beyond_64_bits"](spark, d).collect()
    assert row["sum"] == float(sum(keys) << 40)
    assert row["minimum"] == float(min(keys) << 40)
