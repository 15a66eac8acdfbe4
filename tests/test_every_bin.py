"""p07_histograms bins every column, also those of more than 120 values."""

from __future__ import annotations

from plumbline.gallery import QUERIES


def test_histograms_of_many_values(spark, tmp_path):
    rows = [(i, i % 3) for i in range(300)]
    spark.createDataFrame(rows, "l_orderkey bigint, l_linenumber int").write.parquet(str(tmp_path / "lineitem.parquet"))
    found = QUERIES["p07_histograms"](spark, str(tmp_path)).collect()
    by_column = {}
    for r in found:
        by_column.setdefault(r["column_name"], []).append(r)
    assert len(by_column["l_orderkey"]) == 300
    assert sorted(r["count"] for r in by_column["l_linenumber"]) == [100, 100, 100]
