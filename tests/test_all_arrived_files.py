from __future__ import annotations

import glob

from plumbline.gallery import QUERIES
from plumbline.gallery import rulesets as R


def test_no_arriving_file_grows_with_the_table(spark, tmp_path, monkeypatch):
    """Rows of one l_linenumber % 3 spread over files of a bounded size; the rules judge all of them."""
    rows = [(k, n, k % 7, (k + n) % 11, float(n), 10.0 * n + k, 0.05, "AN"[k % 2]) for k in range(1, 41) for n in range(1, 8)]
    schema = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_tax double, l_returnflag string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/lineitem.parquet")
    whole = sorted(QUERIES["r11_all_arrived"](spark, str(tmp_path)).collect())
    given = []
    monkeypatch.setattr(R, "scratch_path", lambda s, name: given.append(f"{tmp_path}/{name}-{len(given)}") or given[-1])
    monkeypatch.setattr(R, "_ROWS_PER_FILE", 30)
    assert sorted(QUERIES["r11_all_arrived"](spark, str(tmp_path)).collect()) == whole
    sizes = [spark.read.parquet(f).count() for f in glob.glob(f"{given[-1]}/in/*.parquet")]
    assert sum(sizes) == len(rows) and max(sizes) <= 2 * 30  # hashed: about 30 each, before 120 in one
