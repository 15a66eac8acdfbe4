"""g05_fractional_categorical_range counts the values of every text column, however many there are."""

from __future__ import annotations

from plumbline.gallery import QUERIES


def test_top_values_of_text_with_many_values(spark, tmp_path):
    # 150 texts of 3 rows each and 50 of 1 row: more than 120 values; the first 150 cover 0.9 of the rows
    rows = [(i, f"t{i:03d}", "en", "web", 5) for i in range(150) for _ in range(3)]
    rows += [(1000 + i, f"u{i:03d}", "en", "web", 5) for i in range(50)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars int").write.parquet(
        str(tmp_path / "documents.parquet")
    )
    found = QUERIES["g05_fractional_categorical_range"](spark, str(tmp_path)).collect()
    text = [r for r in found if r["column_name"] == "text"]
    assert len(text) == 150
    assert {r["count"] for r in text} == {3}
    assert text[0]["dqdl_rule"].startswith('ReferentialIntegrity "text" "top values of text.value" >= ')
