"""op3's model learns from every labelled row, also from texts longer than 128 KB."""

from __future__ import annotations

from plumbline.llm import toxicity


def test_learns_from_long_texts(spark):
    clean = "the river runs past the old mill and the garden gate "
    vile = "scum vermin filth hateful idiot "
    long_toxic = [(i, vile * 4500, "en") for i in range(30)]  # about 140,000 bytes each
    short_clean = [(100 + i, clean * (1 + i % 3), "en") for i in range(30)]
    tried = [(500, vile * 3, "en"), (501, clean * 2, "en")]
    docs = spark.createDataFrame(long_toxic + short_clean + tried, "doc_id long, text string, lang string")
    assert min(len(t.encode()) for _, t, _ in long_toxic) > 1 << 17
    marks = spark.createDataFrame([(i, 1) for i in range(30)] + [(100 + i, 0) for i in range(30)], "doc_id long, toxic int")
    found = {r["doc_id"]: r["score"] for r in toxicity.score(docs, marks).collect()}
    assert found[500] >= 0.5 > found[501]
