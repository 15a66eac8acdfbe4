"""The pipeline: its stages in order, each against its brute-force counterpart on a small corpus."""

from __future__ import annotations

import random

import corpus_pipeline
import pytest
from plumbline.llm import decontamination, packing
from tests.llm.test_packing import check
from tests.llm.test_texts import brute_components, brute_fingerprint, brute_hits, brute_lines, brute_measures

VOCABULARY = [f"word{i}" for i in range(900)]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rnd = random.Random(11)
    text = lambda n: " ".join(rnd.choice(VOCABULARY) for _ in range(n))
    items = [(i, text(30)) for i in range(3)]
    shared = text(40)
    docs = [text(rnd.randint(30, 400)) for _ in range(20)]
    docs += [docs[0], docs[1] + "\n" + shared, docs[2] + " extra", shared + "\n" + text(60)]
    docs += [text(60) + " " + items[0][1] + " " + text(30), items[1][1], "short", "", None, "same " * 60, "a# b* c$ d% " * 20]
    rows = [(i, t, "en", "src", None if t is None else len(t)) for i, t in enumerate(docs)]
    rows += [(None, text(50), None, None, None), (5, docs[5], "en", "src", len(docs[5]))]
    folder = str(tmp_path_factory.mktemp("tables"))
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    frame.repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, items


def texts(df):
    return sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["text"]) for r in df.collect())


def test_stages(spark, corpus):
    folder, items = corpus
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "simhash_near_dedup", "decontamination", "packing"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    now = texts(docs.where("text IS NOT NULL"))
    stages = dict(corpus_pipeline.STAGES)

    kept = stages["quality_rules"](spark, docs, folder)
    good = []
    for key, text in now:
        n, chars, symbols, lines, repeats = brute_measures(text)
        if n >= 10 and 100 * repeats <= 20 * n and 4 * symbols <= n and 2 * n <= chars <= 20 * n and 10 * lines <= n:
            good.append((key, text))
    assert texts(kept) == good and kept.columns == docs.columns

    without = stages["line_dedup"](spark, kept, folder)
    # rows equal in id and text are one document
    want = brute_lines(sorted(set(good)), 10)
    left = sorted((k, want[k]) for k, _ in good if want[k] is not None)
    assert texts(without) == left and without.columns == docs.columns

    single = stages["simhash_near_dedup"](spark, without, folder)
    prints = {k: brute_fingerprint(t) for k, t in left if k >= 0}
    groups = brute_components(prints)
    stay = sorted({(k, t) for k, t in left if k < 0 or groups[k] == k})
    assert texts(single) == stay and single.columns == docs.columns

    clean = stages["decontamination"](spark, single, folder)
    for key, text in texts(clean):
        assert brute_hits(text, items)[1] == 0
    before = dict(stay)
    assert all(before[k] == t for k, t in texts(clean) if brute_hits(before[k], items)[1] == 0)
    gone = {k for k, _ in stay} - {k for k, _ in texts(clean)}
    assert all(brute_hits(before[k], items)[1] > 0.5 * len(decontamination.words_of(before[k])) for k in gone)

    pieces = stages["packing"](spark, clean, folder)
    rows = [r.asDict() | {"doc_id": -1 if r["doc_id"] is None else r["doc_id"]} for r in pieces.collect()]
    check(rows, dict(texts(clean)), 4096)
    assert packing.padding([4096, 1024]) == 0

    whole = corpus_pipeline.run(spark, folder)
    assert sum(r["length"] for r in whole.collect()) == sum(r["length"] for r in rows)


def test_empty_tables(spark, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert corpus_pipeline.run(spark, folder).collect() == []
