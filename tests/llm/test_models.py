"""Language, toxicity and secrets: held-out accuracy and odd rows."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import language, secrets, toxicity
from plumbline.llm.common import fold

SOUNDS = {"aa": "the ing and tion er st".split(), "bb": "que les oui eau ment ré".split(), "cc": "der und sch ung ein ß".split()}
ODD = [None, "", " \n\t", "1234 !!", "x", "È", "a" * 5000]


def prose(rnd, lang, n):
    return " ".join("".join(rnd.choice(SOUNDS[lang]) for _ in range(rnd.randint(1, 3))) for _ in range(n))


def corpus(n=240, seed=1):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rnd.choice(list(SOUNDS))
        rows.append((i, prose(rnd, lang, rnd.randint(5, 120)), lang))
    return rows


def test_fold_is_crc32_of_the_text(spark):
    rows = spark.range(50).select("id", fold(F.col("id"), 3).alias("f")).collect()
    assert all(r["f"] == zlib.crc32(str(r["id"]).encode()) % 3 for r in rows)


def test_language_held_out(spark):
    rows = corpus()
    odd = [(1000 + i, t, "aa") for i, t in enumerate(ODD)] + [(None, "the and ing", "aa"), (2000, "und sch", None)]
    frame = spark.createDataFrame([(*r, "s", 0.5) for r in rows + odd], "doc_id long, text string, lang string, bits string, score double")
    held = fold(F.col("doc_id"), 3) == 1
    found = {r["doc_id"]: r for r in language.identify(frame, ~held).collect()}
    assert len(found) == len(rows + odd)
    out = [(found[i]["lang_pred"], lang) for i, _, lang in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum(a == b for a, b in out) >= 0.95 * len(out)
    for i, t in enumerate(ODD):
        row = found[1000 + i]
        assert 0 <= row["score"] <= 1
        assert (row["lang_pred"] == "und") == (not t or not any(c.isalpha() for c in t))


def test_language_without_labels(spark):
    frame = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert language.identify(frame, F.lit(True)).collect()[0]["lang_pred"] == "und"
    assert language.identify(frame.limit(0), F.lit(True)).collect() == []


def test_kernel_is_that_of_present_ngrams():
    a, b = "abab", "abc"
    bits = np.stack([language.presence(a), language.presence(b)])
    x = language.scaled(bits)
    sets = lambda t, n: {t[i : i + n] for i in range(len(t) - n + 1)}
    want = np.mean([len(sets(a, n) & sets(b, n)) / np.sqrt(len(sets(a, n)) * len(sets(b, n))) for n in (1, 2, 3)])
    assert float(x[0] @ x[1]) == pytest.approx(want, abs=1e-6)


def test_presence_in_blocks(monkeypatch):
    text = prose(random.Random(2), "bb", 300)
    whole = language.presence(text)
    monkeypatch.setattr(language, "BLOCK", 50)
    assert (language.presence(text) == whole).all()


def toxic_corpus(n=900, seed=3):
    rnd = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        lang = rnd.choice(list(SOUNDS))
        words = prose(rnd, lang, rnd.randint(10, 150)).split()
        toxic = rnd.random() < 0.3
        if toxic:
            for _ in range(3):
                words.insert(rnd.randrange(len(words) + 1), rnd.choice(["scum", "IDIOT!", "vile" + rnd.choice(["s", "ly", "ness", "st"])]))
        docs.append((i, " ".join(words), lang))
        labels.append((i, int(toxic)))
    return docs, labels


def test_toxicity_held_out(spark):
    docs, labels = toxic_corpus()
    odd = [(5000 + i, t, None) for i, t in enumerate(ODD)]
    frame = spark.createDataFrame([(*d, 9) for d in docs + odd], "doc_id long, text string, lang string, toxic int")
    marks = spark.createDataFrame(labels + [(None, 1), (5001, None)], "doc_id long, toxic int")
    known = marks.where(toxicity.learnable(F.col("doc_id"), fold(F.col("doc_id"), 5)))
    found = {r["doc_id"]: r["score"] for r in toxicity.score(frame, known).collect()}
    assert len(found) == len(docs + odd) and all(0 <= s <= 1 for s in found.values())
    out = [(found[i] >= 0.5, t) for i, t in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(a == bool(b) for a, b in out) >= 0.95 * len(out)


def test_toxicity_without_both_labels(spark):
    frame = spark.createDataFrame([(1, "a b", "x")], "doc_id long, text string, lang string")
    marks = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    assert toxicity.score(frame, marks).collect()[0]["score"] == 0
    assert toxicity.score(frame, marks.limit(0)).collect()[0]["score"] == 0
    assert toxicity.score(frame.limit(0), marks).collect() == []


def test_tables_give_what_filters_give(monkeypatch):
    net, ids = toxicity.Network(), toxicity.Ids()
    for text in ("", "one", "one two", "one two three four " * 30):
        own = ids.of(text)
        assert net.logit(own) == pytest.approx(net.logit(own, net.tables()), abs=1e-4)
    own = ids.of("one two three four five " * 40)
    whole = net.logit(own)
    monkeypatch.setattr(toxicity, "BLOCK", 7)
    assert net.logit(own) == pytest.approx(whole, abs=1e-5)


def test_cut_is_the_least_error():
    x = np.array([0.1, 0.2, 0.3, 0.9, 1.0])
    y = np.array([0, 0, 1, 1, 1])
    assert 0.2 < toxicity.cut(x, y, np.ones(5)) < 0.3


def test_candidates(spark):
    key = "AKIA" + "ABCDEFGH23456789"
    hex40 = "0123456789abcdef0123456789abcdef01234567"
    rows = [
        (1, f'x {key} y token = "{hex40}" end', "src"),
        (2, "number 4111111111111111 and plain words of great length incomprehensibilities", "src"),
        (3, None, None),
        (4, "", "src"),
        (5, f"password={hex40[:18]}.", "a/test/b"),
        (None, f"again {key}", "src"),
    ]
    frame = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, source string, length int")
    found = secrets.candidates(frame).collect()
    got = sorted((r["doc_id"] or 0, r["nth"], r["candidate"], r["settled"]) for r in found)
    assert got == [
        (0, 0, key, 1), (1, 0, key, 1), (1, 1, hex40, 1), (2, 0, "4111111111111111", 0), (2, 1, "incomprehensibilities", 0),
        (5, 0, hex40[:18], None),
    ]
    assert {r["doc_id"] for r in found if r["example_path"]} == {5}
    assert all(r["assigned"] == (r["candidate"] in (hex40, hex40[:18])) for r in found)
    assert not {"assigned", "quoted"} & set(secrets.FEATURES)


@pytest.mark.parametrize(
    "text, value",
    [
        ('x password="Tr0ub4dor&3" y', "Tr0ub4dor&3"),
        ("pwd=hunter2", "hunter2"),
        ('secret = "abcdefghijklmnopqrstuvwxyzabcdef" z', "abcdefghijklmnopqrstuvwxyzabcdef"),
        ("token=eyJhbGciOiJI.eyJzdWIiOiIx.SflKxwRJSMeKK.", "eyJhbGciOiJI.eyJzdWIiOiIx.SflKxwRJSMeKK"),
        ("Authorization: Bearer abc.def", "abc.def"),
        ("passphrase: \"correct horse battery\"", "correct horse battery"),
        ("DB_PASSWORD=x", "x"),
        ("the token was lost, as secrets are", None),
    ],
)
def test_any_value_of_a_credential_word_is_a_candidate(spark, text, value):
    frame = spark.createDataFrame([(1, text, "src")], "doc_id long, text string, source string")
    assert [r["candidate"] for r in secrets.candidates(frame).collect()] == ([] if value is None else [value])


def made_findings(spark, seed, n):
    """Texts with secrets of many shapes and with values that are none, and what is what."""
    rnd, rows, truth = random.Random(seed), [], {}
    chars = "abcdefghijkmnpqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ23456789"
    word = lambda: rnd.choice(secrets.WORDS)
    for i in range(n):
        name, kind = rnd.choice(["password", "pwd", "secret", "token", "api_key"]), rnd.randrange(6)
        if kind < 2:
            value, yes = "".join(rnd.choices(chars + "&!%", k=rnd.randint(8, 14))) + rnd.choice("0123456789"), True
        elif kind == 2:
            value, yes = "".join(rnd.choices("0123456789abcdef", k=40)), True
        elif kind == 3:
            value, yes = "_".join(word() for _ in range(rnd.randint(1, 3))), False
        elif kind == 4:
            value, yes = rnd.choice(["required", "optional", "must", "null", "none", "string"]), False
        else:
            value, yes = f"{word()}.{word()}({word()}", False
        rows.append((i, f"some {word()} {name} = {value} and {word()}", f"src/{word()}/{i}"))
        truth[i] = yes
    return spark.createDataFrame(rows, "doc_id long, text string, source string"), truth


def test_precision_and_recall_held_out(spark):
    """Trained on labelled findings, judged on others: the measures tell secrets from other values."""
    learned, truth = made_findings(spark, 1, 600)
    labels = spark.createDataFrame(list(truth.items()), "doc_id long, yes boolean")
    findings = secrets.candidates(learned).join(labels, "doc_id").select(
        F.col("yes").cast("double").alias("label"), *secrets.FEATURES
    )
    other, known = made_findings(spark, 2, 400)
    missed = spark.createDataFrame(
        [(1000, 'password="Tr0ub4dor&3"', "s"), (1001, "token=eyJhbGciOiJI.eyJzdWIiOiIx.SflKxwRJSMeKK", "s")],
        "doc_id long, text string, source string",
    )
    found = secrets.scan(other.unionByName(missed), findings=findings).collect()
    assert {r.doc_id for r in found if r.secret} >= {1000, 1001}
    hits = [(r.secret, known[r.doc_id]) for r in found if r.doc_id < 1000]
    right = sum(a and b for a, b in hits)
    assert right / sum(a for a, _ in hits) > 0.95 and right / sum(known.values()) > 0.95


def test_nothing_but_measures_is_written(spark, monkeypatch):
    written, seen = secrets.written, []
    monkeypatch.setattr(secrets, "written", lambda df, name: (seen.append(df), written(df, name))[1])
    frame = spark.createDataFrame([(1, 'password="Tr0ub4dor&3"', "s")], "doc_id long, text string, source string")
    secrets.scan(frame).collect()
    assert seen and all("candidate" not in df.columns for df in seen)


def test_scan_removes_false_positives(spark):
    rnd = random.Random(5)
    rows = []
    for i in range(200):
        digits = "".join(rnd.choice("0123456789abcdef") for _ in range(40))
        rows.append((i, f'words here token = "{digits}" more' if i % 2 else f"module utils2/config/index/parser{i:05d}/test_example here", "src"))
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = secrets.scan(frame).collect()
    assert len(found) == 200 and all(r["secret"] == (r["doc_id"] % 2 == 1) for r in found)
    assert secrets.scan(frame.limit(0)).collect() == []
    alone = secrets.scan(frame.where("doc_id = 1")).collect()
    assert [r["score"] for r in alone] == [1.0]


def test_every_credential_word_has_a_stem():
    words = "password passwd passphrase pwd secret token api_key apikey access-key accesskey credential credentials auth authorization bearer"
    for word in words.split():
        assert any(stem in word for stem in secrets.STEMS)
