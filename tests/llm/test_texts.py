"""SimHash, decontamination, quality rules, lines and HTML against brute force on small fixtures."""

from __future__ import annotations

import hashlib
import itertools
import random
import re

import duckdb
import pytest
import xxhash

from plumbline.llm import decontamination, html_text, lines, quality, simhash
from plumbline.llm.components import roots
from plumbline.llm.queries import ORACLES, QUERIES

WEIRD = ["", None, " \t\n", "one", "one two", "A b C", "ünï cödé wörds hére", "x " * 3000, "\x1c odd \x1c"]


def prose(rnd, n, words="the of and inner outer plain text river stone cloud".split()):
    return " ".join(rnd.choice(words) for _ in range(n))


# SimHash ---------------------------------------------------------------------------------------


def brute_fingerprint(text):
    raw = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    words = re.findall(rb"[^\x20\x09-\x0D]+", raw)
    runs = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [b" ".join(words)]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(r, seed=42) for r in runs]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """Smallest reachable id by id, links at two bits."""
    up = {k: k for k in prints}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in itertools.combinations(sorted(prints), 2):
        if (prints[a] ^ prints[b]).bit_count() <= 2:
            x, y = sorted((top(a), top(b)))
            up[y] = x
    return {k: top(k) for k in prints}


def test_near_duplicates(spark):
    rnd = random.Random(1)
    base = [prose(rnd, 300, [f"w{i}" for i in range(400)]) for _ in range(12)]
    texts = WEIRD[:]
    for text in base:
        texts.append(text)
        for _ in range(6):
            words = text.split()
            for _ in range(rnd.randint(0, 2)):
                words[rnd.randrange(len(words))] = "changed"
            texts.append(" ".join(words))
    rnd.shuffle(texts)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r for r in simhash.near_duplicates(frame).collect()}
    prints = {i: brute_fingerprint(t) for i, t in enumerate(texts)}
    assert {k: r["fingerprint"] for k, r in found.items()} == {k: f"{v:016x}" for k, v in prints.items()}
    assert {k: r["component_id"] for k, r in found.items()} == brute_components(prints)


@pytest.mark.parametrize("tree", [2_000, 64])
def test_links_connect_all_within_two_bits(spark, tree):
    rnd = random.Random(2)
    values = {rnd.getrandbits(64) for _ in range(60)}
    for v in list(values)[:30]:
        for _ in range(5):
            values.add(v ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)))
    root = rnd.getrandbits(64)
    values |= {root ^ (i << 3) for i in range(200)}
    frame = spark.createDataFrame([(simhash.signed(v),) for v in values], "fp long")
    found = roots(simhash.links(frame, tree=tree)).collect()
    group = {simhash.signed(v): simhash.signed(v) for v in values} | {r["node"]: r["root"] for r in found}
    prints = {simhash.signed(v): v for v in values}
    assert group == brute_components(prints)


def test_tree_finds_what_pairs_find():
    rnd = random.Random(3)
    values = [rnd.getrandbits(64) & 0xFFFF for _ in range(300)]
    values = list(dict.fromkeys(values))
    tree = simhash.BKTree()
    for i, v in enumerate(values):
        assert sorted(tree.link(v)) == [j for j in range(i) if (values[j] ^ v).bit_count() <= 2]


def test_long_text_in_blocks(monkeypatch):
    text = prose(random.Random(4), 1000)
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "BLOCK", 64)
    assert simhash.fingerprint(text) == whole == brute_fingerprint(text)


def test_keep_one(spark):
    rows = [(3, "a b c d", 1), (1, "a b c d", 2), (1, "a b c d", 2), (None, "a b c d", 3), (5, "other words here now", 4), (None, "lone one of its kind", 5)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    kept = simhash.keep_one(frame)
    assert kept.columns == frame.columns
    assert sorted(kept.collect(), key=lambda r: r["fp"]) == [(1, "a b c d", 2), (5, "other words here now", 4), (None, "lone one of its kind", 5)]
    assert simhash.keep_one(frame.limit(0)).collect() == []
    assert simhash.near_duplicates(frame.limit(0)).collect() == []


def test_components_of_a_chain(spark):
    edges = [(i, i + 1) for i in range(100)] + [(200, 201), (7, 7)]
    frame = spark.createDataFrame(edges, "u long, v long").repartition(4)
    found = {r["node"]: r["root"] for r in roots(frame).collect()}
    assert found == {i: 0 for i in range(101)} | {200: 200, 201: 200}


# Decontamination -------------------------------------------------------------------------------


def brute_hits(text, items, window=10):
    words = decontamination.words_of(text)
    hit, found = set(), set()
    for name, item in items:
        own = decontamination.words_of(item)
        size = min(window, len(own))
        grams = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if size else set()
        for i in range(len(words) - size + 1 if size else 0):
            if tuple(words[i : i + size]) in grams:
                hit |= set(range(i, i + size))
                found.add(str(name))
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize("block", [1_000_000, 15])
def test_decontamination(spark, block):
    rnd = random.Random(5)
    items = [(i, prose(rnd, rnd.choice([1, 3, 9, 10, 11, 30, 60]))) for i in range(12)]
    items += [(50, None), (51, ""), (52, "--- !!"), (53, items[3][1]), (None, "nameless item of the list here and now you see")]
    docs = WEIRD + [prose(rnd, rnd.randint(0, 80)) for _ in range(60)]
    docs += [f"{prose(rnd, 20)} {items[i][1].upper()}! {prose(rnd, 5)}" for i in range(12)]
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").withColumnRenamed("text", "body")
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = decontamination.decontaminate(frame, bench, text="body", block_words=block).collect()
    named = [i for i in items if i[0] is not None]
    for r in rows:
        want = brute_hits(docs[r["doc_id"]], named)
        assert (r["n_words"], r["n_hit"], r["item_ids"]) == want
        assert r["contaminated"] == (want[1] > 0)
        assert sum(s["words"] for s in r["spans"]) == want[1]
        if r["clean_text"] is not None:
            assert brute_hits(r["clean_text"], named)[1] == 0
        if not r["contaminated"]:
            assert r["clean_text"] == docs[r["doc_id"]]


def test_remove_contamination_keeps_the_rest(spark):
    item = " ".join(f"i{i}" for i in range(12))
    rows = [(1, "clean text", "a"), (2, f"before {' '.join(f'w{i}' for i in range(30))} {item} after", "b"), (3, item, "c"), (4, None, "d"), (5, "", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    out = decontamination.remove_contamination(frame, bench)
    assert out.columns == frame.columns
    kept = {r["doc_id"]: r["text"] for r in out.collect()}
    assert set(kept) == {1, 2, 4, 5} and "i5" not in kept[2] and kept[2].endswith("after")
    assert decontamination.remove_contamination(frame, bench.limit(0)).count() == 5
    assert decontamination.remove_contamination(frame.limit(0), bench).count() == 0


def test_items_without_a_key(spark, tmp_path):
    long = [" ".join(f"{x}{i}" for i in range(14)) for x in "abc"]
    items = [(None, long[0]), (None, long[1]), (7, long[2]), (None, "three short words"), (None, "words"), (8, "deep blue sea"), (8, "sea"), (None, None)]
    docs = [f"so {long[0]} on", f"{long[1]} and {long[2]}", long[2], "of words", "three short words", "blue sea", "nothing", None]
    folder = str(tmp_path)
    spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    found = QUERIES["op2_decontamination"](spark, folder)
    tables = duckdb.connect()
    for name in ("documents", "benchmark"):
        tables.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet/*.parquet'")
    assert sorted(map(tuple, found.collect())) == sorted(tables.execute(ORACLES["op2_decontamination"]).fetchall())
    assert [r["n_hit"] for r in found.orderBy("doc_id").collect()] == [14, 28, 14, 1, 3, 1, 0, 0]
    clean = decontamination.remove_contamination(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet"), max_coverage=0.9)
    assert {r["doc_id"]: r["text"] for r in clean.collect()} == {0: "so  on", 3: "of ", 5: "blue ", 6: "nothing", 7: None}


# Quality ---------------------------------------------------------------------------------------


def brute_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    own = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    hit = set()
    for i, g in enumerate(grams):
        if grams.count(g) > 1:
            hit |= set(range(i, i + 5))
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(own) - len(set(own)),
        len(hit),
    )


def test_measures(spark):
    rnd = random.Random(6)
    docs = WEIRD[:-2] + ["x " * 40, "\x1c odd \x1c words"] + [prose(rnd, n, ["a", "b", "ç"]) for n in (4, 5, 6, 7, 30, 90)]
    docs += ["l1 x\nl1 x\n\n \nl2\r\nl2\r\n", "# a * b | <c> $%&", "tab\tand\x0bvt\x0cff", "\\n not a line\\n"]
    docs += ["\n".join(prose(rnd, 3, ["u", "v"]) for _ in range(20))]
    frame = spark.createDataFrame([(i, t, 7) for i, t in enumerate(docs)], "doc_id long, text string, n_words int")
    rows = quality.assess(frame).collect()
    assert len(rows) == len(docs)
    for r in rows:
        want = brute_measures(docs[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r["kept"] and r["base_failed"])


def test_cascade_keeps_what_no_rule_rejects(spark):
    rnd = random.Random(7)
    docs = ["x y", "of " * 50, "a### b*** " * 30, prose(rnd, 60, [f"w{i}" for i in range(300)]), None]
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    assert [r["doc_id"] for r in quality.keep_good(frame).collect()] == [3]
    assert [r["doc_id"] for r in quality.assess(frame).where("kept").collect()] == [3]
    assert quality.keep_good(frame.limit(0)).collect() == []
    found = quality.estimate(frame)
    assert {e["rule"] for e in found} == {r.name for r in quality.RULES}
    assert all(0 <= e["rejects"] <= 1 and e["cost"] > 0 for e in found)


# Lines -----------------------------------------------------------------------------------------


def brute_lines(docs, min_words):
    seen, out = {}, {}
    for key, text in sorted(docs):
        raw = (text or "").split("\n")
        own = [(i, x.strip()) for i, x in enumerate(raw) if x.strip()]
        gone = set()
        for a in range(len(own)):
            total = 0
            for b in range(a, len(own)):
                total += len(own[b][1].split())
                if total >= min_words:
                    run = tuple(x for _, x in own[a : b + 1])
                    if seen.setdefault(run, (key, a)) != (key, a):
                        gone |= set(range(own[a][0], own[b][0] + 1))
                    break
        kept = [x for i, x in enumerate(raw) if i not in gone]
        out[key] = "\n".join(kept) if not gone or any(x.strip() for x in kept) else None
    return out


def test_lines(spark):
    rnd = random.Random(8)
    pool = [prose(rnd, rnd.randint(1, 8)) for _ in range(25)] + ["", "  "]
    docs = list(enumerate(["\n".join(rnd.choice(pool) for _ in range(rnd.randint(0, 14))) for _ in range(80)] + WEIRD))
    frame = spark.createDataFrame([(i, t, "s", 1) for i, t in docs], "doc_id long, text string, doc string, begin int").repartition(4)
    want = brute_lines(docs, 10)
    out = lines.dedupe_lines(frame)
    assert out.columns == frame.columns
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    texts = dict(docs)
    assert got == {k: (None if texts[k] is None else v) for k, v in want.items() if v is not None or texts[k] is None}
    for r in lines.line_report(frame).collect():
        assert r["kept_sha256"] == hashlib.sha256((want[r["doc_id"]] or "").encode()).hexdigest()


def test_every_run_has_its_least_line():
    rnd = random.Random(9)
    text = "\n".join(prose(rnd, rnd.randint(1, 6)) for _ in range(60))
    own = [x.encode() for x in text.split("\n")]
    seen = []
    for low, high, fingerprint, extent, runs in lines.winnowed(text, 10):
        for begin, end, _ in runs or [(low, high, extent)]:
            assert low <= begin < end <= high
            assert fingerprint == min(xxhash.xxh3_64_intdigest(x) for x in own[begin:end])
            seen.append((begin, end))
    assert seen == lines.shortest_runs([len(x.split()) for x in own], 10) and len(seen) > len(lines.winnowed(text, 10))


@pytest.mark.parametrize("seed", range(3))
def test_extents_that_differ_are_compared_run_by_run(spark, seed, monkeypatch):
    """Few different lines, so that the same fingerprints stand in many surroundings, also many times in one text."""
    monkeypatch.setattr(lines, "SENT", 100 * seed)
    rnd = random.Random(seed)
    pool = [prose(rnd, n) for n in (1, 2, 3, 4, 5, 7, 11)]
    docs = [(i, "\n".join(rnd.choices(pool[: rnd.randint(3, 7)], k=rnd.randint(0, 25)))) for i in range(60)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    want = brute_lines_whole(docs, 10)
    assert {r["doc_id"]: r["n_deleted"] for r in lines.line_report(frame).collect()} == {k: len(v) for k, v in want.items()}


def brute_lines_whole(docs, min_words):
    return brute_passages(docs, min_words)


def test_lines_of_an_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert lines.dedupe_lines(frame).collect() == [] and lines.line_report(frame).collect() == []


def brute_passages(docs, min_words):
    """Lines of every run, of any length from min_words words on, that also starts earlier: line numbers by document."""
    seen, out = {}, {}
    for key, text in sorted(docs):
        own = [(i, x.strip()) for i, x in enumerate((text or "").split("\n")) if x.strip()]
        out[key] = set()
        for a in range(len(own)):
            for b in range(a + 1, len(own) + 1):
                run = tuple(x for _, x in own[a:b])
                if sum(len(x.split()) for x in run) >= min_words and seen.setdefault(run, (key, a)) != (key, a):
                    out[key] |= {i for i, _ in own[a:b]}
    return out


def test_lines_to_the_end_of_a_repeated_passage(spark):
    passage = "\n".join(["a line of the twelve words that both documents have in common", "three words more", "two more"])
    docs = [(1, f"{passage}\nhere the first goes on"), (2, f"other start\n{passage}\nthen the second differs"), (3, f"{passage}\nand once more")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in lines.dedupe_lines(frame).collect()}
    assert got == {1: docs[0][1], 2: "other start\nthen the second differs", 3: "and once more"}
    assert {r["doc_id"]: r["n_deleted"] for r in lines.line_report(frame).collect()} == {1: 0, 2: 3, 3: 3}


def test_lines_of_all_repeated_passages(spark):
    rnd = random.Random(10)
    pool = [prose(rnd, rnd.choice([1, 1, 2, 3, 8, 11])) for _ in range(9)] + ["", " "]
    docs = list(enumerate("\n".join(rnd.choice(pool) for _ in range(rnd.randint(0, 20))) for _ in range(60)))
    want = brute_passages(docs, 10)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert {r["doc_id"]: r["n_deleted"] for r in lines.line_report(frame).collect()} == {k: len(v) for k, v in want.items()}
    got = {r["doc_id"]: r["text"] for r in lines.dedupe_lines(frame).collect()}
    for key, text in docs:
        kept = [x for i, x in enumerate(text.split("\n")) if i not in want[key] and x.strip()]
        assert [x for x in (got.get(key) or "").split("\n") if x.strip()] == kept


def test_equal_rows_gather_their_runs_once(spark, monkeypatch):
    text = "\n".join(f"line {i} of the many that the first one has too" for i in range(6))
    frame = spark.createDataFrame([(0, text)] + [(1, text)] * 40 + [(2, "a line\n" + text)], "doc_id long, text string").repartition(4)
    seen, map_batches = [], lines.map_batches
    monkeypatch.setattr(lines, "map_batches", lambda df, make, schema: (seen.append(df), map_batches(df, make, schema))[1])
    assert [tuple(r) for r in lines.dedupe_lines(frame).orderBy("doc_id").collect()] == [(0, text), (2, "a line")]
    gathered = seen[-1]
    assert sorted(r["doc_id"] for r in lines.line_report(frame).where("n_deleted = 6").collect()) == [1] * 40 + [2]
    for df in (gathered, seen[-1]):
        assert max(len(r[-1] or ()) for r in df.collect()) == 6


# HTML ------------------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head>
<body><header><h1>Site</h1></header><nav><ul><li><a href=/a>a</a><li><a href=/b>b</a></ul></nav>
<div class="ad">Buy now, it is cheap and good and long enough to look like text.</div>
<div id="cookie-notice">We use cookies on this long and winding site, please accept.</div>
%s
<aside>Related things to read that are long enough to matter, maybe more so.</aside>
<form><label>Name</label><input name=q><button>Go</button></form>
<div class="comments"><p>First! I think this is a very long reader comment about all of it.</p></div>
<footer>&copy; 2020 example &middot; imprint</footer></body></html>"""
TEXT = ["Title &amp; more", "A first   paragraph\n of <b>some</b> length, with &eacute; and <a href=x>a link</a>.", "To.", "Another one that goes on for a while, as they do."]
CLEAN = ["Title & more", "A first paragraph of some length, with é and a link.", "To.", "Another one that goes on for a while, as they do."]


@pytest.mark.parametrize("around", ["<article><h1>%s</h1><p>%s<p>%s<p><b>%s<br></article>", "<main><h1>%s</h1><p>%s</p><p>%s</p><div>%s</div></main>", "<div><h1>%s</h1><p>%s</p><p>%s</p><p>%s</p></div>"])
def test_page(around):
    assert html_text.main_text(PAGE % (around % tuple(TEXT))) == "\n".join(CLEAN)


@pytest.mark.parametrize("html", [None, "", "<", "<p", "no markup at all", "<div class=ad>x</div>", "<p></p>", "&#xZZ; &#0; &unknown;", "</p></div>", "<![CDATA[ x ]]>", "<!-- open"])
def test_odd_pages(html):
    assert isinstance(html_text.main_text(html), str)
    assert html_text.main_text("no markup at all") == "no markup at all"
    assert html_text.main_text("<div class=ad>x</div>") == ""


LONG = ["<p>%s</p>" % (f"Sentence {i} of the text that this page is about. " * 12).strip() for i in range(10)]
SHORT = "Some more of them".split()


def test_page_without_article():
    words = "".join(f"<p>{w}</p>" for w in SHORT) + "<ul><li>first<li>last</ul>"
    text = html_text.main_text(f"<body><div class=menu><p>a</p></div><div><h1>Head</h1>{''.join(LONG)}{words}</div><div>elsewhere</div>" + "<div><p>x</p></div>" * 9)
    assert [x for x in text.split("\n") if not x.startswith("Sentence")][:7] == ["Head", *SHORT, "first", "last"]
    assert text.count("Sentence 9") == 12 and "\nx" not in text
    # directly in the body: its own lines and lists, not all of the page
    text = html_text.main_text(f"<body>{''.join(LONG)}{words}" + "<div><p>x</p></div>" * 9)
    assert text.split("\n")[10:] == [*SHORT, "first", "last"]


def test_page_of_several_articles():
    cards = "".join(f"<article><h2>Card {i}</h2><p>Read on</p></article>" for i in range(9))
    story = f"<article><h1>Story</h1>{''.join(LONG)}<p>End</p></article>"
    for page in (f"<main><h1>Site</h1>{story}{cards}</main>", f"<main><h1>Site</h1>{cards}{story}</main>"):
        text = html_text.main_text(page)
        assert "Card" not in text and "Read on" not in text
        assert text.startswith("Site\nStory\nSentence 0") and text.endswith("\nEnd")
    # both stories are content; cards beside a text in a div are not
    both = html_text.main_text(f"{story}{cards}{story.replace('Story', 'Other')}")
    assert "Story" in both and "Other" in both and "Card" not in both
    text = html_text.main_text(f"<div><h1>Head</h1>{''.join(LONG)}<p>End</p></div>{cards}")
    assert text.startswith("Head\nSentence 0") and "\nEnd" in text and "Card 5" not in text


def test_extract(spark):
    frame = spark.createDataFrame([(1, "u", PAGE % "<article><p>Héllo there</article>", "x"), (2, None, None, "y")], "page_id long, url string, html string, text string")
    rows = {r["page_id"]: tuple(r)[1:] for r in html_text.extract(frame).collect()}
    assert rows == {1: ("u", "Héllo there", 11), 2: (None, "", 0)}
    assert html_text.extract(frame.limit(0)).collect() == []
