"""The operators as queries over the given tables, with the SQL that states the result where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from plumbline.llm import (
    decontamination,
    html_text,
    language,
    lines,
    packing,
    periodic,
    quality,
    ranking,
    repeats,
    secrets,
    simhash,
    toxicity,
    warc,
)
from plumbline.llm.common import fold


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: fingerprint and the smallest document within links of two bits."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: words, words under a test item's window, the items."""
    found = decontamination.decontaminate(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), with_text=False
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: toxicity, learned from the labels outside the held-out fold."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    own = fold(F.col("doc_id"), 5)
    scored = toxicity.score(docs, labels.where(toxicity.learnable(F.col("doc_id"), own)))
    return scored.select(
        "doc_id",
        F.coalesce(own == 0, F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
        "flagged",
    )


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: measures, base verdict and the cascade's verdict."""
    return quality.assess(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: language, learned from the rows outside the held-out fold."""
    own = fold(F.col("doc_id"), 3)
    found = language.identify(
        table(spark, sf_dir, "documents"), F.col("doc_id").isNotNull() & (own != 1)
    )
    return found.select(
        "doc_id", F.coalesce(own == 1, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per candidate for a secret: the forest's score and verdict; of the text itself only a digest."""
    return secrets.scan(table(spark, sf_dir, "documents")).select(
        "doc_id", "nth", F.sha2("candidate", 256).alias("candidate_sha256"), "length", "score", "secret"
    )


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page: its main text."""
    return html_text.extract(table(spark, sf_dir, "pages"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per piece of a tokenised document: its place in a sequence of at most 4096 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), with_ids=False)


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: what is left without passages of 100 bytes that also start earlier."""
    return repeats.remove_repeats(table(spark, sf_dir, "documents"), with_text=False).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256"
    )


def op10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its lines, those deleted as later repeats of a run, and the digest of what stays."""
    return lines.line_report(table(spark, sf_dir, "documents"))


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per test item: the ten documents of the highest score above 0."""
    return ranking.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page: its record as read back from the archives that all pages were written to."""
    pages = table(spark, sf_dir, "pages")
    found = warc.read_archives(spark, warc.write_archives(pages), with_payload=False)
    key = pages.schema["page_id"].dataType
    return found.select(
        F.col("key").cast(key).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to_key").cast(key).alias("refers_to"),
    )


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its periodic runs of words, and the digest of what stays without their repeats.

    One document in ten is made periodic from some word on, as the contract says.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    runs = periodic.find_runs(docs.withColumn("text", F.expr(_MADE_PERIODIC)))
    best = F.element_at(F.expr(_BY_EXPONENT), 1)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return (
        runs.withColumn("best", F.when(F.size("runs") > 0, best))
        .select(
            "doc_id",
            F.size("runs").cast("long").alias("n_runs"),
            *(F.col(f"best.{n}").alias(n) for n in ("start", "length", "period")),
            F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
            F.sha2(F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256).alias("runs_sha256"),
            F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
        )
    )


#: The contract's planted documents: from word a on, one of ten repeats p words.
_MADE_PERIODIC = r"""
    CASE WHEN text IS NOT NULL AND crc32(encode(CAST(doc_id AS STRING), 'UTF-8')) % 10 = 0 THEN
        array_join(flatten(transform(
            array(struct(
                regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0) AS w,
                crc32(encode(CAST(doc_id AS STRING), 'UTF-8')) div 10 AS g
            )),
            s -> transform(
                array(struct(s.w AS w, s.g % greatest(size(s.w), 1) AS a,
                    (size(s.w) - s.g % greatest(size(s.w), 1)) div (3 + s.g % 8) + 1 AS p)),
                t -> array_join(transform(t.w, (x, i) -> IF(i < t.a, x, t.w[CAST(t.a + (i - t.a) % t.p AS INT)])), ' ')
            )
        )), '')
    ELSE text END"""
#: Runs by length over period as a fraction, the greatest first; then by start and period.
_BY_EXPONENT = """
    array_sort(runs, (a, b) -> CASE
        WHEN a.length * b.period <> b.length * a.period THEN IF(a.length * b.period > b.length * a.period, -1, 1)
        WHEN a.start <> b.start THEN IF(a.start < b.start, -1, 1)
        WHEN a.period <> b.period THEN IF(a.period < b.period, -1, 1)
        ELSE 0 END)"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_decontamination": op2_decontamination,
    "op3_toxicity": op3_toxicity,
    "op4_quality_rules": op4_quality_rules,
    "op5_language": op5_language,
    "op6_secrets": op6_secrets,
    "op7_html": op7_html,
    "op8_packing": op8_packing,
    "op9_repeats": op9_repeats,
    "op10_lines": op10_lines,
    "op11_search": op11_search,
    "op12_warc": op12_warc,
    "op13_periodic_runs": op13_periodic_runs,
}

#: DuckDB's view of the contracts that SQL can state.
_LOWER = "translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ITEM_WORDS = (
    "regexp_extract_all(" + _LOWER.format(t="text") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
ORACLES: dict[str, str] = {
    "op2_decontamination": f"""WITH
    i AS (SELECT item_id, w, least(10, len(w)) AS s FROM (SELECT item_id, {_ITEM_WORDS} AS w FROM benchmark)
        WHERE len(w) > 0),
    g AS (SELECT DISTINCT item_id, s, array_to_string(w[p:p + s - 1], ' ') AS run
        FROM (SELECT *, unnest(range(1, len(w) - s + 2)) AS p FROM i)),
    d AS (SELECT doc_id, coalesce({_ITEM_WORDS}, []) AS w FROM documents),
    r AS (SELECT doc_id, s, p, array_to_string(w[p:p + s - 1], ' ') AS run FROM (
        SELECT doc_id, w, s, unnest(range(1, len(w) - s + 2)) AS p FROM d, (SELECT DISTINCT s FROM g) WHERE len(w) >= s)),
    h AS (SELECT doc_id, item_id, p, s FROM r JOIN g USING (s, run)),
    n AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + s)) AS q FROM h) GROUP BY 1),
    m AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM h) GROUP BY 1)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
    coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)""",
    "op11_search": r"""WITH
    d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all({l}, '{t}') AS w FROM documents),
    c AS (SELECT *, len(w) AS n FROM d WHERE len(w) > 0),
    s AS (SELECT count(*) AS docs, sum(n)::HUGEINT AS terms FROM c),
    i AS (SELECT item_id, term, count(*) AS times FROM (
        SELECT item_id, unnest(regexp_extract_all({l}, '{t}')) AS term FROM benchmark) GROUP BY ALL),
    o AS (SELECT doc_id, r, n, term, count(*) AS tf FROM (SELECT doc_id, r, n, unnest(w) AS term FROM c)
        WHERE term IN (SELECT term FROM i) GROUP BY ALL),
    f AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM o, s GROUP BY term, docs),
    x AS (SELECT item_id, r, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms))))::BIGINT AS score
        FROM o JOIN f USING (term) JOIN i USING (term), s GROUP BY ALL)
    SELECT item_id, rank, doc_id, score FROM (SELECT item_id, doc_id, score,
        (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INT AS rank FROM x WHERE score > 0)
    WHERE rank <= 10""".format(
        l=_LOWER.format(t="text"), t=r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    ),
    "op12_warc": """SELECT page_id, strlen(p) AS payload_bytes,
    array_to_string(list_transform(range(0, 8), lambda g: array_to_string(list_transform([15, 10, 5, 0], lambda b:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, 1 + 5 * g, 5))::INT >> b) & 31), 1)), '')), '')
        AS payload_digest,
    CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> top THEN top END AS refers_to
    FROM (SELECT page_id, coalesce(html, '') AS p, sha1(coalesce(html, '')) AS h,
        max(page_id) OVER (PARTITION BY coalesce(html, '')) AS top FROM pages)""",
    "op4_quality_rules": r"""WITH
    d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS l
        FROM documents),
    g AS (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, run) AS c FROM (
        SELECT doc_id, p, w[p:p + 4] AS run FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS p FROM d WHERE len(w) > 4))),
    r AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + 5)) AS q FROM g WHERE c > 1) GROUP BY 1),
    m AS (SELECT doc_id, len(w)::BIGINT AS n_words,
        coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
        FROM d LEFT JOIN r USING (doc_id)),
    b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
    SELECT *, NOT base_failed AND word_chars BETWEEN 2 * n_words AND 20 * n_words AND 4 * n_symbols <= n_words
        AND 10 * n_dup_lines <= n_words AS kept FROM b""",
}
