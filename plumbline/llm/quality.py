"""Quality rules as a short-circuit cascade, in SQL expressions only.

A rule rejects a document on one or more measures of its text. On a bounded sample from all partitions
the cost of each rule and its selectivity (share it rejects) are taken: what it takes to compute its
measures beyond splitting the text into words, which all rules share, over enough rounds that work
outweighs the start of a job, the best of several runs, in steps of powers of two, so that noise does not reorder them. The rules are then put in order of rejection
per cost, and one nested ``CASE`` over the words asks them in that order: a document that one rule rejects
never reaches the dearer ones behind it. Which documents stay does not depend on the order, so a
noisy estimate changes the time only.

Defined cases: a null or empty text has no words, all measures are 0 and ``too_few_words`` rejects
it; repeated rows each give a row; bytes that are no UTF-8 part no words and count as Spark reads them; an empty table gives no row (the rules keep their given order);
columns of the input with the names of measures are not touched.
"""

from __future__ import annotations

import math
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from plumbline.llm.common import OWN, written

#: Rows on which costs and selectivities are estimated, and the longest text among them.
SAMPLE_ROWS, SAMPLE_CHARS = 500, 65_536
#: Characters that a rule is timed on, how often, and the least cost told apart from none, as a share of the words' own.
TIMED_CHARS, RUNS, LEAST_COST = 2_000_000, 3, 1 / 4

#: Fixed by the contract: white space that parts words, and the symbols.
SPACE = r"[\\x20\\x09-\\x0D]"
SYMBOLS = "#*$%&|<>"

TEXT = "{text}"
#: The words, of which an empty text has one empty one to be left out.
WORDS = rf"filter(split(trim(BOTH ' \t\n\u000B\u000C\r' FROM {TEXT}), '{SPACE}+'), (x, i) -> i > 0 OR x <> '')"
#: Hashes of the words. They stand for the words, which are compared within one text only.
HASHES = "transform({words}, x -> xxhash64(x))"
LINES = f"filter(split({TEXT}, '\\\\n'), l -> l rlike '[^\\\\x20\\\\x09-\\\\x0D]')"


def let(value: str, name: str, body: str) -> str:
    """``body`` with the value computed once under a name."""
    return f"transform(array({value}), {name} -> {body})[0]"


#: A window's fingerprint from its words' hashes: 64 bits, compared within one text only.
_WINDOWS = "transform(sequence(1, size(h) - 4), i -> xxhash64(slice(h, i, 5)))"
#: Starts of the windows found twice or more, in order: neighbours in the sorted list are equal.
_STARTS = let(
    "array_sort(transform(v, (x, i) -> struct(x AS x, i AS i)))",
    "s",
    "array_sort(transform(filter(transform(s, (e, j) -> struct(e.i AS i, "
    "(j > 0 AND s[greatest(j - 1, 0)].x = e.x) OR "
    "(j < size(s) - 1 AND s[least(j + 1, size(s) - 1)].x = e.x) AS again)), e -> e.again), e -> e.i))",
)
#: Words under those windows: each start adds what lies before the next one, five at most.
_COVERED = (
    "aggregate(transform(p, (x, j) -> CASE WHEN j = size(p) - 1 THEN 5 "
    "ELSE least(5, p[least(j + 1, size(p) - 1)] - x) END), 0L, (a, x) -> a + x)"
)
_REPEATED = let(
    HASHES,
    "h",
    "CASE WHEN size(h) < 6 THEN 0L ELSE "
    + let(
        _WINDOWS,
        "v",
        f"CASE WHEN size(array_distinct(v)) = size(v) THEN 0L ELSE {let(_STARTS, 'p', _COVERED)} END",
    )
    + " END",
)

#: Measure -> SQL over the text.
MEASURES = {
    "n_words": "cast(size({words}) AS bigint)",
    "word_chars": rf"cast(char_length(translate({TEXT}, ' \t\n\u000B\u000C\r', '')) AS bigint)",
    "n_symbols": f"cast(char_length({TEXT}) - char_length(translate({TEXT}, '{SYMBOLS}', '')) AS bigint)",
    "n_dup_lines": let(LINES, "l", "cast(size(l) - size(array_distinct(l)) AS bigint)"),
    "n_repeat_words": _REPEATED,
}


@dataclass(frozen=True)
class Rule:
    """Rejects where the condition over its measures holds."""

    name: str
    measures: tuple[str, ...]
    reject: str


RULES = (
    Rule("too_few_words", ("n_words",), "n_words < 10"),
    Rule("word_length", ("n_words", "word_chars"), "word_chars < 2 * n_words OR word_chars > 20 * n_words"),
    Rule("symbols", ("n_words", "n_symbols"), "4 * n_symbols > n_words"),
    Rule("repeated_lines", ("n_dup_lines", "n_words"), "10 * n_dup_lines > n_words"),
    Rule("repeated_words", ("n_words", "n_repeat_words"), "100 * n_repeat_words > 20 * n_words"),
)
#: The contract's base rules; the others are the cascade's own verdict.
BASE = ("too_few_words", "repeated_words")


def measures(text: str, words: str) -> dict[str, str]:
    """The measures over a text, a null one counting as empty, and the name that its words go by."""
    return {k: v.replace("{words}", words).replace(TEXT, f"coalesce({text}, '')") for k, v in MEASURES.items()}


def words_of(text: str) -> str:
    return WORDS.replace(TEXT, f"coalesce({text}, '')")


def inlined(rule: Rule, columns: dict[str, str]) -> str:
    """The rule's condition over text and words, each measure computed once and only when asked."""
    packed = ", ".join(f"'{m}', {columns[m]}" for m in rule.measures)
    body = rule.reject
    for m in rule.measures:
        body = body.replace(m, f"m.{m}")
    return let(f"named_struct({packed})", "m", f"coalesce({body}, false)")


def sampled(docs: DataFrame, text: str, rows: int) -> DataFrame:
    """Texts from all partitions, by a seeded draw and then by hash; ``rows`` at most, as a table of one file."""
    own = OWN + "text"
    texts = docs.select(F.col(text).cast("string").alias(own))
    n = texts.count()
    drawn = texts if n <= 4 * rows else texts.sample(False, 4 * rows / n, seed=11)
    short = drawn.where(F.coalesce(F.length(own), F.lit(0)) <= SAMPLE_CHARS)
    return written(short.orderBy(F.xxhash64(own), own).limit(rows).coalesce(1), "quality_sample")


def estimate(
    docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, rows: int = SAMPLE_ROWS
) -> list[dict]:
    """Per rule: its cost in units of splitting the words, share of the sample it rejects, rejection per cost."""
    own = OWN + "text"
    sample = sampled(docs, text, rows)
    chars = sample.agg(F.coalesce(F.sum(F.length(own)), F.lit(0))).first()[0]
    rounds = min(1000, max(1, TIMED_CHARS // max(1, chars)))
    again = sample.select(own, F.explode(F.sequence(F.lit(1), F.lit(rounds))).alias(OWN + "round"))
    columns = measures(own, "w")

    def counted(frame: DataFrame, test: str) -> tuple[int, int]:
        return tuple(frame.agg(F.expr(f"count_if({let(words_of(own), 'w', test)})"), F.count(F.lit(1))).first())

    def seconds(test: str) -> float:
        best = float("inf")
        for _ in range(RUNS):
            began = time.perf_counter()
            counted(again, test)
            best = min(best, time.perf_counter() - began)
        return best

    shared = "size(w) < 0"
    tests = [inlined(rule, columns) for rule in rules]
    for test in (shared, *tests):  # the first runs pay for starting up and compiling
        counted(again, test)
    base = seconds(shared)
    found = []
    for rule, test in zip(rules, tests):
        rejected, n = counted(sample, test)
        cost = max(LEAST_COST, (seconds(test) - base) / base)
        cost = 2.0 ** round(math.log2(cost))
        share = rejected / n if n else 0.0
        found.append({"rule": rule.name, "cost": cost, "rejects": share, "rate": share / cost})
    return found


def ordered(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> list[Rule]:
    """The rules by rejection per cost, the cheapest first among those that reject nothing, else as given."""
    found = {e["rule"]: e for e in estimate(docs, text, rules)}
    return sorted(rules, key=lambda r: (-found[r.name]["rate"], found[r.name]["cost"]))


def verdict(rules: list[Rule], conditions: list[str]) -> str:
    """The name of the first rule that rejects, else null; ``CASE`` asks no rule behind it."""
    return "CASE " + " ".join(
        f"WHEN {c} THEN '{r.name}'" for r, c in zip(rules, conditions)
    ) + " END" if rules else "CAST(NULL AS string)"


def keep_good(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents that no rule rejects, unchanged."""
    order = ordered(docs, text, rules)
    own = f"cast(`{text}` AS string)"
    columns = measures(own, "w")
    asked = let(words_of(own), "w", verdict(order, [inlined(r, columns) for r in order]))
    return docs.where(F.expr(asked).isNull())


def assess(
    docs: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """All measures of every document, the base verdict and the cascade's.

    ``rejected_by`` is the first rule in the estimated order; only it depends on that order.
    """
    order = [r for r in ordered(docs, text, rules) if r.name not in BASE]
    base = [r for r in rules if r.name in BASE]
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias(OWN + "text"))
    # all measures from the words, which are split once
    columns = measures(OWN + "text", "w")
    packed = let(words_of(OWN + "text"), "w", "named_struct(" + ", ".join(f"'{m}', {e}" for m, e in columns.items()) + ")")
    measured = rows.select("doc_id", F.expr(packed).alias(OWN + "m")).select("doc_id", f"{OWN}m.*")
    failed = " OR ".join(f"({r.reject})" for r in base) or "false"
    return (
        measured.withColumn("base_failed", F.expr(failed))
        .withColumn("rejected_by", F.when(~F.col("base_failed"), F.expr(verdict(order, [r.reject for r in order]))))
        .withColumn("kept", ~F.col("base_failed") & F.col("rejected_by").isNull())
    )
