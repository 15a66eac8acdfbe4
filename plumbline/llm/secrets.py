"""Secret scan: candidates by place and shape, false positives removed by a random forest. DataFrame code only.

A candidate is whatever is assigned to a credential word (``password = ...``, ``token: "..."``), of any length
and alphabet, in quotes up to their end; and any run of 16 or more characters of keys and encodings that
has a digit, or of 20 or more that has none. From its length, changes of character class, cover by
dictionary words, the path it comes from and the words on both sides a random forest (``pyspark.ml``)
says how likely it is a secret. The forest learns from labelled findings: given ones (a table of the same
measures with ``label`` 0/1), or else candidates that are settled by evidence which is none of the
forest's measures: a known key format, or a value in quotes assigned to a credential word, is a secret; a
number with a payment card's check digit, a value that calls itself an example, what stands beside the name of
a digest, and a run of letters that is assigned to nothing, is none. ``sample_rows`` of each label are used
at most, twice that many where many have one hash.

Every text is searched whole. Texts without a candidate are left after one pass of one pattern. What is
written on the way are measures and labels, never a candidate's text.

Defined cases: a null or empty text has no candidate; repeated rows repeat their findings; where no
labels of both kinds exist, the score is the label there is, or one half without any; an empty table
gives no row; bytes that are no UTF-8 part words as any other sign. Columns beside the named ones are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from plumbline.llm.common import OWN, written
from plumbline.llm.language import bounded, sample

SAMPLE_ROWS, TREES, DEPTH, CONTEXT = 2_000, 20, 6, 40

#: Fixed patterns: the shape of a candidate, key formats, words beside secrets and beside examples.
RUN = r"(?<![A-Za-z0-9_+/-])(?:(?=[A-Za-z_+/-]*[0-9])[A-Za-z0-9_+/-]{16,}+|[A-Za-z_+/-]{20,}+)={0,2}"
CREDENTIAL = r"(?i:password|passwd|passphrase|pwd|secret|token|api[_-]?key|access[_-]?key|credentials?|auth(?:orization)?|bearer)"
#: Parts of which each credential word has one, in small letters.
STEMS = ("pass", "pwd", "secret", "token", "api", "access", "credential", "auth", "bearer")
#: What stands between a credential word and its value; quotes, if any, are the last of it.
ASSIGN = CREDENTIAL + r"(?i:[a-z_-]{0,16})[\"']?\s{0,3}(?::=|=>|[=:])\s{0,3}(?i:bearer\s+|basic\s+)?"
ASSIGNED = ASSIGN + r"(?:\"[^\"\n]+|'[^'\n]+|[^\s\"'`<>,;]*[^\s\"'`<>,;.:!?)])"
SHAPE = f"(?:{ASSIGNED}|{RUN})"
BEFORE = rf"^{ASSIGN}[\"']?"
DIGEST = r"(?i)(sha-?\d*|md5|checksum|digest|commit|hash|etag|uuid)[\"']?\s*[=:]?\s*[\"']?$"
LETTERS = "^[A-Za-z_+/-]+$"
FORMATS = r"^(AKIA[0-9A-Z]{16}|ASIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|sk_live_[A-Za-z0-9]{16,}|glpat-[A-Za-z0-9_-]{20,}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_-]{35})$"
EXAMPLE = r"(?i)(example|sample|dummy|placeholder|changeme|your[_-]?(key|token)|xxxx|test)"
NOT_PATH = r"(?i)(^|[/_.-])(tests?|examples?|samples?|fixtures?|mocks?|docs?)([/_.-]|$)"
CARD = r"^[0-9]{13,19}$"
CHANGES = r"[a-z](?=[^a-z])|[A-Z](?=[^A-Z])|[0-9](?=[^0-9])|[^A-Za-z0-9](?=[A-Za-z0-9])"
#: A small dictionary: words that make up identifiers and paths.
WORDS = (
    "about access account action admin after android apple array assets auth base before binary block "
    "body book branch browser build button cache call card case change check class client cloud code "
    "column command common config connect content copy core count create data date default delete "
    "demo detail device docs document download draft edit element email encode error event example "
    "export field file filter find font form format frame from function game general global graph "
    "group guide handle hash head help home host html http icon image import index info init input "
    "item java json kernel label language last layout level library license light link list load "
    "local lock login logo long main make manage master media menu message meta method mobile model "
    "module month name native network news next node note number object open option order output "
    "package page panel parse part password path people photo phone play plugin point post print "
    "private process product profile project public python query queue random range read record "
    "release remote report request resource result return review root route rule sample schema script "
    "search secret section select send server service session shared show simple site size source "
    "space stack standard start state static status store stream string style support system table "
    "target task team temp template test text theme this thread time title token tool track tree type "
    "update upload user util value vendor version video view vote web widget window with word work"
).split()

FEATURES = (
    "length", "changes", "digits", "upper", "lower", "hex_only", "distinct_share",
    "symbols", "dictionary", "example_path", "path_depth", "example_near", "near_words", "after_word",
)


def card_check(c: Column) -> Column:
    """Whether the digits end in a payment card's check digit."""
    digits = F.transform(F.split(F.reverse(c), ""), lambda d: F.try_to_number(d, F.lit("9")).cast("int"))
    doubled = F.transform(
        digits,
        lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d),
    )
    total = F.aggregate(doubled, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)))
    return c.rlike(CARD) & (total % 10 == 0)


def candidates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = "source"
) -> DataFrame:
    """``doc_id, nth, candidate`` with the measures the forest reads, one row per candidate."""
    t, p = OWN + "text", OWN + "path"
    rows = docs.select(
        F.col(key).alias("doc_id"), F.col(text).cast("string").alias(t), F.coalesce(F.col(path).cast("string"), F.lit("")).alias(p)
    )
    # plain searches first: the pattern of assignments is dear, and most texts have no credential word
    low = F.lower(t)
    named = reduce(Column.__or__, [low.contains(stem) for stem in STEMS])

    def either(search):
        return F.when(F.col("named"), search(SHAPE)).otherwise(search(RUN))

    found = (
        rows.withColumn("named", F.coalesce(named, F.lit(False)))
        .select(
            "doc_id",
            F.col(p),
            F.col(t),
            "named",
            either(lambda pattern: F.regexp_extract_all(F.col(t), F.lit(pattern), F.lit(0))).alias("c"),
        )
        .where(F.size("c") > 0)
        .select("doc_id", p, "c", either(lambda pattern: F.split(F.col(t), pattern, -1)).alias("between"))
    ).select("doc_id", p, "between", F.posexplode("c").alias("i", "candidate"))
    prefix = F.regexp_extract("candidate", BEFORE, 0)
    before = F.right(F.concat(F.get("between", F.col("i")), prefix), F.lit(CONTEXT))
    after = F.left(F.get("between", F.col("i") + 1), F.lit(CONTEXT))
    near = found.select(
        "doc_id",
        F.col("i").cast("long").alias("nth"),
        F.substring("candidate", F.length(prefix) + 1, F.length("candidate")).alias("candidate"),
        F.col(p),
        before.alias("before"),
        after.alias("after"),
        (F.length(prefix) > 0).alias("assigned"),
    )
    return _measured(near, p)


def _measured(near: DataFrame, path: str) -> DataFrame:
    c = F.col("candidate")
    size = F.length(c)
    share = lambda pattern: F.regexp_count(c, F.lit(pattern)) / size
    around = F.concat("before", F.lit(" "), "after")
    measured = near.select(
        "doc_id",
        "nth",
        "candidate",
        size.cast("double").alias("length"),
        (F.regexp_count(c, F.lit(CHANGES)) / size).alias("changes"),
        share("[0-9]").alias("digits"),
        share("[A-Z]").alias("upper"),
        share("[a-z]").alias("lower"),
        share("[^A-Za-z0-9]").alias("symbols"),
        c.rlike("^([0-9a-f]+|[0-9A-F]+)$").cast("double").alias("hex_only"),
        (F.size(F.array_distinct(F.split(c, ""))) / size).alias("distinct_share"),
        (1 - F.length(F.regexp_replace(F.lower(c), "|".join(WORDS), "")) / size).alias("dictionary"),
        F.col(path).rlike(NOT_PATH).cast("double").alias("example_path"),
        F.regexp_count(path, F.lit("/")).cast("double").alias("path_depth"),
        F.col("before").rlike("[\"'`]$").cast("double").alias("quoted"),
        around.rlike(EXAMPLE).cast("double").alias("example_near"),
        F.regexp_count(F.lower(around), F.lit(r"\b(?:" + "|".join(WORDS) + r")\b")).cast("double").alias("near_words"),
        F.col("after").rlike(r"^[\s\"'`,;.)]").cast("double").alias("after_word"),
        "assigned",
        F.col("before").rlike(DIGEST).alias("named_digest"),
    )
    quoted, assigned = F.col("quoted") == 1, F.col("assigned")
    return measured.withColumn(
        "settled",
        F.when(c.rlike(EXAMPLE), 0)
        .when(card_check(c), 0)
        .when(c.rlike(FORMATS), 1)
        .when(assigned & quoted & ~c.rlike(r"\s"), 1)
        .when(F.col("named_digest") & ~assigned, 0)
        .when(c.rlike(LETTERS) & ~assigned, 0),
    ).drop("quoted", "named_digest")


def labelled(found: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The settled candidates' measures as labelled findings, about ``sample_rows`` of each label."""
    known = written(
        found.where("settled IS NOT NULL AND doc_id IS NOT NULL").select(
            "doc_id", "nth", F.col("settled").cast("double").alias("label"), *FEATURES
        ),
        "findings",
    )
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = sample(known, "label", sample_rows, counts)
    parts = [bounded(chosen.where(F.col("label") == x), 2 * sample_rows, "doc_id", "nth", *FEATURES) for x in sorted(counts)]
    return reduce(DataFrame.unionByName, parts, known.limit(0)).select("label", *FEATURES)


def train(findings: DataFrame, trees: int = TREES, depth: int = DEPTH):
    """A forest from findings with ``label`` and measures; a number where they have one label or none."""
    kinds = sorted(r["label"] for r in findings.select("label").distinct().collect())
    if len(kinds) < 2:
        return float(kinds[0]) if kinds else 0.5
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(
        findings.coalesce(1).sortWithinPartitions("label", *FEATURES)
    )
    return RandomForestClassifier(
        numTrees=trees, maxDepth=depth, seed=17, labelCol="label", featuresCol="features"
    ).fit(rows.select("label", "features"))


def scored(found: DataFrame, model) -> DataFrame:
    """The candidates with the forest's ``score`` that they are secrets."""
    if isinstance(model, float):
        return found.withColumn("score", F.lit(model))
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(found)
    return model.transform(rows).withColumn("score", vector_to_array("probability")[1])


def scan(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    path: str = "source",
    findings: DataFrame | None = None,
    threshold: float = 0.5,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """Per candidate: document, which one there, itself, its score and whether it counts as a secret."""
    found = candidates(docs, key, text, path)
    model = train(labelled(found, sample_rows) if findings is None else findings)
    return scored(found, model).select(
        "doc_id", "nth", "candidate", "length", "score", (F.col("score") >= threshold).alias("secret")
    )
