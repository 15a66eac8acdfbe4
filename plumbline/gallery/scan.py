"""Checks over one scan."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from plumbline.functions.columns import share
from plumbline.gallery.common import LABELLED, Registry, expected, labelled, share_of, table
from plumbline.operators import aggregates as A
from plumbline.plans.checks import Check
from plumbline.plans.evaluate import evaluate

_R = Registry()
QUERIES, ORACLES = _R.queries, _R.oracles

_R.check(
    "c01_has_size",
    "orders",
    lambda c: c.hasSize(">= 1000").hasSize("between 0 and 10"),
    expected("orders", ("count(*)", ">= 1000"), ("count(*)", "BETWEEN 1 AND 9")),
)
_R.check(
    "c02_has_min",
    "lineitem",
    lambda c: c.hasMin("l_quantity", "= 1").hasMin("l_extendedprice", "> 5000"),
    expected("lineitem", ("min(l_quantity)", "= 1"), ("min(l_extendedprice)", "> 5000")),
)
_R.check(
    "c03_is_complete",
    labelled,
    lambda c: c.isComplete("quality").isComplete("lang"),
    expected(
        LABELLED, ("count(quality)::DOUBLE / count(*)", "= 1"), ("count(lang)::DOUBLE / count(*)", "= 1")
    ),
)
_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY"]
_R.check(
    "c04_is_contained_in",
    "customer",
    lambda c: c.isContainedIn("c_mktsegment", _SEGMENTS)
    .isContainedIn("c_mktsegment", [*_SEGMENTS, "HOUSEHOLD"])
    .isContainedIn("c_nationkey", range(20), ">= 0.5"),
    expected(
        "customer",
        ("avg((c_mktsegment IN ('AUTOMOBILE','BUILDING','FURNITURE','MACHINERY'))::INT)", "= 1"),
        (
            "avg((c_mktsegment IN ('AUTOMOBILE','BUILDING','FURNITURE','MACHINERY','HOUSEHOLD'))::INT)",
            "= 1",
        ),
        ("avg((c_nationkey BETWEEN 0 AND 19)::INT)", ">= 0.5"),
    ),
)
_R.check(
    "c05_is_non_negative",
    "customer",
    lambda c: c.isNonNegative("c_acctbal").isNonNegative("c_custkey"),
    expected(
        "customer",
        (share_of("coalesce(c_acctbal, 0) >= 0"), "= 1"),
        (share_of("coalesce(c_custkey, 0) >= 0"), "= 1"),
    ),
)
_R.check(
    "c06_has_completeness",
    labelled,
    lambda c: c.hasCompleteness("toxic", ">= 0.3").hasCompleteness("source", "> 0.99", True),
    expected(
        LABELLED,
        ("count(toxic)::DOUBLE / count(*)", ">= 0.3"),
        (share_of("trim(source) <> ''"), "> 0.99"),
    ),
)
_R.check(
    "c07_are_complete",
    labelled,
    lambda c: c.areComplete(["quality", "toxic"]).areComplete(["doc_id", "lang"]),
    expected(
        LABELLED,
        (share_of("quality IS NOT NULL AND toxic IS NOT NULL"), "= 1"),
        (share_of("doc_id IS NOT NULL AND lang IS NOT NULL"), "= 1"),
    ),
)
_R.check(
    "c08_have_completeness",
    labelled,
    lambda c: c.haveCompleteness(["quality", "lang"], ">= 0.2"),
    expected(LABELLED, (share_of("quality IS NOT NULL AND lang IS NOT NULL"), ">= 0.2")),
)
_R.check(
    "c09_are_any_complete",
    labelled,
    lambda c: c.areAnyComplete(["quality", "lang"]).areAnyComplete(["quality", "toxic"]),
    expected(
        LABELLED,
        (share_of("quality IS NOT NULL OR lang IS NOT NULL"), "= 1"),
        (share_of("quality IS NOT NULL OR toxic IS NOT NULL"), "= 1"),
    ),
)
_R.check(
    "c10_have_any_completeness",
    labelled,
    lambda c: c.haveAnyCompleteness(["quality", "toxic"], "between 0.1 and 0.9"),
    expected(LABELLED, (share_of("quality IS NOT NULL OR toxic IS NOT NULL"), "BETWEEN 0.1 AND 0.9")),
)
_R.check(
    "c11_has_max",
    "lineitem",
    lambda c: c.hasMax("l_quantity", "<= 50"),
    expected("lineitem", ("max(l_quantity)", "<= 50")),
)
_R.check(
    "c12_has_mean",
    "lineitem",
    lambda c: c.hasMean("l_quantity", lambda m: (m > 20) & (m < 30)),
    expected("lineitem", ("avg(l_quantity)", "BETWEEN 20 AND 30")),
)
_R.check(
    "c13_has_sum",
    "lineitem",
    lambda c: c.hasSum("l_quantity", "> 1000").hasSum("l_linenumber", "< 10"),
    expected("lineitem", ("sum(l_quantity)", "> 1000"), ("sum(l_linenumber)", "< 10")),
)



def _large(spark, d):
    """Numbers whose sum leaves 64 bits; exact decimals, since with large keys each of them does too."""
    return table(spark, d, "orders").select((F.col("o_orderkey").cast("decimal(38,0)") * F.lit(1 << 40)).alias("h"))


_R.check(
    "c13_sum_beyond_64_bits",
    _large,
    lambda c: c.hasSum("h", "> 9.3e18").hasSize("> 0"),
    expected("orders", ("sum(o_orderkey::HUGEINT * 1099511627776)", "> 9.3e18"), ("count(*)", "> 0")),
)
_R.check(
    "c14_has_standard_deviation",
    "lineitem",
    lambda c: c.hasStandardDeviation("l_quantity", "< 15"),
    expected("lineitem", ("stddev_pop(l_quantity)", "< 15")),
)
_R.check(
    "c15_has_correlation",
    "lineitem",
    lambda c: c.hasCorrelation("l_quantity", "l_extendedprice", ">= 0.5"),
    expected("lineitem", ("corr(l_quantity, l_extendedprice)", ">= 0.5")),
)
_R.check(
    "c16_has_min_length",
    "part",
    lambda c: c.hasMinLength("p_name", ">= 3"),
    expected("part", ("min(length(p_name))", ">= 3")),
)
_R.check(
    "c17_has_max_length",
    "documents",
    lambda c: c.hasMaxLength("text", "<= 1000"),
    expected("documents", ("max(length(text))", "<= 1000")),
)
_R.check(
    "c18_column_length",
    "part",
    lambda c: c.columnLength("p_name", "between", 7, 11, ">= 0.5").columnLength("p_type", ">=", 5),
    expected(
        "part",
        (share_of("length(p_name) > 7 AND length(p_name) < 11"), ">= 0.5"),
        (share_of("length(p_type) >= 5"), "= 1"),
    ),
)


@_R.query(
    "c19_has_approx_count_distinct",
    "SELECT count(DISTINCT o_orderkey)::DOUBLE AS exact, true AS within_bound, 'PASS' AS result FROM orders",
)
def _approx_distinct(spark, d):
    """The estimate beside the exact count: within three times its standard deviation."""
    check = Check("distinct").hasApproxCountDistinct("o_orderkey", "> 10")
    check.hasNumberOfDistinctValues("o_orderkey", "> 10")
    both = evaluate(table(spark, d, "orders"), check).agg(
        F.max(F.when(F.col("rule_no") == 0, F.col("metric"))).alias("estimate"),
        F.max(F.when(F.col("rule_no") == 1, F.col("metric"))).alias("exact"),
        F.min("result").alias("result"),
    )
    near = F.abs(F.col("estimate") - F.col("exact")) <= 3 * 0.05 * F.col("exact")
    return both.select("exact", near.alias("within_bound"), "result")


def _rank_query(build, col, q, eps):
    """Whether the rank of an estimated quantile is within ``eps`` of ``q``."""

    def query(spark, d):
        df = table(spark, d, "orders")
        results = evaluate(df, build(Check("quantile")))
        estimate = results.select("metric").scalar()
        counted = df.agg(
            F.count(F.lit(1)).alias("n"),
            share(F.col(col) < estimate).alias("below"),
            share(F.col(col) <= estimate).alias("upto"),
        )
        near = (F.col("below") <= q + eps) & (F.col("upto") >= q - eps)
        return counted.select("n", near.alias("within_bound"))

    return query


_R.add(
    "c20_has_approx_quantile",
    _rank_query(lambda c: c.hasApproxQuantile("o_totalprice", 0.5, "> 0"), "o_totalprice", 0.5, 0.001),
    "SELECT count(*) AS n, true AS within_bound FROM orders",
)
_R.add(
    "c21_kll_sketch_satisfies",
    _rank_query(lambda c: c.kllSketchSatisfies("o_totalprice", "> 0", 0.9), "o_totalprice", 0.9, 0.02),
    "SELECT count(*) AS n, true AS within_bound FROM orders",
)


@_R.query(
    "c21_kll_buckets",
    """WITH b AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders)
    SELECT least(greatest(ceil((o_totalprice - lo) / ((hi - lo) / 20)) - 1, 0), 19)::INT AS bucket,
    count(*) AS n, true AS within_bound FROM orders, b GROUP BY 1""",
)
def _kll_buckets(spark, d):
    """Bucket counts of the sketch beside the exact ones: within 2 % of all rows."""
    orders = table(spark, d, "orders")
    found = A.kll_buckets(orders, "o_totalprice", 20)
    price = F.col("o_totalprice")
    lo, hi, rows = orders.agg(F.min(price), F.max(price), F.count(price)).first()
    place = F.ceil((price - lo) / ((hi - lo) / 20)) - 1
    bucket = F.least(F.greatest(place, F.lit(0)), F.lit(19)).cast("int")
    exact = orders.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    near = F.abs(F.col("count") - F.col("n")) <= 0.02 * rows
    return exact.join(found, "bucket").select("bucket", "n", near.alias("within_bound"))


_R.check(
    "c22_satisfies",
    "lineitem",
    lambda c: c.satisfies("l_tax < l_discount AND l_quantity > 10", "cheap", ">= 0.2"),
    expected("lineitem", (share_of("l_tax < l_discount AND l_quantity > 10"), ">= 0.2")),
)
_R.check(
    "c23_has_pattern",
    "orders",
    lambda c: c.hasPattern("o_orderpriority", "^[1-5]-").hasPattern("o_orderpriority", "URGENT$", "> 0.5"),
    expected(
        "orders",
        (share_of("regexp_matches(o_orderpriority, '^[1-5]-')"), "= 1"),
        (share_of("regexp_matches(o_orderpriority, 'URGENT$')"), "> 0.5"),
    ),
)
# Every stretch of digit groups that has 13 to 19 digits, then the check digit of each.
_LUHN = (
    "list_sum(list_transform(range(1, length(s) + 1), lambda i: CASE "
    "WHEN i % 2 = 1 THEN s[length(s) + 1 - i]::INT WHEN s[length(s) + 1 - i]::INT > 4 "
    "THEN 2 * s[length(s) + 1 - i]::INT - 9 ELSE 2 * s[length(s) + 1 - i]::INT END)) % 10 = 0"
)
_CARDS = (
    "(SELECT count(DISTINCT doc_id) FROM (SELECT doc_id, array_to_string(g[i:i + k], '') AS s FROM ("
    "SELECT doc_id, g, unnest(range(1, len(g) + 1)) AS i FROM (SELECT doc_id, string_split_regex(unnest("
    r"regexp_extract_all(text, '\d+(?:[ -]\d+)*')), '[ -]') AS g FROM documents)), range(0, 19) AS r(k) "
    f"WHERE i + k <= len(g)) WHERE length(s) BETWEEN 13 AND 19 AND {_LUHN})::DOUBLE "
    "/ (SELECT count(*) FROM documents)"
)
_R.check(
    "c24_contains_credit_card_number",
    "documents",
    lambda c: c.containsCreditCardNumber("text", "< 0.5"),
    expected("(SELECT 1)", (_CARDS, "< 0.5")),
)
_R.check(
    "c25_contains_email",
    "documents",
    lambda c: c.containsEmail("text", "> 0"),
    expected(
        "documents",
        (share_of(r"regexp_matches(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}')"), "> 0"),
    ),
)
_R.check(
    "c26_contains_url",
    "pages",
    lambda c: c.containsURL("url").containsURL("html", ">= 0.1"),
    expected(
        "pages",
        (share_of(r"regexp_matches(url, 'https?://[^\s/$.?#][^\s]*')"), "= 1"),
        (share_of(r"regexp_matches(html, 'https?://[^\s/$.?#][^\s]*')"), ">= 0.1"),
    ),
)
_SSN = r"\b(00[1-9]|0[1-9]\d|[1-578]\d\d|6[0-57-9]\d|66[0-57-9])-\d{2}-\d{4}\b"
_R.check(
    "c27_contains_social_security_number",
    "documents",
    lambda c: c.containsSocialSecurityNumber("text", "< 0.5"),
    expected("documents", (share_of(f"regexp_matches(text, '{_SSN}')"), "< 0.5")),
)
_R.check(
    "c28_is_positive",
    "lineitem",
    lambda c: c.isPositive("l_discount", ">= 0.9").isPositive("l_quantity"),
    expected(
        "lineitem",
        (share_of("coalesce(l_discount, 1) > 0"), ">= 0.9"),
        (share_of("coalesce(l_quantity, 1) > 0"), "= 1"),
    ),
)
for _name, _method, _op in (
    ("c29_is_less_than", "isLessThan", "<"),
    ("c30_is_less_than_or_equal_to", "isLessThanOrEqualTo", "<="),
    ("c31_is_greater_than", "isGreaterThan", ">"),
    ("c32_is_greater_than_or_equal_to", "isGreaterThanOrEqualTo", ">="),
):
    _R.check(
        _name,
        "lineitem",
        lambda c, m=_method: getattr(getattr(c, m)("l_tax", "l_discount"), m)(
            "l_discount", "l_quantity", ">= 0.5"
        ),
        expected(
            "lineitem",
            (share_of(f"l_tax {_op} l_discount"), "= 1"),
            (share_of(f"l_discount {_op} l_quantity"), ">= 0.5"),
        ),
    )


def _part_texts(spark, d):
    part = table(spark, d, "part")
    return part.select(*[F.col(c).cast("string").alias(c) for c in part.columns])


_R.check(
    "c33_has_data_type",
    _part_texts,
    lambda c: c.hasDataType("p_size", "Integral")
    .hasDataType("p_retailprice", "double")
    .hasDataType("p_brand", "int", "< 0.1")
    .hasDataType("p_partkey", "Fractional"),
    expected(
        "part",
        ("count(TRY_CAST(p_size::VARCHAR AS BIGINT))::DOUBLE / count(p_size)", "= 1"),
        ("count(TRY_CAST(p_retailprice::VARCHAR AS DOUBLE))::DOUBLE / count(p_retailprice)", "= 1"),
        ("count(TRY_CAST(p_brand AS INT))::DOUBLE / count(p_brand)", "< 0.1"),
        ("count(TRY_CAST(p_partkey::VARCHAR AS DOUBLE))::DOUBLE / count(p_partkey)", "= 1"),
    ),
)
_R.check(
    "c34_column_values",
    "customer",
    lambda c: c.columnValues("c_mktsegment", "in", values=_SEGMENTS, assertion=">= 0.7")
    .columnValues("c_nationkey", "between", 0, 24)
    .columnValues("c_acctbal", ">=", -500)
    .columnValues("c_name", "matches", values=["^Customer#[0-9]+$"]),
    expected(
        "customer",
        ("avg((c_mktsegment IN ('AUTOMOBILE','BUILDING','FURNITURE','MACHINERY'))::INT)", ">= 0.7"),
        (share_of("c_nationkey > 0 AND c_nationkey < 24"), "= 1"),
        (share_of("c_acctbal >= -500"), "= 1"),
        (share_of("regexp_matches(c_name, '^Customer#[0-9]+$')"), "= 1"),
    ),
)
_R.check(
    "c35_data_freshness",
    "events",
    lambda c: c.dataFreshness("ts", timedelta(days=10), datetime(2024, 1, 31), ">= 0.3"),
    expected("events", (share_of("ts >= TIMESTAMP '2024-01-31' - INTERVAL 10 DAY"), ">= 0.3")),
)
