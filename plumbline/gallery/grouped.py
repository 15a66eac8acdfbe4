"""Checks over grouped counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.gallery.common import Registry, expected, table
from plumbline.operators.grouped import histogram

_R = Registry()
QUERIES, ORACLES = _R.queries, _R.oracles


def _groups(source: str, cols: str) -> str:
    return f"(SELECT {cols}, count(*) AS c FROM {source} GROUP BY {cols})"


_ORDER = _groups("orders", "o_orderkey")
_LINE = _groups("lineitem", "l_orderkey, l_linenumber")
_TEXT = _groups("documents", "text")
_U = "count(*) FILTER (WHERE c = 1)::DOUBLE"


def _three(metric: str, *demands: str) -> str:
    rules = [expected(s, (metric, p)) for s, p in zip((_ORDER, _LINE, _TEXT), demands)]
    return "\nUNION ALL\n".join(r.replace("SELECT 0 AS", f"SELECT {i} AS") for i, r in enumerate(rules))


_R.check(
    "u01_is_unique",
    "orders",
    lambda c: c.isUnique("o_orderkey").isUnique("o_custkey"),
    expected(_ORDER, (f"{_U} / sum(c)", "= 1"))
    + "\nUNION ALL\n"
    + expected(_groups("orders", "o_custkey"), (f"{_U} / sum(c)", "= 1")).replace(
        "SELECT 0 AS", "SELECT 1 AS"
    ),
)
_R.check(
    "u02_has_uniqueness",
    "lineitem",
    lambda c: c.hasUniqueness(["l_orderkey", "l_linenumber"], ">= 0.9"),
    expected(_LINE, (f"{_U} / sum(c)", ">= 0.9")),
)
_R.check(
    "u03_has_distinctness",
    "documents",
    lambda c: c.hasDistinctness(["text"], ">= 0.9"),
    expected(_TEXT, ("count(*)::DOUBLE / sum(c)", ">= 0.9")),
)
_R.check(
    "u04_has_unique_value_ratio",
    "lineitem",
    lambda c: c.hasUniqueValueRatio(["l_orderkey", "l_linenumber"], ">= 0.99"),
    expected(_LINE, (f"{_U} / count(*)", ">= 0.99")),
)
_R.check(
    "u05_has_number_of_distinct_values",
    "part",
    lambda c: c.hasNumberOfDistinctValues("p_name", "> 10")
    .hasNumberOfDistinctValues("p_retailprice", "< 100", F.floor(F.col("p_retailprice") / 10)),
    expected(
        "part",
        ("count(DISTINCT p_name)", "> 10"),
        ("count(DISTINCT floor(p_retailprice / 10))", "< 100"),
    ),
)
_R.check(
    "u06_is_primary_key",
    "lineitem",
    lambda c: c.isPrimaryKey("l_orderkey", "l_linenumber").isPrimaryKey(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"
    ),
    "\nUNION ALL\n".join(
        expected(_groups("lineitem", keys), (f"{_U} / sum(c)", "= 1")).replace(
            "SELECT 0 AS", f"SELECT {i} AS"
        )
        for i, keys in enumerate(
            (
                "l_orderkey, l_linenumber",
                "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate",
            )
        )
    ),
)
_R.check(
    "u07_has_entropy",
    "events",
    lambda c: c.hasEntropy("event_type", "> 1"),
    expected("events", ("entropy(event_type) * ln(2)", "> 1")),
)
_R.check(
    "u08_has_mutual_information",
    "orders",
    lambda c: c.hasMutualInformation("o_orderstatus", "o_orderpriority", "< 0.1"),
    expected(
        "orders",
        (
            "(entropy(o_orderstatus) + entropy(o_orderpriority) "
            "- entropy(o_orderstatus || '|' || o_orderpriority)) * ln(2)",
            "< 0.1",
        ),
    ),
)
_R.check(
    "u09_has_histogram_values",
    "part",
    lambda c: c.hasHistogramValues("p_type", "= 6").hasHistogramValues(
        "p_type", "> 0.1", value="SMALL"
    ),
    expected(
        "part",
        ("count(DISTINCT p_type)", "= 6"),
        ("count(*) FILTER (WHERE p_type = 'SMALL')::DOUBLE / count(*)", "> 0.1"),
    ),
)


@_R.query(
    "u09_histogram",
    "SELECT value, count, round(count::DOUBLE / (SELECT count(*) FROM lineitem), 6) AS ratio FROM ("
    "SELECT l_quantity::BIGINT::VARCHAR AS value, count(*) AS count FROM lineitem GROUP BY 1) "
    "ORDER BY count DESC, value LIMIT 20",
)
def _top_bins(spark, d):
    """The twenty largest bins: the limit is the report asked for."""
    bins = histogram(
        table(spark, d, "lineitem"), "l_quantity", F.col("l_quantity").cast("bigint"), max_bins=20
    )
    return bins.select("value", "count", F.round("ratio", 6).alias("ratio"))
