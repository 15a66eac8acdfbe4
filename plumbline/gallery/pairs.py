"""Checks over two data sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.gallery.common import Registry, judged, table
from plumbline.operators import pairs as X
from plumbline.plans.checks import Check
from plumbline.plans.evaluate import evaluate

_R = Registry()
QUERIES, ORACLES = _R.queries, _R.oracles


def _rounded(df):
    return df.withColumn("metric", F.round("metric", 6))


@_R.query(
    "x01_referential_integrity",
    """SELECT count(*) AS checked, count(p.o_orderkey) AS matched,
    round(count(p.o_orderkey)::DOUBLE / count(*), 6) AS metric
    FROM lineitem LEFT JOIN (SELECT DISTINCT o_orderkey FROM orders WHERE o_orderstatus = 'F') p
    ON l_orderkey = p.o_orderkey""",
)
def _integrity(spark, d):
    finished = table(spark, d, "orders").where("o_orderstatus = 'F'")
    lines = table(spark, d, "lineitem")
    return _rounded(X.referential_integrity(lines, ["l_orderkey"], finished, ["o_orderkey"]))


@_R.query(
    "x02_row_count_match",
    """SELECT a AS rows, b AS reference_rows, round(a::DOUBLE / b, 6) AS metric
    FROM (SELECT (SELECT count(*) FROM lineitem) AS a, (SELECT count(*) FROM orders) AS b)""",
)
def _row_counts(spark, d):
    return _rounded(X.row_count_match(table(spark, d, "lineitem"), table(spark, d, "orders")))


@_R.query(
    "x03_aggregate_match",
    """SELECT a::DOUBLE AS value, b::DOUBLE AS reference_value, round(a::DOUBLE / b::DOUBLE, 6) AS metric
    FROM (SELECT (SELECT sum(o_totalprice::DECIMAL(18,2)) FROM orders) AS a,
                 (SELECT sum(l_extendedprice::DECIMAL(18,2)) FROM lineitem) AS b)""",
)
def _aggregates(spark, d):
    return _rounded(
        X.aggregate_match(
            table(spark, d, "orders"),
            "sum(cast(o_totalprice AS decimal(18,2)))",
            table(spark, d, "lineitem"),
            "sum(cast(l_extendedprice AS decimal(18,2)))",
        )
    )


_DRIFTED_SQL = """(SELECT CASE WHEN o_orderpriority = '5-LOW' THEN -1 - o_orderkey ELSE o_orderkey END AS o_orderkey,
    o_custkey, CASE WHEN o_totalprice > 400000 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
    o_totalprice, o_orderdate, o_orderpriority FROM orders)"""


def _drifted(orders):
    """Orders with new keys for one priority and another status for dear ones."""
    return orders.withColumns(
        {
            "o_orderkey": F.expr(
                "CASE WHEN o_orderpriority = '5-LOW' THEN -1 - o_orderkey ELSE o_orderkey END"
            ),
            "o_orderstatus": F.expr("CASE WHEN o_totalprice > 400000 THEN 'X' ELSE o_orderstatus END"),
        }
    )


_MATCH_SQL = f"""SELECT matched, changed, missing, extra,
    round(matched::DOUBLE / (matched + changed + missing), 6) AS metric FROM (
    SELECT count(*) FILTER (WHERE both_sides AND same) AS matched,
        count(*) FILTER (WHERE both_sides AND NOT same) AS changed,
        count(*) FILTER (WHERE d_key IS NULL) AS missing,
        count(*) FILTER (WHERE r_key IS NULL) AS extra
    FROM (SELECT r.o_orderkey AS r_key, d.o_orderkey AS d_key,
        r.o_orderkey IS NOT NULL AND d.o_orderkey IS NOT NULL AS both_sides,
        r.o_custkey IS NOT DISTINCT FROM d.o_custkey
        AND r.o_orderstatus IS NOT DISTINCT FROM d.o_orderstatus
        AND r.o_totalprice IS NOT DISTINCT FROM d.o_totalprice
        AND r.o_orderdate IS NOT DISTINCT FROM d.o_orderdate
        AND r.o_orderpriority IS NOT DISTINCT FROM d.o_orderpriority AS same
        FROM orders r FULL JOIN {_DRIFTED_SQL} d ON r.o_orderkey = d.o_orderkey))"""


@_R.query("x04_dataset_match", _MATCH_SQL)
def _match(spark, d):
    orders = table(spark, d, "orders")
    return _rounded(X.dataset_match(_drifted(orders), orders, ["o_orderkey"]))


@_R.query("x04_digest_match", _MATCH_SQL)
def _digest_match(spark, d):
    orders = table(spark, d, "orders")
    return _rounded(X.digest_match(_drifted(orders), orders, ["o_orderkey"]))


@_R.query(
    "x05_schema_conformance",
    """SELECT 'p_partkey' AS column_name, 'bigint' AS expected_type, true AS present,
        count(p_partkey) AS cells, count(p_partkey) AS castable, 1.0::DOUBLE AS metric FROM part
    UNION ALL SELECT 'p_name', 'string', true, count(p_name), count(p_name), 1.0 FROM part
    UNION ALL SELECT 'p_type', 'date', true, count(p_type), 0, 0.0 FROM part
    UNION ALL SELECT 'p_size', 'int', true, count(p_size), count(p_size), 1.0 FROM part
    UNION ALL SELECT 'p_retailprice', 'double', true, count(p_retailprice), count(p_retailprice), 1.0 FROM part
    UNION ALL SELECT 'p_brand', 'int', true, count(p_brand),
        count(TRY_CAST(replace(p_brand, 'Brand#1', '1') AS INT)),
        round(count(TRY_CAST(replace(p_brand, 'Brand#1', '1') AS INT))::DOUBLE / count(p_brand), 6) FROM part
    UNION ALL SELECT 'p_container', 'string', false, 0, 0, 0.0""",
)
def _conformance(spark, d):
    part = table(spark, d, "part")
    shortened = part.withColumn("p_brand", F.expr("replace(p_brand, 'Brand#1', '1')"))
    texts = shortened.select(*[F.col(c).cast("string").alias(c) for c in part.columns])
    wanted = part.withColumns(
        {"p_brand": F.lit(1), "p_type": F.lit(None).cast("date"), "p_container": F.lit("")}
    )
    return _rounded(X.schema_conformance(texts, wanted))


@_R.query(
    "x06_dropped_columns",
    """SELECT DISTINCT o_orderstatus, 'o_orderpriority' AS column_name FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT DISTINCT o_orderstatus, 'o_clerk' FROM orders""",
)
def _dropped(spark, d):
    """One status lost its priority, as a partition written without the column reads."""
    lost = "CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END"
    orders = table(spark, d, "orders").withColumn("o_orderpriority", F.expr(lost))
    expected = ["o_orderkey", "o_custkey", "o_orderpriority", "o_clerk"]
    return X.dropped_columns(orders, expected, ["o_orderstatus"])


@_R.query(
    "x07_custom_sql",
    """SELECT round(avg(n), 6) AS metric FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey)""",
)
def _custom(spark, d):
    sql = "SELECT avg(n) FROM (SELECT o_custkey, count(*) AS n FROM {primary} GROUP BY o_custkey)"
    return _rounded(X.custom_sql(spark, sql, {"primary": table(spark, d, "orders")}).select("metric"))


@_R.query(
    "x_two_table_rules",
    """SELECT 0 AS rule_no, round((SELECT count(*) FROM lineitem SEMI JOIN orders
            ON l_orderkey = o_orderkey)::DOUBLE / (SELECT count(*) FROM lineitem), 6) AS metric, 'PASS' AS result
    UNION ALL SELECT 1, round((SELECT count(*) FROM lineitem)::DOUBLE / (SELECT count(*) FROM orders), 6), 'FAIL'
    UNION ALL SELECT 2, 1.0, 'PASS'
    UNION ALL SELECT 3, 1.0, 'PASS'
    UNION ALL SELECT 4, max(l_quantity), 'PASS' FROM lineitem""",
)
def _two_table_rules(spark, d):
    """The two-table checks as rules of one check."""
    lines = table(spark, d, "lineitem")
    check = (
        Check("pairs")
        .referentialIntegrity(["l_orderkey"], "orders", ["o_orderkey"])
        .rowCountMatch("orders")
        .schemaMatch("lines")
        .columnExists("l_tax")
        .customSql("SELECT max(l_quantity) FROM {primary}", "<= 50")
    )
    references = {"orders": table(spark, d, "orders"), "lines": lines}
    return judged(evaluate(lines, check, references=references))
