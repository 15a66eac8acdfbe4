"""Rulesets: split, evaluated, tallied, scored, per table, per partition and on arrival."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from plumbline.gallery.common import Registry, judged, share_of, table
from plumbline.plans import score as S
from plumbline.plans.evaluate import evaluate, evaluate_batch, evaluate_many, with_defaults
from plumbline.plans.rules import explode_rules, rulesets_frame
from plumbline.scratch import scratch_path
from plumbline.sources.readers import read_source
from plumbline.streaming.accumulated import evaluate_so_far
from plumbline.streaming.arriving import evaluate_arriving

_R = Registry()
QUERIES, ORACLES = _R.queries, _R.oracles


@_R.query(
    "r01_explode_rules",
    """SELECT c_name AS ruleset_name, 0 AS rule_no, 'HasSize' AS rule_type, NULL AS column_name,
        '>=' AS op, c_custkey::DOUBLE AS lo, NULL::DOUBLE AS hi, NULL AS items, NULL::DOUBLE AS threshold
        FROM customer
    UNION ALL SELECT c_name, 1, 'IsContainedIn', 'c_mktsegment', 'in', NULL, NULL,
        c_mktsegment || '|a, B c|say "so"', 0.5 FROM customer
    UNION ALL SELECT c_name, 2, 'HasMin', 'c acctbal', 'between', c_nationkey::DOUBLE, 100.5, NULL, NULL
        FROM customer
    UNION ALL SELECT c_name, 3, 'IsUnique', 'c_name', NULL, NULL, NULL, NULL, NULL FROM customer""",
)
def _explode(spark, d):
    """One ruleset text per customer, split into its rules again."""
    text = F.format_string(
        "HasSize >= %d, \n"
        'IsContainedIn "c_mktsegment" in ["%s","a, B c","say ""so"""] with threshold >= 0.5, \n'
        'HasMin "c acctbal" between %d and 100.5, \n'
        'IsUnique "c_name"',
        "c_custkey",
        "c_mktsegment",
        "c_nationkey",
    )
    rulesets = table(spark, d, "customer").select(
        F.col("c_name").alias("Name"), text.alias("Ruleset")
    )
    return explode_rules(rulesets).select(
        "ruleset_name",
        "rule_no",
        "rule_type",
        "column_name",
        "op",
        "lo",
        "hi",
        F.array_join("in_list", "|").alias("items"),
        F.col("threshold_lo").alias("threshold"),
    )


SLICE = [
    "HasSize >= 1000",
    'HasMin "l_quantity" = 1',
    'IsComplete "l_shipdate"',
    'IsUnique "l_orderkey"',
    'IsContainedIn "l_returnflag" in ["A","N","R"]',
    'IsNonNegative "l_discount"',
]
_UNIQUE_SQL = (
    "any_value((SELECT count(*) FILTER (WHERE c = 1)::DOUBLE / sum(c) FROM "
    "(SELECT count(*) AS c FROM lineitem GROUP BY l_orderkey)))"
)
_METRICS = [
    ("HasSize", "count(*)::DOUBLE", ">= 1000"),
    ("HasMin", "min(l_quantity)", "= 1"),
    ("IsComplete", "count(l_shipdate)::DOUBLE / count(*)", "= 1"),
    ("IsUnique", _UNIQUE_SQL, "= 1"),
    ("IsContainedIn", share_of("l_returnflag IN ('A', 'N', 'R')"), "= 1"),
    ("IsNonNegative", share_of("l_discount >= 0"), "= 1"),
]
SLICE_SQL = "\nUNION ALL\n".join(
    f"SELECT {i} AS rule_no, '{kind}' AS rule_type, round(m, 6) AS metric, "
    f"CASE WHEN m {demand} THEN 'PASS' ELSE 'FAIL' END AS result "
    f"FROM (SELECT {metric} AS m FROM lineitem)"
    for i, (kind, metric, demand) in enumerate(_METRICS)
)


def flagship(spark, d):
    """Six rules of one ruleset on ``lineitem``: one fused aggregate and one grouped count."""
    results = evaluate(table(spark, d, "lineitem"), SLICE, name="lineitem")
    return results.select("rule_no", "rule_type", F.round("metric", 6).alias("metric"), "result")


_R.add("r02_evaluate", flagship, SLICE_SQL)

_FORMS = [
    ('HasMax "l_quantity" = 50', "max(l_quantity)", "= 50"),
    ('HasMax "l_quantity" > 50', "max(l_quantity)", "> 50"),
    ('HasMin "l_quantity" < 2', "min(l_quantity)", "< 2"),
    ('HasMean "l_quantity" >= 20.5', "avg(l_quantity)", ">= 20.5"),
    ('HasMean "l_quantity" <= 2.05e1', "avg(l_quantity)", "<= 20.5"),
    ('HasMin "l_quantity" between 1 and 3', "min(l_quantity)", "BETWEEN 2 AND 2"),
    ('HasMax "l_quantity" between 49.5 and 50.5', "max(l_quantity)", "BETWEEN 49.6 AND 50.4"),
    ('HasMax "l_linenumber" in [5, 6, 7]', "max(l_linenumber)", "IN (5, 6, 7)"),
]


@_R.query(
    "r03_assertion_forms",
    "\nUNION ALL\n".join(
        f"SELECT {i} AS rule_no, round(m, 6) AS metric, "
        f"CASE WHEN m {demand} THEN 'PASS' ELSE 'FAIL' END AS result "
        f"FROM (SELECT CAST({metric} AS DOUBLE) AS m FROM lineitem)"
        for i, (_, metric, demand) in enumerate(_FORMS)
    ),
)
def _forms(spark, d):
    return judged(evaluate(table(spark, d, "lineitem"), [text for text, _, _ in _FORMS]))


_MIXED = [
    'IsComplete "o_orderdate"',
    'IsPositive "o_totalprice"',
    'HasMin "o_totalprice" > 100000',
    'HasMin "o_totalprice" != 0',
    'IsComplete "o_clerk"',
    "HasColour = 1",
    'IsUnique "o_custkey"',
    'HasPattern "o_orderpriority" matches "[a"',
    'IsLessThan "o_orderpriority" "o_custkey"',
    'CustomSql "SELECT o_custkey FROM {primary}" > 0',
    'ReferentialIntegrity "o_orderpriority" "customer.c_custkey"',
    'ReferentialIntegrity "o_custkey" "customer.c_custkey"',
]
_MIXED_SQL = """(SELECT 0 AS rule_no, 'PASS' AS result
    UNION ALL SELECT 1, CASE WHEN min(o_totalprice) > 0 THEN 'PASS' ELSE 'FAIL' END FROM orders
    UNION ALL SELECT 2, CASE WHEN min(o_totalprice) > 100000 THEN 'PASS' ELSE 'FAIL' END FROM orders
    UNION ALL SELECT 3, 'ERROR' UNION ALL SELECT 4, 'ERROR' UNION ALL SELECT 5, 'SKIP'
    UNION ALL SELECT 6, CASE WHEN count(DISTINCT o_custkey) = count(*) THEN 'PASS' ELSE 'FAIL' END FROM orders
    UNION ALL SELECT 7, 'ERROR' UNION ALL SELECT 8, 'ERROR'
    UNION ALL SELECT 9, CASE WHEN count(*) > 1 THEN 'ERROR' WHEN max(o_custkey) > 0 THEN 'PASS' ELSE 'FAIL' END FROM orders
    UNION ALL SELECT 10, 'ERROR'
    UNION ALL SELECT 11, CASE WHEN count(c_custkey) = count(*) THEN 'PASS' ELSE 'FAIL' END
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey)"""


def _mixed(spark, d):
    customers = {"customer": table(spark, d, "customer")}
    return evaluate(table(spark, d, "orders"), _MIXED, name="mixed", references=customers)


_R.add(
    "r04_rule_status",
    lambda spark, d: _mixed(spark, d).select("rule_no", "result"),
    f"SELECT rule_no, result FROM {_MIXED_SQL}",
)
_R.add(
    "r05_tally",
    lambda spark, d: S.tally(_mixed(spark, d)).select(
        "ruleset_name", "rules", "pass", "fail", "error", "skip"
    ),
    f"""SELECT 'mixed' AS ruleset_name, count(*) AS rules, count(*) FILTER (WHERE result = 'PASS') AS pass,
    count(*) FILTER (WHERE result = 'FAIL') AS fail, count(*) FILTER (WHERE result = 'ERROR') AS error,
    count(*) FILTER (WHERE result = 'SKIP') AS skip FROM {_MIXED_SQL}""",
)
_R.add(
    "r06_score",
    lambda spark, d: S.score(_mixed(spark, d)).select(
        "ruleset_name", F.round("score", 6).alias("score")
    ),
    f"""SELECT 'mixed' AS ruleset_name, round(count(*) FILTER (WHERE result = 'PASS')::DOUBLE
    / count(*) FILTER (WHERE result IN ('PASS', 'FAIL')), 6) AS score FROM {_MIXED_SQL}""",
)
_R.add(
    "r07_failing",
    lambda spark, d: S.failing(_mixed(spark, d)).select(
        "rule_no", "result", (F.length("message") > 0).alias("explained")
    ),
    f"SELECT rule_no, result, true AS explained FROM {_MIXED_SQL} WHERE result <> 'PASS'",
)
_RULESETS = {
    "sizes": 'HasSize >= 1000, \nHasMin "o_totalprice" > 0, IsUnique "o_orderkey"',
    "values": [
        'IsContainedIn "o_orderstatus" in ["F","O"] with threshold >= 0.6',
        'HasMin "o_totalprice" > 1e6',
        'IsUnique "o_orderkey"',
    ],
}


@_R.query(
    "r08_evaluate_many",
    """SELECT 'sizes' AS ruleset_name, 0 AS rule_no, count(*)::DOUBLE AS metric,
        CASE WHEN count(*) >= 1000 THEN 'PASS' ELSE 'FAIL' END AS result FROM orders
    UNION ALL SELECT 'sizes', 1, min(o_totalprice), 'PASS' FROM orders
    UNION ALL SELECT 'values', 0, round(avg((o_orderstatus IN ('F','O'))::INT), 6),
        CASE WHEN avg((o_orderstatus IN ('F','O'))::INT) >= 0.6 THEN 'PASS' ELSE 'FAIL' END FROM orders
    UNION ALL SELECT 'values', 1, min(o_totalprice), 'FAIL' FROM orders
    UNION ALL SELECT n, 2, round(m, 6), CASE WHEN m = 1 THEN 'PASS' ELSE 'FAIL' END
        FROM (SELECT count(*) FILTER (WHERE c = 1)::DOUBLE / sum(c) AS m
              FROM (SELECT count(*) AS c FROM orders GROUP BY o_orderkey)),
             (VALUES ('sizes'), ('values')) v(n)""",
)
def _many(spark, d):
    results = evaluate_many(table(spark, d, "orders"), _RULESETS)
    return results.select("ruleset_name", *judged(results).columns).withColumn(
        "metric", F.round("metric", 6)
    )


@_R.query(
    "r09_evaluate_batch",
    """SELECT 'orders.parquet' AS table_name, 0 AS rule_no, count(*)::DOUBLE AS metric,
        CASE WHEN count(*) >= 10 THEN 'PASS' ELSE 'FAIL' END AS result FROM orders
    UNION ALL SELECT 'customer.parquet', 0, min(c_acctbal), 'FAIL' FROM customer
    UNION ALL SELECT 'customer.parquet', 1, 1.0, 'PASS'
    UNION ALL SELECT 'missing.parquet', NULL, NULL, 'WARNING'""",
)
def _batch(spark, d):
    """Three tables of a batch, one of which has no data."""
    items = [
        with_defaults({"ObjectId": "orders.parquet"}, d, ""),
        with_defaults({"ObjectId": "missing.parquet"}, d, ""),
        with_defaults({"ObjectId": "customer.parquet", "RulesetNames": ["people"]}, d, ""),
    ]
    rulesets = rulesets_frame(
        spark,
        {
            "orders.parquet_generated": "HasSize >= 10",
            "missing.parquet_generated": "HasSize >= 10",
            "people": 'HasMin "c_acctbal" >= 0, IsComplete "c_name"',
            "unused": "HasSize = 0",
        },
    )
    results = evaluate_batch(items, rulesets, lambda source: read_source(spark, source))
    return results.select("table_name", *judged(results).columns)


_TWO_BY = """WITH m AS (SELECT *, strftime(o_orderdate, '%Y-%m') AS month FROM orders),
    other AS (SELECT * FROM m WHERE o_orderkey % 5 <> 0),
    g AS (SELECT month, count(*)::DOUBLE AS n, count(DISTINCT o_orderpriority)::DOUBLE AS bins,
        avg((o_orderstatus = 'F')::INT) AS f, avg((o_custkey IN (SELECT c_custkey FROM customer))::INT) AS known,
        max(o_totalprice) AS top FROM m GROUP BY month),
    o AS (SELECT month, count(*) AS n FROM other GROUP BY month)"""


@_R.query(
    "r10_by_two_tables",
    f"""{_TWO_BY} SELECT month, rule_no, round(metric, 6) AS metric FROM (
    SELECT month, 0 AS rule_no, bins AS metric FROM g UNION ALL SELECT month, 1, f FROM g
    UNION ALL SELECT month, 2, known FROM g
    UNION ALL SELECT month, 3, n / (SELECT count(*) FROM customer) FROM g
    UNION ALL SELECT month, 4, top / (SELECT max(o_totalprice) FROM orders) FROM g
    UNION ALL SELECT g.month, 5, CASE WHEN o.n IS NULL THEN NULL ELSE 1.0 END FROM g LEFT JOIN o USING (month)
    UNION ALL SELECT month, 6, 1.0 FROM g)""",
)
def _two_tables_by_month(spark, d):
    """Histograms and comparisons of two tables for every month on its own."""
    orders = table(spark, d, "orders").withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    rules = [
        'HasHistogramValues "o_orderpriority" = 5',
        'HasHistogramValues "o_orderstatus" "F" > 0.1',
        'ReferentialIntegrity "o_custkey" "customer.c_custkey"',
        'RowCountMatch "customer" > 0',
        'AggregateMatch "max(o_totalprice)" "orders" "max(o_totalprice)" > 0.5',
        'DatasetMatch "fewer" "o_orderkey" "o_totalprice,o_orderstatus" = 1',
        'SchemaMatch "orders" = 1',
    ]
    others = {
        "customer": table(spark, d, "customer"),
        "orders": table(spark, d, "orders"),
        "fewer": orders.where("o_orderkey % 5 <> 0"),
    }
    results = evaluate(orders, rules, by=["month"], references=others)
    return results.select("month", "rule_no", F.round("metric", 6).alias("metric"))


@_R.query(
    "r10_evaluate_by",
    """WITH g AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, o_custkey, count(*) AS c FROM orders GROUP BY ALL),
    u AS (SELECT month, count(*) FILTER (WHERE c = 1)::DOUBLE / sum(c) AS m FROM g GROUP BY month),
    s AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*)::DOUBLE AS n, min(o_totalprice) AS low,
        avg((o_orderstatus IN ('F','O'))::INT) AS fo FROM orders GROUP BY 1)
    SELECT month, 0 AS rule_no, n AS metric, CASE WHEN n >= 150 THEN 'PASS' ELSE 'FAIL' END AS result FROM s
    UNION ALL SELECT month, 1, low, CASE WHEN low > 2000 THEN 'PASS' ELSE 'FAIL' END FROM s
    UNION ALL SELECT month, 2, round(fo, 6), CASE WHEN fo >= 0.65 THEN 'PASS' ELSE 'FAIL' END FROM s
    UNION ALL SELECT month, 3, round(m, 6), CASE WHEN m = 1 THEN 'PASS' ELSE 'FAIL' END FROM u""",
)
def _by_month(spark, d):
    """Every month judged on its own, all in one job."""
    orders = table(spark, d, "orders")
    monthly = orders.withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    rules = [
        "HasSize >= 150",
        'HasMin "o_totalprice" > 2000',
        'IsContainedIn "o_orderstatus" in ["F","O"] with threshold >= 0.65',
        'IsUnique "o_custkey"',
    ]
    results = evaluate(monthly, rules, by=["month"])
    return results.select("month", *judged(results).columns).withColumn(
        "metric", F.round("metric", 6)
    )


@_R.query("r11_evaluate_arriving", SLICE_SQL)
def _arriving(spark, d):
    """The flagship rules on a stream of files; a second run finds nothing new."""
    base = scratch_path(spark, "arriving")
    lines = table(spark, d, "lineitem")
    lines.write.parquet(f"{base}/in")
    for _ in range(2):
        evaluate_arriving(
            spark, f"{base}/in", lines.schema, SLICE, f"{base}/out", f"{base}/checkpoint"
        ).awaitTermination()
    results = spark.read.parquet(f"{base}/out")
    return results.select("rule_no", "rule_type", F.round("metric", 6).alias("metric"), "result")


# Rules whose metrics need all files: keys that files share, totals and moments.
_SO_FAR = [
    'IsUnique "l_orderkey"',
    'HasUniqueness "l_orderkey" "l_linenumber" > 0.5',
    'HasDistinctness "l_partkey" > 0.5',
    'HasEntropy "l_returnflag" > 1',
    'IsPrimaryKey "l_orderkey" "l_linenumber" "l_suppkey"',
    "HasSize > 1000",
    'HasSum "l_quantity" > 0',
    'HasMean "l_extendedprice" > 0',
    'HasStandardDeviation "l_extendedprice" > 0',
    'HasCorrelation "l_quantity" "l_extendedprice" > 0.5',
    'IsContainedIn "l_returnflag" in ["A","N"] with threshold >= 0.6',
    'HasMax "l_tax" <= 0.08',
]
_SIZES_SQL = "(SELECT count(*) AS n FROM lineitem GROUP BY {keys})"
_SO_FAR_SQL = "\nUNION ALL\n".join(
    f"SELECT {i} AS rule_no, round(m, 6) AS metric, CASE WHEN m {demand} THEN 'PASS' ELSE 'FAIL' END AS result "
    f"FROM (SELECT CAST({metric} AS DOUBLE) AS m FROM {source})"
    for i, (metric, demand, source) in enumerate(
        [
            ("sum(n) FILTER (WHERE n = 1) / sum(n)", "= 1", _SIZES_SQL.format(keys="l_orderkey")),
            ("sum(n) FILTER (WHERE n = 1) / sum(n)", "> 0.5", _SIZES_SQL.format(keys="l_orderkey, l_linenumber")),
            ("count(*) / sum(n)", "> 0.5", _SIZES_SQL.format(keys="l_partkey")),
            ("ln(sum(n)) - sum(n * ln(n)) / sum(n)", "> 1", _SIZES_SQL.format(keys="l_returnflag")),
            ("sum(n) FILTER (WHERE n = 1) / sum(n)", "= 1", _SIZES_SQL.format(keys="l_orderkey, l_linenumber, l_suppkey")),
            ("count(*)", "> 1000", "lineitem"),
            ("sum(l_quantity)", "> 0", "lineitem"),
            ("avg(l_extendedprice)", "> 0", "lineitem"),
            ("stddev_pop(l_extendedprice)", "> 0", "lineitem"),
            ("corr(l_quantity, l_extendedprice)", "> 0.5", "lineitem"),
            ("avg((l_returnflag IN ('A', 'N'))::INT)", ">= 0.6", "lineitem"),
            ("max(l_tax)", "<= 0.08", "lineitem"),
        ]
    )
)


# Rows that one arriving file holds, about (hashed), so that no task writes a share of the table that grows with it.
_ROWS_PER_FILE = 1_000_000


@_R.query("r11_all_arrived", _SO_FAR_SQL)
def _all_arrived(spark, d):
    """Arrivals that share their keys come one by one, the last after a restart; judged over all of them.

    An arrival and micro-batch is the rows of one ``l_linenumber % 3``, in as many files as ``_ROWS_PER_FILE`` asks for.
    """
    base = scratch_path(spark, "so-far")
    lines = table(spark, d, "lineitem")
    file = F.expr("l_linenumber % 3")
    sizes = {r["f"]: r["count"] for r in lines.groupBy(file.alias("f")).count().collect() if r["f"] is not None}
    pieces = max(1, -(-max(sizes.values(), default=0) // _ROWS_PER_FILE))
    for arrival, values in (("l_linenumber % 3 < 2", sorted(v for v in sizes if v < 2)), ("l_linenumber % 3 = 2", [2])):
        for value in [v for v in values if v in sizes] or [None]:  # an arrival of no rows writes its empty file
            own = lines.where(arrival) if value is None else lines.where(file == value)
            own.repartition(pieces, "l_orderkey", "l_linenumber").write.mode("append").parquet(f"{base}/in")
        evaluate_arriving(
            spark, f"{base}/in", lines.schema, _SO_FAR, f"{base}/out", f"{base}/checkpoint",
            state_path=f"{base}/state", max_files=pieces,
        ).awaitTermination()
    results = spark.read.parquet(f"{base}/out")
    newest = results.where(F.col("batch_id") == results.agg(F.max("batch_id")).scalar())
    return judged(newest)


@_R.query(
    "r10_merged_by_month",
    """SELECT month, i AS rule_no, round([count(*), avg(o_totalprice), stddev_pop(o_totalprice),
        count(*) FILTER (WHERE o_orderstatus = 'F') / count(*)][i + 1], 4) AS metric
    FROM (SELECT *, date_trunc('month', o_orderdate)::DATE AS month FROM orders), range(4) r(i) GROUP BY month, i""",
)
def _merged(spark, d):
    """States of parts of the orders, taken one after the other, merged by month."""
    path = scratch_path(spark, "merged")
    orders = table(spark, d, "orders").withColumn("month", F.trunc("o_orderdate", "month"))
    rules = [
        "HasSize > 0", 'HasMean "o_totalprice" > 0', 'HasStandardDeviation "o_totalprice" > 0',
        'IsContainedIn "o_orderstatus" in ["F"] with threshold >= 0',
    ]
    for part in range(3):
        results = evaluate_so_far(orders.where(F.col("o_custkey") % 3 == part), rules, path, part, by=["month"])
    return results.select("month", "rule_no", F.round("metric", 4).alias("metric"))


@_R.query(
    "r10_merged_sketches",
    """SELECT * FROM (VALUES (0, true), (1, true), (2, true), (3, true)) v(rule_no, within)""",
)
def _merged_sketches(spark, d):
    """Sketches of parts of the line items merged: distinct values and ranks within the sketches' bounds."""
    path = scratch_path(spark, "merged-sketches")
    lines = table(spark, d, "lineitem")
    rules = [
        'HasApproxCountDistinct "l_orderkey" > 0', 'HasApproxCountDistinct "l_partkey" > 0',
        'KllSketchSatisfies "l_extendedprice" "0.5" > 0', 'HasApproxQuantile "l_extendedprice" "0.9" > 0',
    ]
    for part in range(3):
        results = evaluate_so_far(lines.where(F.col("l_suppkey") % 3 == part), rules, path, part)
    exact = lines.agg(F.count_distinct("l_orderkey"), F.count_distinct("l_partkey"), F.count(F.lit(1))).first()
    found = {r.rule_no: r.metric for r in results.collect()}  # a row per rule
    ranks = lines.agg(*[F.count_if(F.col("l_extendedprice") <= found[i]) / exact[2] for i in (2, 3)]).first()
    within = [
        *[abs(found[i] - exact[i]) <= 3 * 0.05 * exact[i] for i in (0, 1)],
        *[abs(r - q) <= 0.01 for r, q in zip(ranks, (0.5, 0.9))],
    ]
    return spark.createDataFrame(list(enumerate(within)), "rule_no int, within boolean")


_R.add(
    "r12_check_status",
    lambda spark, d: S.check_status(
        evaluate_many(
            table(spark, d, "orders"),
            {**_RULESETS, "easy": 'IsComplete "o_orderkey", HasSize > 0, HasColour = 1'},
        )
    ),
    """SELECT 'easy' AS ruleset_name, CASE WHEN count(o_orderkey) = count(*) AND count(*) > 0
        THEN 'Success' ELSE 'Error' END AS status FROM orders
    UNION ALL SELECT 'values', 'Error'
    UNION ALL SELECT 'sizes', CASE WHEN count(*) >= 1000 AND min(o_totalprice) > 0
        AND count(DISTINCT o_orderkey) = count(*) THEN 'Success' ELSE 'Error' END FROM orders""",
)


_R.add(
    "r12_check_results",
    lambda spark, d: S.check_results(_mixed(spark, d)).select(
        "check", "check_level", "check_status", "constraint_status"
    ),
    f"""SELECT 'mixed' AS "check", 'Error' AS check_level, 'Error' AS check_status,
    CASE result WHEN 'PASS' THEN 'Success' ELSE 'Failure' END AS constraint_status
    FROM {_MIXED_SQL} WHERE result <> 'SKIP'""",
)


@_R.query(
    "s12_flatten",
    f"""SELECT 'Rule_' || rule_no AS "Name", result AS "Result", rule_type AS kind, 'lineitem' AS table_name
    FROM ({SLICE_SQL})""",
)
def _flatten(spark, d):
    """Nested result records of the flagship rules, flat again."""
    results = evaluate(table(spark, d, "lineitem"), SLICE, name="lineitem")
    moment = datetime(2024, 1, 31)
    records = S.result_records(results, "run-1", {"Path": d}, moment, moment)
    flat = S.flat_results(records, "lineitem")
    return flat.select("Name", "Result", F.split("dqdl_rule", " ")[0].alias("kind"), "table_name")
