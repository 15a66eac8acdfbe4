"""Profiles, suggestions, recommended rulesets, and the loop back to evaluation."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from plumbline.functions.columns import is_flat, share
from plumbline.gallery.common import LABELLED, Registry, labelled, table
from plumbline.operators.keys import suggested_keys
from plumbline.operators.profile import counted_values, heavy_hitters, histograms, profile, value_counts
from plumbline.operators.quantiles import exact_quantiles
from plumbline.operators.suggest import (
    recommend,
    suggest,
    suggest_unique,
    suggested_values,
    value_sets,
)
from plumbline.plans.evaluate import evaluate

_R = Registry()
QUERIES, ORACLES = _R.queries, _R.oracles


def _each(columns, line: str) -> str:
    return "\nUNION ALL\n".join(line.format(c=c) for c in columns)


def _part_texts(spark, d):
    part = table(spark, d, "part")
    return part.select(*[F.col(c).cast("string").alias(c) for c in part.columns])


_R.add(
    "p01_completeness",
    lambda spark, d: profile(labelled(spark, d)).select(
        "column_name", "rows", "cells", F.round("completeness", 6).alias("completeness")
    ),
    _each(
        ("doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"),
        "SELECT '{c}' AS column_name, count(*) AS rows, count({c}) AS cells, "
        f"round(count({{c}})::DOUBLE / count(*), 6) AS completeness FROM {LABELLED}",
    ),
)


@_R.query(
    "p02_approx_distinct",
    _each(
        ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"),
        "SELECT '{c}' AS column_name, count(DISTINCT {c}) AS exact, true AS within_bound FROM customer",
    ),
)
def _approx_distinct(spark, d):
    customer = table(spark, d, "customer")
    both = profile(customer, counted=customer.columns).select(
        "column_name", "approx_distinct", F.col("distinct").alias("exact")
    )
    near = F.abs(F.col("approx_distinct") - F.col("exact")) <= 3 * 0.05 * F.col("exact") + 1
    return both.select("column_name", "exact", near.alias("within_bound"))


_INTEGRAL = r"regexp_full_match({c}::VARCHAR, '[+-]?\d+')"
_FRACTIONAL = r"regexp_full_match({c}::VARCHAR, '[+-]?(\d+\.\d*|\.\d+)')"
_R.add(
    "p03_inferred_type",
    lambda spark, d: profile(_part_texts(spark, d)).select(
        "column_name",
        "data_type",
        "is_data_type_inferred",
        F.col("type_counts")["Integral"].alias("integral"),
        F.col("type_counts")["Fractional"].alias("fractional"),
        F.col("type_counts")["String"].alias("text"),
    ),
    _each(
        ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"),
        "SELECT '{c}' AS column_name, CASE WHEN integral = n THEN 'Integral' WHEN integral + fractional = n "
        "THEN 'Fractional' ELSE 'String' END AS data_type, integral + fractional = n AS is_data_type_inferred, "
        "integral, fractional, n - integral - fractional AS text FROM (SELECT count(*) AS n, "
        f"count(*) FILTER (WHERE {_INTEGRAL}) AS integral, "
        f"count(*) FILTER (WHERE {_FRACTIONAL}) AS fractional FROM part)",
    ),
)
_R.add(
    "p04_profile_type",
    lambda spark, d: profile(table(spark, d, "orders")).select(
        "column_name", "profile_type", (F.col("rows") > 0).alias("filled")
    ),
    "SELECT column_name, CASE WHEN column_type IN ('BIGINT', 'INTEGER', 'DOUBLE') THEN 'Numeric' "
    "ELSE 'Standard' END AS profile_type, true AS filled FROM (DESCRIBE SELECT * FROM orders)",
)
_R.add(
    "p05_numeric_statistics",
    lambda spark, d: profile(table(spark, d, "lineitem")).where("profile_type = 'Numeric'").select(
        "column_name",
        "minimum",
        "maximum",
        F.round("mean", 4).alias("mean"),
        F.round("sum", 2).alias("sum"),
        F.round("std_dev", 4).alias("std_dev"),
    ),
    _each(
        (
            "l_orderkey",
            "l_partkey",
            "l_suppkey",
            "l_linenumber",
            "l_quantity",
            "l_extendedprice",
            "l_discount",
            "l_tax",
        ),
        "SELECT '{c}' AS column_name, min({c})::DOUBLE AS minimum, max({c})::DOUBLE AS maximum, "
        "round(avg({c}), 4) AS mean, sum({c}::DECIMAL(18,2))::DOUBLE AS sum, "
        "round(stddev_pop({c}), 4) AS std_dev FROM lineitem",
    ),
)


_R.add(
    "p05_numbers_beyond_64_bits",
    lambda spark, d: profile(
        table(spark, d, "orders").select((F.col("o_orderkey").cast("decimal(38,0)") * F.lit(1 << 40)).alias("h"))
    ).select("column_name", "sum", "minimum"),
    "SELECT 'h' AS column_name, sum(o_orderkey::HUGEINT * 1099511627776)::DOUBLE AS sum, "
    "min(o_orderkey * 1099511627776)::DOUBLE AS minimum FROM orders",
)


@_R.query(
    "p06_approx_percentiles",
    _each(
        ("25", "50", "75", "90"),
        "SELECT {c} AS percentile, count(*) AS n, true AS within_bound FROM orders",
    ),
)
def _percentiles(spark, d):
    """Whether profiled percentiles have the rank they stand for, to within two points."""
    orders = table(spark, d, "orders")
    found = profile(orders).where("column_name = 'o_totalprice'").select("approx_percentiles")
    price, marks = F.col("o_totalprice"), (25, 50, 75, 90)
    ranks = [
        F.struct(
            F.lit(p).alias("percentile"),
            F.count(F.lit(1)).alias("n"),
            share(price <= found.scalar()[p - 1]).alias("rank"),
        )
        for p in marks
    ]
    rows = orders.agg(F.array(*ranks).alias("r")).select(F.inline("r"))
    near = F.abs(F.col("rank") - F.col("percentile") / 100) <= 0.02
    return rows.select("percentile", "n", near.alias("within_bound"))


_SHARES = [i / 20 for i in range(21)]
# A third of the rows have one price.
_HOT = "CASE WHEN o_orderkey % 3 = 0 THEN 1000.0::DOUBLE ELSE o_totalprice END"


@_R.query(
    "p06_exact_percentiles",
    "\nUNION ALL\n".join(
        f"SELECT '{name}' AS column_name, {q}::DOUBLE AS share, quantile_disc({sql}, {q})::DOUBLE AS value FROM orders"
        for name, sql in (("price", "o_totalprice"), ("hot", _HOT), ("key", "o_custkey"))
        for q in _SHARES
    ),
)
def _exact_percentiles(spark, d):
    orders = table(spark, d, "orders").select(
        F.col("o_totalprice").alias("price"),
        F.when(F.col("o_orderkey") % 3 == 0, 1000.0).otherwise(F.col("o_totalprice")).alias("hot"),
        F.col("o_custkey").alias("key"),
    )
    found = [
        (c, q, float(v)) for c in orders.columns for q, v in zip(_SHARES, exact_quantiles(orders, c, _SHARES))
    ]  # a row per column and share
    return spark.createDataFrame(found, "column_name string, share double, value double")


_LINE_COLUMNS = (
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
)
def _every_bin(df):
    """Every bin of every column, however many values it has (F4: no cap on the columns)."""
    return histograms(df, [f.name for f in df.schema if is_flat(f.dataType)])


_R.add(
    "p07_histograms",
    lambda spark, d: _every_bin(table(spark, d, "lineitem")).select(
        "column_name", "value", "count", F.round("ratio", 6).alias("ratio")
    ),
    _each(
        _LINE_COLUMNS,
        "SELECT '{c}' AS column_name, {c}::VARCHAR AS value, count(*) AS count, "
        "round(count(*)::DOUBLE / (SELECT count(*) FROM lineitem), 6) AS ratio FROM lineitem GROUP BY {c}",
    ),
)
_R.add(
    "p07_named_histograms",
    lambda spark, d: histograms(table(spark, d, "lineitem"), _LINE_COLUMNS).select(
        "column_name", "value", "count", F.round("ratio", 6).alias("ratio")
    ),
    _each(
        _LINE_COLUMNS,
        "SELECT '{c}' AS column_name, {c}::VARCHAR AS value, count(*) AS count, "
        "round(count(*)::DOUBLE / (SELECT count(*) FROM lineitem), 6) AS ratio FROM lineitem GROUP BY {c}",
    ),
)
_R.add(
    "p07_heavy_hitters",
    lambda spark, d: heavy_hitters(
        table(spark, d, "lineitem").withColumn("hot", F.when(F.col("l_orderkey") % 3 == 0, 7).otherwise(F.col("l_orderkey"))), 0.005
    ).select("column_name", "value", "count", F.round("ratio", 6).alias("ratio")),
    _each(
        (*(c for c in _LINE_COLUMNS if c != "l_shipdate"), "hot"),
        "SELECT '{c}' AS column_name, {c}::VARCHAR AS value, count(*) AS count, round(count(*) / any_value(t), 6) AS ratio FROM "
        "(SELECT *, CASE WHEN l_orderkey % 3 = 0 THEN 7 ELSE l_orderkey END AS hot, count(*) OVER () AS t FROM lineitem) "
        "GROUP BY {c} HAVING count(*) >= 0.005 * any_value(t)",
    ),
)
_R.add(
    "p07_distinct",
    lambda spark, d: profile(table(spark, d, "documents"), counted=("text", "lang", "source")).select(
        "column_name", "is_counted", "distinct"
    ),
    _each(
        ("text", "lang", "source"),
        "SELECT '{c}' AS column_name, true AS is_counted, count(DISTINCT {c}) AS distinct FROM documents",
    )
    + "\nUNION ALL\n"
    + _each(("doc_id", "n_chars"), "SELECT '{c}', false, NULL"),
)
_R.add(
    "p08_profile_rows",
    lambda spark, d: profile(table(spark, d, "events")).select(
        "column_name", "profile_type", "data_type", "rows"
    ),
    """SELECT column_name, CASE WHEN column_type IN ('BIGINT', 'INTEGER', 'DOUBLE') THEN 'Numeric' ELSE 'Standard' END
        AS profile_type, CASE column_type WHEN 'BIGINT' THEN 'Integral' WHEN 'DOUBLE' THEN 'Fractional'
        WHEN 'VARCHAR' THEN 'String' ELSE 'Unknown' END AS data_type, (SELECT count(*) FROM events) AS rows
    FROM (DESCRIBE SELECT * FROM events) ORDER BY column_name""",
)


def _found(df, columns=None):
    """Suggestions with those about the values of columns of few values, or of the named ones, and these values."""
    profiled = profile(df)
    counts = counted_values(df, profiled) if columns is None else value_counts(df, columns)
    return suggest(profiled, counts), suggested_values(profiled, counts)


def _suggested(source, rule: str):
    def query(spark, d):
        df = source(spark, d) if callable(source) else table(spark, d, source)
        found, _ = _found(df)
        return found.where(F.col("suggesting_rule") == rule).select("column_name", "dqdl_rule")

    return query


def _valued(source, rule: str, columns=None):
    """Rule text and value of every row that a suggestion about values consists of."""

    def query(spark, d):
        found, values = _found(source(spark, d) if callable(source) else table(spark, d, source), columns)
        rules = found.select("column_name", "suggesting_rule", "dqdl_rule")
        rows = values.where(F.col("suggesting_rule") == rule)
        return rows.join(rules, ["column_name", "suggesting_rule"]).select(
            "column_name", "dqdl_rule", "value", "count"
        )

    return query


_ORDER_COLUMNS = (
    "o_orderkey",
    "o_custkey",
    "o_orderstatus",
    "o_totalprice",
    "o_orderdate",
    "o_orderpriority",
)
_COMPLETE_SQL = _each(
    _ORDER_COLUMNS,
    "SELECT '{c}' AS column_name, 'IsComplete \"{c}\"' AS dqdl_rule FROM orders HAVING count({c}) = count(*)",
)
_NON_NEGATIVE_SQL = _each(
    ("o_orderkey", "o_custkey", "o_totalprice"),
    "SELECT '{c}' AS column_name, 'IsNonNegative \"{c}\"' AS dqdl_rule FROM orders HAVING min({c}) >= 0",
)
_LISTED = """string_agg('"' || {v} || '"', ',' ORDER BY n DESC, {v})"""
_CATEGORY = (
    "SELECT '{c}' AS column_name, 'IsContainedIn \"{c}\" in [' || " + _LISTED.replace("{v}", "{c}") + " || ']' AS dqdl_rule "
    "FROM (SELECT {c}, count(*) AS n FROM %s GROUP BY {c}) HAVING count(*) <= 0.1 * sum(n)"
)
_CATEGORY_SQL = _each(("o_orderstatus", "o_orderpriority"), _CATEGORY % "orders")
_CATEGORY_VALUES_SQL = _each(
    ("o_orderstatus", "o_orderpriority"),
    "SELECT v.*, value, count FROM (%s) v, (SELECT {c} AS value, count(*) AS count FROM orders GROUP BY {c})"
    % (_CATEGORY % "orders"),
)
# The values before the share of 0.9 is reached, and those of the same count as the last of them.
_TOP = (
    "SELECT {c} AS value, n, t, k, n >= min(n) FILTER (before < 0.9::DOUBLE * t) OVER () AS top FROM ("
    "SELECT {c}, n, coalesce(sum(n) OVER (ORDER BY n DESC RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) "
    "AS before, sum(n) OVER () AS t, count(*) OVER () AS k FROM "
    "(SELECT {c}, count(*) AS n FROM documents WHERE {c} IS NOT NULL GROUP BY {c}))"
)
_BOUND = "printf('%.2f', floor((p - 1.96 * sqrt(p * (1 - p) / t)) * 100) / 100)"
_TOP_SQL = (
    "SELECT '{c}' AS column_name, CASE WHEN kept <= 120 THEN 'IsContainedIn \"{c}\" in [' || listed || '] with threshold >= ' "
    "ELSE 'ReferentialIntegrity \"{c}\" \"top values of {c}.value\" >= ' END || "
    f"{_BOUND} AS dqdl_rule FROM ("
    "SELECT sum(n) FILTER (top)::DOUBLE / any_value(t) AS p, any_value(t) AS t, count(*) FILTER (top) AS kept, "
    "string_agg('\"' || value || '\"', ',' ORDER BY n DESC, value) FILTER (top) AS listed, "
    f"any_value(k) AS k FROM ({_TOP})) WHERE kept < k"
)


def _initials(spark, d):
    """Documents with the first letter of their text, some of which are rare."""
    return table(spark, d, "documents").withColumn("initial", F.substring("text", 1, 1))


_TOP_VALUES = f"SELECT r.*, value, n AS count FROM ({_TOP_SQL}) r, ({_TOP}) WHERE top"
_TOP_VALUES_SQL = _each(("text", "lang", "source", "initial"), _TOP_VALUES).replace("FROM documents", "FROM (SELECT *, substr(text, 1, 1) AS initial FROM documents)")

_R.add("g01_complete_if_complete", _suggested("orders", "CompleteIfCompleteRule"), _COMPLETE_SQL)
_R.add(
    "g02_retain_completeness",
    _suggested(labelled, "RetainCompletenessRule"),
    _each(
        ("quality", "toxic"),
        "SELECT '{c}' AS column_name, 'HasCompleteness \"{c}\" >= ' || printf('%.2f', "
        "floor((p - 1.96 * sqrt(p * (1 - p) / n)) * 100) / 100) AS dqdl_rule FROM ("
        f"SELECT count({{c}})::DOUBLE / count(*) AS p, count(*) AS n FROM {LABELLED}) WHERE p > 0.2 AND p < 1",
    ),
)
_R.add(
    "g03_retain_type",
    _suggested(_part_texts, "RetainTypeRule"),
    _each(
        ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"),
        "SELECT '{c}' AS column_name, 'HasDataType \"{c}\" = \"' || CASE WHEN integral = n THEN 'Integral' "
        "ELSE 'Fractional' END || '\"' AS dqdl_rule FROM (SELECT count(*) AS n, "
        f"count(*) FILTER (WHERE {_INTEGRAL}) AS integral, "
        f"count(*) FILTER (WHERE {_FRACTIONAL}) AS fractional FROM part) WHERE integral + fractional = n",
    ),
)
_R.add("g04_categorical_range", _valued("orders", "CategoricalRangeRule"), _CATEGORY_VALUES_SQL)
_R.add(
    "g05_fractional_categorical_range",
    _valued(_initials, "FractionalCategoricalRangeRule", ["text", "lang", "source", "initial"]),
    _TOP_VALUES_SQL,
)
_R.add(
    "g05_top_values_by_name",
    _valued(
        lambda spark, d: table(spark, d, "lineitem").withColumn("day", F.date_format("l_shipdate", "yyyy-MM-dd")),
        "FractionalCategoricalRangeRule",
        ["day"],
    ),
    _each(("day",), _TOP_VALUES).replace(
        "FROM documents", "FROM (SELECT strftime(l_shipdate, '%Y-%m-%d') AS day FROM lineitem)"
    ),
)
_R.add("g06_non_negative", _suggested("orders", "NonNegativeNumbersRule"), _NON_NEGATIVE_SQL)


@_R.query(
    "g07_unique_if_unique",
    _each(
        _ORDER_COLUMNS,
        "SELECT '{c}' AS column_name, 'IsUnique \"{c}\"' AS dqdl_rule FROM orders "
        "HAVING count(DISTINCT {c}) = count(*)",
    ),
)
def _unique(spark, d):
    orders = table(spark, d, "orders")
    return suggest_unique(orders, profile(orders)).select("column_name", "dqdl_rule")


def _keys_sql(name: str, columns, most: int) -> str:
    """Every set of up to ``most`` columns tried; keys without a smaller one inside."""
    tried = "\nUNION ALL\n".join(
        f"SELECT [{', '.join(repr(c) for c in s)}] AS cols, (SELECT count(*) = count(DISTINCT ({', '.join(s)},)) FROM {name}) AS is_key"
        for width in range(1, most + 1)
        for s in combinations(columns, width)
    ).replace(",))", "))")
    return f"""WITH k AS MATERIALIZED (SELECT cols FROM ({tried}) WHERE is_key)
        SELECT '{name}' AS table_name, 'IsPrimaryKey "' || array_to_string(cols, '" "') || '"' AS dqdl_rule, len(cols)::INT AS width
        FROM k WHERE NOT EXISTS (SELECT 1 FROM k AS small WHERE len(small.cols) < len(k.cols) AND list_has_all(k.cols, small.cols))"""


@_R.query(
    "g07_minimal_keys",
    f"SELECT * FROM ({_keys_sql('orders', _ORDER_COLUMNS, 3)}) UNION ALL SELECT * FROM ({_keys_sql('lineitem', _LINE_COLUMNS, 3)})",
)
def _minimal_keys(spark, d):
    """The smallest keys of the orders (one column) and the line items (sets of columns)."""
    parts = [
        suggested_keys(table(spark, d, t)).select(F.lit(t).alias("table_name"), "dqdl_rule", "width")
        for t in ("orders", "lineitem")
    ]
    return parts[0].unionByName(parts[1])


# Of the orders, no value is so rare that a few cover nine tenths of a column of texts.
_ORDER_TOP_SQL = _each(
    ("o_orderstatus", "o_orderpriority"),
    f"SELECT column_name, dqdl_rule FROM ({_TOP_SQL.replace('documents', 'orders')})",
)


ORDER_SUGGESTIONS_SQL = f"""SELECT column_name, 'CompleteIfCompleteRule' AS suggesting_rule, dqdl_rule FROM ({_COMPLETE_SQL})
    UNION ALL SELECT column_name, 'NonNegativeNumbersRule', dqdl_rule FROM ({_NON_NEGATIVE_SQL})
    UNION ALL SELECT column_name, 'CategoricalRangeRule', dqdl_rule FROM ({_CATEGORY_SQL})
    UNION ALL SELECT column_name, 'FractionalCategoricalRangeRule', dqdl_rule FROM ({_ORDER_TOP_SQL})"""


def _order_suggestions(spark, d):
    return _found(table(spark, d, "orders"))[0]


_R.add(
    "g08_rule_text",
    lambda spark, d: _order_suggestions(spark, d).select("suggesting_rule", "dqdl_rule"),
    f"SELECT suggesting_rule, dqdl_rule FROM ({ORDER_SUGGESTIONS_SQL})",
)
_R.add(
    "g09_sorted_suggestions",
    lambda spark, d: _order_suggestions(spark, d).select(
        "column_name", "suggesting_rule", "dqdl_rule"
    ),
    f"SELECT column_name, suggesting_rule, dqdl_rule FROM ({ORDER_SUGGESTIONS_SQL}) ORDER BY 1, 2",
)


@_R.query(
    "g10_recommend",
    f"""SELECT 'orders_generated' AS "Name",
    string_agg(dqdl_rule, ', ' || chr(10) ORDER BY column_name, suggesting_rule) AS "Ruleset",
    'run-1' AS run_id, 'orders' AS table_name FROM ({ORDER_SUGGESTIONS_SQL})""",
)
def _recommend(spark, d):
    found = _order_suggestions(spark, d).withColumn("table_name", F.lit("orders"))
    return recommend(found, "run-1", {"Path": d}).select(
        "Name",
        "Ruleset",
        F.col("Tags")["SuggestionRunId"].alias("run_id"),
        F.col("TargetTable")["TableName"].alias("table_name"),
    )


@_R.query(
    "g_suggest_then_evaluate",
    f"""SELECT suggesting_rule, count(*) AS rules, count(*) AS met FROM (
    {ORDER_SUGGESTIONS_SQL}) GROUP BY suggesting_rule""",
)
def _closed_loop(spark, d):
    """Rules recommended for a table hold on that table."""
    orders = table(spark, d, "orders")
    found, values = _found(orders)
    suggestions = found.withColumn("table_name", F.lit("orders"))
    results = evaluate(orders, recommend(suggestions), references=value_sets(found, values))
    return (
        results.join(suggestions, results.rule_text == suggestions.dqdl_rule)
        .groupBy("suggesting_rule")
        .agg(F.count(F.lit(1)).alias("rules"), F.count_if(F.col("result") == "PASS").alias("met"))
    )
