"""Constraints suggested by a profile, and the rulesets made of them.

Most heuristics are expressions on a profile row. Those about the values of a column read the
counts of its values (``profile.counted_values``). Up to ``MAX_LISTED`` values stand in the rule's text, which
then means the same anywhere; more are rows of a table (``suggested_values``), to which the text
refers by name.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from plumbline.functions.columns import compact_key, ref
from plumbline.functions.rows import rows_frame
from plumbline.operators import grouped as G
from plumbline.operators.profile import RSD

# Thresholds of the heuristics.
MIN_COMPLETENESS = 0.2
MAX_CATEGORY_RATIO = 0.1
TARGET_COVERAGE = 0.9
Z = 1.96
# Values, and characters of all of them, that a rule's text lists; lists with line breaks are kept as rows too.
MAX_LISTED, MAX_TEXT = 120, 20_000

# Columns of a suggestion.
SUGGESTION = (
    "column_name",
    "constraint_name",
    "current_value",
    "suggesting_rule",
    "code_for_constraint",
    "dqdl_rule",
)


def quoted(text: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))


# Rules about values, and what their tables of values are called.
ALL_VALUES, TOP_VALUES = "CategoricalRangeRule", "FractionalCategoricalRangeRule"
SETS = {ALL_VALUES: "values of ", TOP_VALUES: "top values of "}
# How a rule begins whose values are rows.
BY_NAME = "ReferentialIntegrity"


def set_name(column: str, rule: str) -> str:
    """Name by which a rule's text refers to its values; a dot would end it."""
    return SETS[rule] + column.replace(".", "_")


def lower_bound(p: Column, n: Column) -> Column:
    """Lower end of the 95% interval of a share, rounded down to two places."""
    low = F.floor((p - Z * F.sqrt(p * (1 - p) / n)) * 100) / 100
    return F.greatest(low, F.lit(0.0))


def _number(value: Column) -> Column:
    return value.cast("decimal(10,2)").cast("string")


def _suggestion(kind: str, rule: str, value: Column, code: Column, text: Column) -> Column:
    return F.struct(
        F.lit(kind).alias("constraint_name"),
        value.cast("string").alias("current_value"),
        F.lit(rule).alias("suggesting_rule"),
        code.alias("code_for_constraint"),
        text.alias("dqdl_rule"),
    )


def _heuristics() -> list[Column]:
    name = quoted(F.col("column_name"))
    p, n, cells = F.col("completeness"), F.col("rows"), F.col("cells")

    complete = F.when(
        p == 1.0,
        _suggestion(
            "Completeness",
            "CompleteIfCompleteRule",
            p,
            F.format_string(".isComplete(%s)", name),
            F.format_string("IsComplete %s", name),
        ),
    )
    bound = _number(lower_bound(p, n))
    retain_completeness = F.when(
        (p > MIN_COMPLETENESS) & (p < 1.0),
        _suggestion(
            "Completeness",
            "RetainCompletenessRule",
            p,
            F.format_string('.hasCompleteness(%s, ">= %s")', name, bound),
            F.format_string("HasCompleteness %s >= %s", name, bound),
        ),
    )
    kind = F.col("data_type")
    retain_type = F.when(
        F.col("is_data_type_inferred"),
        _suggestion(
            "DataType",
            "RetainTypeRule",
            kind,
            F.format_string('.hasDataType(%s, "%s")', name, kind),
            F.format_string('HasDataType %s = "%s"', name, kind),
        ),
    )

    non_negative = F.when(
        (F.col("profile_type") == "Numeric")
        & ~F.col("is_data_type_inferred")
        & (F.col("minimum") >= 0),
        _suggestion(
            "Compliance",
            "NonNegativeNumbersRule",
            F.col("minimum"),
            F.format_string(".isNonNegative(%s)", name),
            F.format_string("IsNonNegative %s", name),
        ),
    )
    return [complete, retain_completeness, retain_type, non_negative]


def _categories(profile: DataFrame, counts: DataFrame) -> DataFrame:
    """Per column and rule that applies: the least count that stays, and the share of cells covered.

    How often counts occur is far less than the values themselves: the running share of a column
    goes over its distinct counts, the largest first, and values of one count stay or go together.
    """
    often = (
        counts.where("value IS NOT NULL")
        .groupBy("column_name", "count")
        .agg(F.count(F.lit(1)).alias("values"))
    )
    texts = profile.where("data_type = 'String'").select("column_name", "rows", "cells")
    larger = Window.partitionBy("column_name").orderBy(F.desc("count")).rowsBetween(
        Window.unboundedPreceding, -1
    )
    cells = F.col("count") * F.col("values")
    before = F.coalesce(F.sum(cells).over(larger), F.lit(0))
    top = F.col("before") < TARGET_COVERAGE * F.col("cells")
    per_column = (
        often.join(texts, "column_name")
        .withColumn("before", before)
        .groupBy("column_name", "rows", "cells")
        .agg(
            F.sum("values").alias("distinct"),
            F.min("count").alias("least"),
            F.sum(F.when(top, F.col("values"))).alias("top"),
            F.min(F.when(top, F.col("count"))).alias("least_top"),
            F.sum(F.when(top, cells)).alias("covered"),
        )
    )
    everything = F.when(
        F.col("distinct") <= MAX_CATEGORY_RATIO * F.col("rows"),
        F.struct(
            F.lit(ALL_VALUES).alias("rule"), F.col("least"), F.lit(1.0).alias("covered"), F.col("distinct").alias("kept")
        ),
    )
    most = F.when(
        F.col("top") < F.col("distinct"),
        F.struct(
            F.lit(TOP_VALUES).alias("rule"),
            F.col("least_top").alias("least"),
            F.try_divide("covered", "cells").alias("covered"),
            F.col("top").alias("kept"),
        ),
    )
    found = F.inline(F.array_compact(F.array(everything, most)))
    return per_column.select("column_name", "rows", found)


def suggested_values(profile: DataFrame, counts: DataFrame) -> DataFrame:
    """``(column_name, suggesting_rule, value, count)``: the values that the suggested rules refer to."""
    kept = _categories(profile, counts).select("column_name", F.col("rule").alias("suggesting_rule"), "least")
    return (
        counts.where("value IS NOT NULL")
        .join(kept, "column_name")
        .where(F.col("count") >= F.col("least"))
        .select("column_name", "suggesting_rule", "value", "count")
    )


def value_sets(suggestions: DataFrame, values: DataFrame) -> dict[str, DataFrame]:
    """The values under the names that the rules use: ``references`` of ``evaluate``."""
    about = suggestions.where(F.col("suggesting_rule").isin(*SETS) & F.startswith("dqdl_rule", F.lit(BY_NAME)))
    rows = about.select("column_name", "suggesting_rule").collect()  # a row per column and rule
    return {
        set_name(*r): values.where(
            (F.col("column_name") == r.column_name) & (F.col("suggesting_rule") == r.suggesting_rule)
        ).select("value")
        for r in rows
    }


def _about_values(profile: DataFrame, counts: DataFrame) -> DataFrame:
    categories = _categories(profile, counts)
    # a row or two per column, of which both the lists and the rules are made
    found = rows_frame(profile.sparkSession, categories.collect(), categories.schema)
    keys = ("column_name", "rule")
    values = (
        counts.where("value IS NOT NULL")
        .join(found.where(F.col("kept") <= MAX_LISTED).select(*keys, "least"), "column_name")
        .where(F.col("count") >= F.col("least"))
    )
    # as many elements as a text may list
    listed = F.transform(
        F.sort_array(F.collect_list(F.struct((-F.col("count")).alias("n"), quoted(F.col("value")).alias("v")))),
        lambda x: x["v"],
    )
    texts = (
        values.groupBy(*keys)
        .agg(listed.alias("listed"), F.bool_or(F.col("value").rlike("[\\n\\r\\u0001]")).alias("broken"))
        .where(~F.col("broken") & (F.length(F.array_join("listed", ",")) <= MAX_TEXT))
        .select(*keys, "listed")
    )
    name = quoted(F.col("column_name"))
    named = F.when(F.col("rule") == ALL_VALUES, SETS[ALL_VALUES]).otherwise(SETS[TOP_VALUES])
    table = F.concat(named, F.replace("column_name", F.lit("."), F.lit("_")))
    bound = _number(lower_bound(F.col("covered"), F.col("rows")))
    everything = F.col("rule") == ALL_VALUES
    by_list = F.concat(
        F.format_string("IsContainedIn %s in [%s]", name, F.array_join("listed", ",")),
        F.when(everything, "").otherwise(F.concat(F.lit(" with threshold >= "), bound)),
    )
    by_name = F.concat(
        F.format_string(f"{BY_NAME} %s %s", name, quoted(F.concat(table, F.lit(".value")))),
        F.when(everything, "").otherwise(F.concat(F.lit(" >= "), bound)),
    )
    values_code = F.coalesce(F.format_string("[%s]", F.array_join("listed", ", ")), quoted(table))
    code = F.when(everything, F.format_string(".isContainedIn(%s, %s)", name, values_code)).otherwise(
        F.format_string('.isContainedIn(%s, %s, ">= %s")', name, values_code, bound)
    )
    return found.join(texts, [*keys], "left").select(
        "column_name",
        F.lit("Compliance").alias("constraint_name"),
        F.col("covered").cast("string").alias("current_value"),
        F.col("rule").alias("suggesting_rule"),
        code.alias("code_for_constraint"),
        F.when(F.col("listed").isNotNull(), by_list).otherwise(by_name).alias("dqdl_rule"),
    )


def suggest(profile: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """One row per suggested constraint, sorted by column.

    ``counts``: counts of the values of the columns whose values may be constrained.
    """
    found = F.array_compact(F.array(*_heuristics()))
    rows = profile.select("column_name", F.inline(found)).select(*SUGGESTION)
    if counts is not None:
        rows = rows.unionByName(_about_values(profile, counts))
    ordered = rows.orderBy("column_name", "suggesting_rule")
    # a few rows per column of the table, which rules and value sets are then made of
    return rows_frame(profile.sparkSession, ordered.collect(), ordered.schema)


def suggest_unique(df: DataFrame, profile: DataFrame, rsd: float = RSD) -> DataFrame:
    """Columns that are unique: picked by the estimate, confirmed by an exact count.

    Not among the default heuristics, since each candidate costs a shuffle of its column.
    """
    candidates = profile.where(
        (F.col("completeness") == 1.0) & (F.col("approx_distinct") >= F.col("rows") * (1 - 3 * rsd))
    )
    names = [r.column_name for r in candidates.select("column_name").collect()]
    unique = G.statistics(1)["uniqueness"]
    parts = [
        G.group_sizes(df, [compact_key(ref(c), df.schema[c].dataType)])
        .agg(unique.alias("uniqueness"))
        .select(F.lit(c).alias("column_name"), "uniqueness")
        for c in names
    ]
    if not parts:
        return suggest(profile.where(F.lit(False)))
    name = quoted(F.col("column_name"))
    found = _suggestion(
        "Uniqueness",
        "UniqueIfUniqueRule",
        F.col("uniqueness"),
        F.format_string(".isUnique(%s)", name),
        F.format_string("IsUnique %s", name),
    )
    confirmed = reduce(DataFrame.unionByName, parts).where("uniqueness = 1")
    rows = confirmed.select("column_name", F.inline(F.array(found)))
    return rows.select(*SUGGESTION).orderBy("column_name")


def recommend(
    suggestions: DataFrame,
    run_id: str = "",
    data_source: Mapping[str, str] | None = None,
    database: str = "default",
) -> DataFrame:
    """One ruleset per ``table_name`` of the suggestions, tagged with the suggestion run.

    A table has a few suggestions per column, so its text is put together in one group.
    """
    ordered = F.sort_array(
        F.collect_list(F.struct("column_name", "suggesting_rule", "dqdl_rule"))
    )
    text = F.array_join(F.transform(ordered, lambda s: s["dqdl_rule"]), ", \n")
    source = [F.lit(x) for pair in (data_source or {}).items() for x in pair]
    no_source = F.create_map().cast("map<string,string>")
    return (
        suggestions.groupBy("table_name")
        .agg(text.alias("Ruleset"))
        .select(
            F.concat("table_name", F.lit("_generated")).alias("Name"),
            F.lit("ruleset from suggestions").alias("Description"),
            "Ruleset",
            F.create_map(F.lit("SuggestionRunId"), F.lit(run_id)).alias("Tags"),
            (F.create_map(*source) if source else no_source).alias("DataSource"),
            F.struct(
                F.lit("spark_catalog").alias("CatalogId"),
                F.lit(database).alias("DatabaseName"),
                F.col("table_name").alias("TableName"),
            ).alias("TargetTable"),
        )
    )
