"""Tallies, scores and records made of result rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

STATUSES = ("PASS", "FAIL", "ERROR", "SKIP", "WARNING")
RULESET = ("ruleset_name",)


def _of(status: str):
    return F.count_if(F.col("result") == status)


def _counts(rules: str, by_status: Mapping[str, str]) -> Column:
    """Number of rules and of each status as a map; of the statuses, only PASS and FAIL may be zero."""
    return F.map_filter(
        F.map_from_arrays(
            F.array(F.lit("RULES"), *map(F.lit, by_status)),
            F.array(*[F.col(c).cast("int") for c in (rules, *by_status.values())]),
        ),
        lambda k, v: (v > 0) | k.isin("RULES", "PASS", "FAIL"),
    )


def tally(
    results: DataFrame, by: Sequence[str] = RULESET, names: DataFrame | None = None
) -> DataFrame:
    """Per ruleset: number of rules, number per status, score, and all of it as a map.

    The score is PASS / (PASS + FAIL); skipped and broken rules do not count, and it is
    NULL when nothing ran. ``names``: the rulesets asked for, so that an empty one shows
    up with no rules.
    """
    if names is not None:
        results = names.select(*by).distinct().join(results, list(by), "left")
    counted = results.groupBy(*by).agg(
        F.count("result").alias("rules"), *[_of(s).alias(s.lower()) for s in STATUSES]
    )
    shown = _counts("rules", {s: s.lower() for s in STATUSES})
    return counted.withColumns(
        {"score": F.try_divide("pass", F.col("pass") + F.col("fail")), "tally": shown}
    )


def score(results: DataFrame, by: Sequence[str] = RULESET) -> DataFrame:
    return tally(results, by).select(*by, "score")


def failing(results: DataFrame) -> DataFrame:
    """The rules that were not met, with the reason."""
    return results.where("result <> 'PASS'")


def check_status(
    results: DataFrame, level: str = "Error", by: Sequence[str] = RULESET
) -> DataFrame:
    """Success when every rule that ran is met, else the level of the check."""
    met = F.bool_and(F.col("result") == "PASS")
    ran = results.where("result <> 'SKIP'")
    return ran.groupBy(*by).agg(
        F.when(met, F.lit("Success")).otherwise(F.lit(level)).alias("status")
    )


def check_results(
    results: DataFrame, level: str = "Error", by: Sequence[str] = RULESET
) -> DataFrame:
    """Results as constraints of checks, each beside the overall status of its check."""
    overall = check_status(results, level, by).withColumnRenamed("status", "check_status")
    outcome = F.when(F.col("result") == "PASS", "Success").otherwise("Failure")
    return results.where("result <> 'SKIP'").join(overall, list(by)).select(
        F.col(by[0]).alias("check"),
        F.lit(level).alias("check_level"),
        "check_status",
        F.col("rule_text").alias("constraint"),
        outcome.alias("constraint_status"),
        F.col("message").alias("constraint_message"),
    )


def result_records(
    results: DataFrame,
    run_id: str,
    data_source: Mapping[str, str],
    started_on: datetime,
    completed_on: datetime,
    by: Sequence[str] = RULESET,
) -> DataFrame:
    """One nested record per ruleset: id, score, tally and its rule results in order."""
    started = started_on.strftime("%Y-%m-%dT%H:%M:%S.%fZ")
    rule_result = F.struct(
        "rule_no",
        F.concat(F.lit("Rule_"), "rule_no").alias("Name"),
        F.col("rule_text").alias("Description"),
        F.col("message").alias("EvaluationMessage"),
        F.struct(
            F.col("rule_type").alias("Constraint"), F.col("metric").alias("Value")
        ).alias("EvaluatedMetrics"),
        F.col("result").alias("Result"),
    )
    # As many elements as the ruleset has rules.
    listed = F.sort_array(F.collect_list(rule_result))
    records = results.groupBy(*by).agg(
        listed.alias("RuleResults"),
        F.count(F.lit(1)).cast("int").alias("_rules"),
        *[_of(s).cast("int").alias(s) for s in STATUSES],
    )
    counts = _counts("_rules", {s: s for s in STATUSES})
    source = [F.lit(x) for pair in data_source.items() for x in pair]
    return records.select(
        F.concat(F.lit(f"dqresult-{started}-"), *by).alias("ResultId"),
        F.try_divide("PASS", F.col("PASS") + F.col("FAIL")).alias("Score"),
        counts.alias("Tally"),
        F.create_map(*source).alias("DataSource"),
        F.col(by[0]).alias("RulesetName"),
        F.lit(started).alias("StartedOn"),
        F.lit(completed_on.strftime("%Y-%m-%dT%H:%M:%S.%fZ")).alias("CompletedOn"),
        F.lit(run_id).alias("RulesetEvaluationRunId"),
        "RuleResults",
    )


def flat_results(records: DataFrame, table_name: str | Column, exec_name: str = "") -> DataFrame:
    """Rule results of nested records as flat rows, one per rule.

    The column names are fixed values of the stored format.
    """
    table = F.lit(table_name) if isinstance(table_name, str) else table_name
    rule = records.select(
        "ResultId", table.alias("table_name"), F.explode("RuleResults").alias("r")
    )
    return rule.select(
        "r.Name",
        "r.Result",
        F.col("r.Description").alias("dqdl_rule"),
        "r.EvaluationMessage",
        F.col("ResultId").alias("result_id"),
        "table_name",
        F.lit(exec_name).alias("sfn_exec_name"),
    )
