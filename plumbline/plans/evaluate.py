"""Running rules: all of them share the passes they need.

Plain aggregates of every rule of every ruleset fuse into one code-generated aggregate
(cut into chunks below the code generator's field limit), sketches into a second one, and
all key sets into one grouped count. The branches are united, so one action runs them all.
Only rule metadata is on the driver; metrics stay in the plan.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plumbline.functions.assertions import Assertion, Custom
from plumbline.functions.columns import ref
from plumbline.operators import grouped as G
from plumbline.operators.metric import FRAME, GROUPS, SCAN, SKETCH, Metric, RuleError
from plumbline.plans.catalogue import Constraint, Context, compile_rule
from plumbline.plans.checks import Check
from plumbline.plans.rules import Rule, explode_rules, one_row, parse_rules, rules_of

# Below spark.sql.codegen.maxFields (100): a wider aggregate leaves generated code.
CHUNK = 80

# Column of a frame that says why it has no metric.
FAULT = "_error"

RESULT_SCHEMA = (
    "ruleset_name string, rule_no int, rule_text string, rule_type string, "
    "metric double, result string, message string"
)


def to_rules(spark: SparkSession, rules, name: str) -> list[Rule]:
    """Rules from a Check, checks, a rulesets table, a mapping of rulesets, or rule texts."""
    if isinstance(rules, Check):
        return rules.rules
    if isinstance(rules, DataFrame):
        return rules_of(rules if "rule_no" in rules.columns else explode_rules(rules))
    if isinstance(rules, Mapping):
        return parse_rules(spark, rules)
    if isinstance(rules, str):
        return parse_rules(spark, {name: rules})
    rules = list(rules)
    if all(isinstance(r, Check) for r in rules):
        return [r for check in rules for r in check.rules]
    if all(isinstance(r, Rule) for r in rules):
        return rules
    return parse_rules(spark, {name: rules})


_RULE_ROWS = (
    "array<struct<slot:int,rule_id:int,ruleset_name:string,rule_no:int,rule_text:string,"
    "rule_type:string,status:string,message:string,op:string,lo:double,hi:double,"
    "items:array<double>,demand:string>>"
)


def _rule_row(rule_id: int, c: Constraint, slot: int | None) -> dict:
    row = {
        "slot": slot,
        "rule_id": rule_id,
        "ruleset_name": c.rule.ruleset_name,
        "rule_no": c.rule.rule_no,
        "rule_text": c.rule.rule_text,
        "rule_type": c.rule.rule_type,
        "status": c.status,
        "message": c.message,
    }
    if c.status is None:
        row["demand"] = c.demand.text
        if isinstance(c.demand, Assertion):
            row |= {"op": c.demand.op, "lo": c.demand.lo, "hi": c.demand.hi}
            row["items"] = list(c.demand.values)
    return row


def _judge(
    frame: DataFrame,
    by: Sequence[str],
    metrics: list[str],
    rows: list[dict],
    custom: dict,
    fault: str | None = None,
) -> DataFrame:
    """Results of all rules on the metrics of one frame; a NULL or NaN metric meets nothing.

    ``fault``: column of the frame that says what kept it from having a metric.

    The rules are one literal, so the plan does not grow with their number.
    """
    by_cols = list(map(ref, by))
    rules = F.from_json(F.lit(json.dumps(rows)), _RULE_ROWS)
    values = F.array(*map(ref, metrics)) if metrics else F.lit(None).cast("array<double>")
    wrong = ref(fault) if fault else F.lit(None).cast("string")
    judged = frame.select(*by_cols, values.alias("_metrics"), wrong.alias("_fault"), F.inline(rules))
    metric = F.col("metric")
    holds = F.expr(
        """CASE op WHEN '=' THEN metric = lo WHEN '>' THEN metric > lo WHEN '<' THEN metric < lo
        WHEN '>=' THEN metric >= lo WHEN '<=' THEN metric <= lo
        WHEN 'between' THEN metric > lo AND metric < hi
        WHEN 'in' THEN array_contains(items, metric) END"""
    )
    for rule_id, demand in custom.items():
        holds = F.when(F.col("rule_id") == rule_id, demand.holds(metric)).otherwise(holds)
    judged = judged.withColumn("metric", F.expr("try_element_at(_metrics, slot + 1)"))
    judged = judged.withColumn("_met", F.coalesce(holds & ~F.isnan(metric), F.lit(False)))
    return judged.select(
        *by_cols,
        "ruleset_name",
        "rule_no",
        "rule_text",
        "rule_type",
        "metric",
        F.expr(
            "CASE WHEN status IS NOT NULL THEN status WHEN _fault IS NOT NULL THEN 'ERROR' "
            "WHEN _met THEN 'PASS' ELSE 'FAIL' END AS result"
        ),
        F.expr(
            """CASE WHEN status IS NOT NULL THEN message WHEN _fault IS NOT NULL THEN _fault
            WHEN _met THEN ''
            WHEN metric IS NULL THEN 'no value: the data set is empty or holds only NULL'
            ELSE concat('value ', metric, ' does not meet: ', demand) END AS message"""
        ),
    )


def _chunks(metrics: list[Metric]) -> list[list[Metric]]:
    """Split on columns, so that chunks read different columns wherever possible."""
    ordered = sorted(metrics, key=lambda m: (len(m.columns), m.columns))
    return [ordered[i : i + CHUNK] for i in range(0, len(ordered), CHUNK)]


def evaluate_constraints(
    df: DataFrame, constraints: Sequence[Constraint], by: Sequence[str] = ()
) -> DataFrame:
    alias = named_metrics(constraints)
    by_cols = list(map(ref, by))

    frames: list[tuple[DataFrame, list[Metric]]] = []
    failed: dict[Metric, str] = {}

    def plan(chunk: list[Metric], build: Callable[[list[Metric]], DataFrame]) -> None:
        """Adds the chunk's plan, without the metrics that do not fit the data set."""
        try:
            frames.append((build(chunk), chunk))
        except RuleError as error:
            failed.update({m: str(error) for m in chunk})
        except AnalysisException as error:
            if len(chunk) == 1:
                failed[chunk[0]] = f"does not fit the data set: {error.getCondition()}"
                return
            for m in chunk:
                try:
                    build([m])
                except AnalysisException as single:
                    failed[m] = f"does not fit the data set: {single.getCondition()}"
            fitting = [m for m in chunk if m not in failed]
            if len(fitting) == len(chunk):
                raise
            if fitting:
                frames.append((build(fitting), fitting))

    def named(chunk: list[Metric]) -> list[Column]:
        return [m.expr.alias(alias[m]) for m in chunk]

    def counted(chunk: list[Metric]) -> DataFrame:
        return G.statistics_frame(df, chunk, by, [alias[m] for m in chunk])

    def framed(chunk: list[Metric]) -> DataFrame:
        built = chunk[0].build(df, by)
        fault = [F.col("error").alias(FAULT)] if "error" in built.columns else []
        return built.select(*by_cols, F.col("metric").cast("double").alias(alias[chunk[0]]), *fault)

    for family in (SCAN, SKETCH):
        for chunk in _chunks([m for m in alias if m.family == family]):
            plan(chunk, lambda ms: df.groupBy(*by_cols).agg(*named(ms)))
    key_sets: dict[tuple, list[Metric]] = {}
    for m in alias:
        if m.family == GROUPS:
            key_sets.setdefault(G.key_set(m), []).append(m)
    for chunk in G.passes(df, key_sets):
        plan(chunk, counted)
    for m in alias:
        if m.family == FRAME:
            plan([m], framed)

    return judge(df, constraints, frames, alias, failed, by)


def named_metrics(constraints: Sequence[Constraint]) -> dict[Metric, str]:
    """The different metrics that the constraints need, each with a column name."""
    metrics: dict[tuple, Metric] = {}
    for c in constraints:
        if c.metric is not None and c.status is None:
            metrics.setdefault((c.metric.family, *c.metric.identity), c.metric)
    return {m: f"_m{i}" for i, m in enumerate(metrics.values())}


def judge(
    df: DataFrame,
    constraints: Sequence[Constraint],
    frames: Sequence[tuple[DataFrame, list[Metric]]],
    alias: Mapping[Metric, str],
    failed: Mapping[Metric, str],
    by: Sequence[str] = (),
) -> DataFrame:
    """Results of all constraints from frames that hold their metrics; ``failed`` ones have none.

    Of ``df`` only the session and the types of the ``by`` columns are taken.
    """
    spark = df.sparkSession
    numbered = [
        (i, Constraint(c.rule, status="ERROR", message=failed[c.metric]))
        if not c.status and c.metric in failed
        else (i, c)
        for i, c in enumerate(constraints)
    ]
    parts = []
    for frame, chunk in frames:
        slots = {m: i for i, m in enumerate(chunk)}
        mine = [(i, c) for i, c in numbered if not c.status and c.metric in slots]
        rows = [_rule_row(i, c, slots[c.metric]) for i, c in mine]
        custom = {i: c.demand for i, c in mine if isinstance(c.demand, Custom)}
        fault = FAULT if FAULT in frame.columns else None
        parts.append(_judge(frame, by, [alias[m] for m in chunk], rows, custom, fault))
    settled = [_rule_row(i, c, None) for i, c in numbered if c.status]
    if settled:
        none = [F.lit(None).cast(df.schema[b].dataType).alias(b) for b in by]
        parts.append(_judge(one_row(spark).select(*none), by, [], settled, {}))
    if not parts:
        keys = "".join(f"`{b}` {df.schema[b].dataType.simpleString()}, " for b in by)
        return spark.createDataFrame([], keys + RESULT_SCHEMA)
    return reduce(DataFrame.unionByName, parts)


def evaluate(
    df: DataFrame,
    rules,
    *,
    name: str = "rules",
    by: Sequence[str] = (),
    references: Mapping[str, DataFrame] | None = None,
    as_of: datetime | None = None,
) -> DataFrame:
    """One row per rule: ruleset, number, text, type, metric, result and message.

    ``by``: columns of ``df`` (day, file, partition) to judge each part of on its own.
    ``references``: the other data sets that two-table rules name.
    ``as_of``: the moment freshness is measured from, UTC; now when not given.
    """
    context = Context(df, references or {}, as_of)
    found = to_rules(df.sparkSession, rules, name)
    return evaluate_constraints(df, [compile_rule(r, context) for r in found], by)


def evaluate_many(df: DataFrame, rulesets: Mapping[str, str | Iterable[str]], **kwargs) -> DataFrame:
    """Several rulesets on one data set in the passes of one."""
    return evaluate(df, rulesets, **kwargs)


# Fixed format: the message of a batch item without results.
NO_RESULTS = "No Results -- Empty Dataset?"


def with_defaults(item: Mapping, base: str, partition: str) -> dict:
    """A batch item's own source and rulesets, or the defaults for its table."""
    table = item["ObjectId"]
    return {
        "table_name": table,
        "DataSource": item.get("DataSource") or {"Path": f"{base}/{table}/{partition}"},
        "RulesetNames": list(item.get("RulesetNames") or [f"{table}_generated"]),
    }


def evaluate_batch(
    items: Iterable[Mapping],
    rulesets: DataFrame,
    read: Callable[[Mapping], DataFrame | None],
    **kwargs,
) -> DataFrame:
    """Results of every table of a batch, with its ``table_name``.

    ``items`` carry ``table_name``, ``DataSource`` and ``RulesetNames``; ``read`` turns a
    data source into a DataFrame, or None when there is none: such an item, and one whose
    rulesets are empty, yields one WARNING row.
    """
    spark = rulesets.sparkSession
    items = list(items)
    wanted = sorted({n for item in items for n in item["RulesetNames"]})
    rules = rules_of(explode_rules(rulesets.where(F.col("Name").isin(wanted))))
    parts = []
    for item in items:
        df = read(item["DataSource"])
        chosen = [r for r in rules if r.ruleset_name in item["RulesetNames"]]
        if df is None or not chosen:
            row = (None, None, None, None, None, "WARNING", NO_RESULTS)
            part = spark.createDataFrame([row], RESULT_SCHEMA)
        else:
            part = evaluate(df, chosen, **kwargs)
        parts.append(part.withColumn("table_name", F.lit(item["table_name"])))
    return reduce(DataFrame.unionByName, parts)
