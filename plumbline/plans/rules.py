"""Ruleset text as a table of rules.

A ruleset is one text, rules separated by a comma and a following rule name:

    HasSize >= 1000,
    IsComplete "l_shipdate",
    IsContainedIn "l_returnflag" in ["A","N","R"] with threshold >= 0.9

A rule is a type, quoted column names, and an expression. Commas, blanks, brackets and
rule names inside quotes do not split; ``""`` inside quotes is one quote.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from plumbline.functions.assertions import NUMBER
from plumbline.functions.columns import identifier, literal

RULE_FIELDS = (
    "ruleset_name",
    "rule_no",
    "rule_text",
    "rule_type",
    "columns",
    "column_name",
    "expression",
    "op",
    "lo",
    "hi",
    "in_list",
    "unit",
    "threshold_op",
    "threshold_lo",
    "threshold_hi",
)

_BREAK = "\u0001"
_QUOTED = r'"(?:[^"]++|"")*+"'
_SEPARATOR = r",\s*(?=[A-Z]\w*(?:[\s,]|$))(?![^\[]*\])"
_COMPARISON = rf"^(!=|>=|<=|=|>|<)\s*({NUMBER})\s*(\w*)$"
_TEXT_TEST = rf"^(!=|>=|<=|=|>|<|matches)\s*({_QUOTED})$"
_BETWEEN = rf"^between\s+({NUMBER})\s+and\s+({NUMBER})$"
_HEAD = rf"(?s)^(\w+)((?:\s+{_QUOTED})*)\s*(.*)$"
_MARGIN = r"^\s+|\s+$"
_LIST = r"(?s)^in\s*\[(.*)\]$"
_ITEM = rf'{_QUOTED}|[^",\s][^",]*'
_THRESHOLD = r"\s*with threshold\s+([^\"]*)$"
_OUTER_QUOTES = '^"|"$'


def _split_rules(text: str) -> str:
    """Break at separators outside of quotes: only the even pieces of a split on quotes."""
    return f"""split(array_join(transform(split({text}, '"'), (piece, i) ->
        CASE WHEN i % 2 = 0 THEN regexp_replace(piece, {literal(_SEPARATOR)}, {literal(_BREAK)})
        ELSE piece END), '"'), {literal(_BREAK)})"""


def _unquote(item: str) -> str:
    inner = f"regexp_replace({item}, {literal(_OUTER_QUOTES)}, '')"
    return f"""CASE WHEN startswith({item}, '"') THEN replace({inner}, '""', '"')
        ELSE trim({item}) END"""


def _items(text: str, pattern: str) -> str:
    found = f"regexp_extract_all({text}, {literal(pattern)}, 0)"
    return f"transform({found}, item -> {_unquote('item')})"


def _group(text: str, pattern: str, n: int) -> str:
    """Regex group, NULL when there is no match."""
    return f"nullif(regexp_extract({text}, {literal(pattern)}, {n}), '')"


def explode_rules(rulesets: DataFrame, name: str = "Name", text: str = "Ruleset") -> DataFrame:
    """One row per rule of a table of rulesets, with the rule split into its parts."""
    head, body, demand = literal(_HEAD), "_body", "_demand"
    rules = (
        rulesets.selectExpr(
            f"{identifier(name)} AS ruleset_name",
            f"posexplode({_split_rules(identifier(text))}) AS (rule_no, raw)",
        )
        .selectExpr(
            "ruleset_name",
            "rule_no",
            f"regexp_replace(raw, {literal(_MARGIN)}, '') AS rule_text",
        )
        .where("rule_text <> ''")
        .selectExpr(
            "*",
            f"regexp_extract(rule_text, {head}, 1) AS rule_type",
            f"{_items(f'regexp_extract(rule_text, {head}, 2)', _QUOTED)} AS columns",
            f"regexp_extract(rule_text, {head}, 3) AS expression",
        )
        .selectExpr(
            "*",
            f"regexp_extract(expression, {literal(_THRESHOLD)}, 1) AS {demand}",
            f"regexp_replace(expression, {literal(_THRESHOLD)}, '') AS {body}",
        )
    )
    listed = f"regexp_extract({body}, {literal(_LIST)}, 1)"
    is_list = f"startswith({body}, 'in')"
    is_text_test = f"{body} RLIKE {literal(_TEXT_TEST)}"

    def between(part: str) -> str:
        return f"CASE WHEN {part} RLIKE {literal(_BETWEEN)} THEN 'between' END"

    def low(part: str) -> str:
        return f"coalesce({_group(part, _BETWEEN, 1)}, {_group(part, _COMPARISON, 2)})"

    return rules.selectExpr(
        "ruleset_name",
        "rule_no",
        "rule_text",
        "rule_type",
        "columns",
        "try_element_at(columns, 1) AS column_name",
        "expression",
        f"""coalesce(CASE WHEN {is_list} THEN 'in' END, {between(body)},
            {_group(body, _COMPARISON, 1)}, {_group(body, _TEXT_TEST, 1)}) AS op""",
        f"CAST({low(body)} AS DOUBLE) AS lo",
        f"CAST({_group(body, _BETWEEN, 2)} AS DOUBLE) AS hi",
        f"""CASE WHEN {is_list} THEN {_items(listed, _ITEM)} WHEN {is_text_test}
            THEN {_items(f'regexp_extract({body}, {literal(_TEXT_TEST)}, 2)', _QUOTED)} END AS in_list""",
        f"{_group(body, _COMPARISON, 3)} AS unit",
        f"coalesce({between(demand)}, {_group(demand, _COMPARISON, 1)}) AS threshold_op",
        f"CAST({low(demand)} AS DOUBLE) AS threshold_lo",
        f"CAST({_group(demand, _BETWEEN, 2)} AS DOUBLE) AS threshold_hi",
    )


@dataclass(frozen=True)
class Rule:
    """One rule as driver-side metadata; ``assertion`` is set by the builder API only."""

    ruleset_name: str
    rule_no: int
    rule_text: str
    rule_type: str
    columns: tuple[str, ...] = ()
    expression: str = ""
    op: str | None = None
    lo: float | None = None
    hi: float | None = None
    in_list: tuple[str, ...] | None = None
    unit: str | None = None
    threshold_op: str | None = None
    threshold_lo: float | None = None
    threshold_hi: float | None = None
    assertion: object = field(default=None, compare=False)
    options: Mapping[str, object] = field(default_factory=dict, compare=False)


def rules_of(rules: DataFrame) -> list[Rule]:
    """Rules of the rulesets to be evaluated; metadata, one row per rule."""
    fields = [f for f in RULE_FIELDS if f != "column_name"]
    rows = sorted(rules.select(*fields).collect(), key=lambda r: (r.ruleset_name, r.rule_no))
    return [
        Rule(**{k: tuple(v) if isinstance(v, list) else v for k, v in r.asDict().items()})
        for r in rows
    ]


def one_row(spark: SparkSession) -> DataFrame:
    """One row in one partition, for rows made of literals."""
    return spark.range(0, 1, 1, 1)


def rulesets_frame(
    spark: SparkSession, rulesets: Mapping[str, str | Iterable[str]]
) -> DataFrame:
    """``(Name, Ruleset)`` rows; a list of rules is joined to one text."""
    texts = [
        (name, text if isinstance(text, str) else ", \n".join(map(str.strip, text)))
        for name, text in rulesets.items()
    ]
    rows = [F.struct(F.lit(n).alias("Name"), F.lit(t).alias("Ruleset")) for n, t in texts]
    return one_row(spark).select(F.inline(F.array(*rows)))


def parse_rules(spark: SparkSession, rulesets: Mapping[str, str | Iterable[str]]) -> list[Rule]:
    return rules_of(explode_rules(rulesets_frame(spark, rulesets)))
