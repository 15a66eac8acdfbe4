"""A named group of checks, built by method calls in place of rule text."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from plumbline.plans.rules import Rule


class Check:
    """Collects checks; ``evaluate(df, check)`` runs them in as few passes as possible.

    Assertions are texts (``">= 3"``, ``"between 0 and 1"``), numbers, or functions from
    the metric Column to a boolean Column. Without one the metric must be 1.
    """

    def __init__(self, name: str, level: str = "Error") -> None:
        self.name = name
        self.level = level
        self.rules: list[Rule] = []

    def _add(self, rule_type: str, columns: Sequence[str] = (), assertion=None, **fields) -> Check:
        quoted = "".join(' "' + c.replace('"', '""') + '"' for c in columns)
        demand = f" {assertion}" if isinstance(assertion, (str, int, float)) else ""
        rule = Rule(self.name, len(self.rules), rule_type + quoted + demand, rule_type, tuple(columns))
        self.rules.append(replace(rule, assertion=assertion, **fields))
        return self

    # one scan

    def hasSize(self, assertion) -> Check:
        return self._add("HasSize", (), assertion)

    def hasMin(self, column: str, assertion) -> Check:
        return self._add("HasMin", (column,), assertion)

    def hasMax(self, column: str, assertion) -> Check:
        return self._add("HasMax", (column,), assertion)

    def hasMean(self, column: str, assertion) -> Check:
        return self._add("HasMean", (column,), assertion)

    def hasSum(self, column: str, assertion) -> Check:
        return self._add("HasSum", (column,), assertion)

    def hasStandardDeviation(self, column: str, assertion) -> Check:
        return self._add("HasStandardDeviation", (column,), assertion)

    def hasCorrelation(self, columnA: str, columnB: str, assertion) -> Check:
        return self._add("HasCorrelation", (columnA, columnB), assertion)

    def hasMinLength(self, column: str, assertion) -> Check:
        return self._add("HasMinLength", (column,), assertion)

    def hasMaxLength(self, column: str, assertion) -> Check:
        return self._add("HasMaxLength", (column,), assertion)

    def columnLength(self, column: str, op: str, lo, hi=None, assertion=None) -> Check:
        return self._add("ColumnLength", (column,), assertion, op=op, lo=lo, hi=hi)

    def hasApproxCountDistinct(self, column: str, assertion, rsd: float = 0.05) -> Check:
        return self._add("HasApproxCountDistinct", (column,), assertion, options={"rsd": rsd})

    def hasApproxQuantile(
        self, column: str, quantile: float, assertion, accuracy: int = 10000
    ) -> Check:
        columns = (column, str(quantile))
        return self._add("HasApproxQuantile", columns, assertion, options={"accuracy": accuracy})

    def hasExactQuantile(self, column: str, quantile: float, assertion) -> Check:
        return self._add("HasExactQuantile", (column, str(quantile)), assertion)

    def kllSketchSatisfies(
        self,
        column: str,
        assertion,
        quantile: float = 0.5,
        k: int = 800,
        rank_of: float | None = None,
    ) -> Check:
        """Asserts a quantile, or with ``rank_of`` the share of values up to that one."""
        columns = (column, str(quantile)) if rank_of is None else (column, "rank", str(rank_of))
        return self._add("KllSketchSatisfies", columns, assertion, options={"k": k})

    def isComplete(self, column: str) -> Check:
        return self._add("IsComplete", (column,))

    def hasCompleteness(self, column: str, assertion, blank_as_null: bool = False) -> Check:
        options = {"blank_as_null": blank_as_null}
        return self._add("HasCompleteness", (column,), assertion, options=options)

    def areComplete(self, columns: Sequence[str]) -> Check:
        return self._add("AreComplete", columns)

    def haveCompleteness(self, columns: Sequence[str], assertion) -> Check:
        return self._add("HaveCompleteness", columns, assertion)

    def areAnyComplete(self, columns: Sequence[str]) -> Check:
        return self._add("AreAnyComplete", columns)

    def haveAnyCompleteness(self, columns: Sequence[str], assertion) -> Check:
        return self._add("HaveAnyCompleteness", columns, assertion)

    def isContainedIn(self, column: str, allowed_values: Sequence[object], assertion=None) -> Check:
        values = tuple(map(str, allowed_values))
        return self._add("IsContainedIn", (column,), assertion, op="in", in_list=values)

    def isNonNegative(self, column: str, assertion=None) -> Check:
        return self._add("IsNonNegative", (column,), assertion)

    def isPositive(self, column: str, assertion=None) -> Check:
        return self._add("IsPositive", (column,), assertion)

    def satisfies(self, columnCondition: str, constraintName: str = "", assertion=None) -> Check:
        self._add("Satisfies", (columnCondition,), assertion)
        if constraintName:
            self.rules[-1] = replace(self.rules[-1], rule_text=constraintName)
        return self

    def hasPattern(self, column: str, pattern: str, assertion=None, name: str = "") -> Check:
        self._add("HasPattern", (column,), assertion, op="matches", in_list=(pattern,))
        if name:
            self.rules[-1] = replace(self.rules[-1], rule_text=name)
        return self

    def containsCreditCardNumber(self, column: str, assertion=None) -> Check:
        return self._add("ContainsCreditCardNumber", (column,), assertion)

    def containsEmail(self, column: str, assertion=None) -> Check:
        return self._add("ContainsEmail", (column,), assertion)

    def containsURL(self, column: str, assertion=None) -> Check:
        return self._add("ContainsURL", (column,), assertion)

    def containsSocialSecurityNumber(self, column: str, assertion=None) -> Check:
        return self._add("ContainsSocialSecurityNumber", (column,), assertion)

    def isLessThan(self, columnA: str, columnB: str, assertion=None) -> Check:
        return self._add("IsLessThan", (columnA, columnB), assertion)

    def isLessThanOrEqualTo(self, columnA: str, columnB: str, assertion=None) -> Check:
        return self._add("IsLessThanOrEqualTo", (columnA, columnB), assertion)

    def isGreaterThan(self, columnA: str, columnB: str, assertion=None) -> Check:
        return self._add("IsGreaterThan", (columnA, columnB), assertion)

    def isGreaterThanOrEqualTo(self, columnA: str, columnB: str, assertion=None) -> Check:
        return self._add("IsGreaterThanOrEqualTo", (columnA, columnB), assertion)

    def hasDataType(self, column: str, dataType: str, assertion=None) -> Check:
        return self._add("HasDataType", (column,), assertion, op="=", in_list=(dataType,))

    def columnValues(
        self, column: str, op: str, lo=None, hi=None, values: Sequence[object] = (), assertion=None
    ) -> Check:
        items = tuple(map(str, values)) or None
        return self._add("ColumnValues", (column,), assertion, op=op, lo=lo, hi=hi, in_list=items)

    def dataFreshness(
        self, column: str, max_age: timedelta, as_of: datetime, assertion=None
    ) -> Check:
        options = {"max_age": max_age, "as_of": as_of}
        return self._add("DataFreshness", (column,), assertion, options=options)

    # grouped counts

    def isUnique(self, column: str) -> Check:
        return self._add("IsUnique", (column,))

    def hasUniqueness(self, columns: Sequence[str], assertion) -> Check:
        return self._add("HasUniqueness", columns, assertion)

    def hasDistinctness(self, columns: Sequence[str], assertion) -> Check:
        return self._add("HasDistinctness", columns, assertion)

    def hasUniqueValueRatio(self, columns: Sequence[str], assertion) -> Check:
        return self._add("HasUniqueValueRatio", columns, assertion)

    def hasNumberOfDistinctValues(
        self, column: str, assertion, binning: Column | None = None, maxBins: int | None = None
    ) -> Check:
        """``maxBins`` is accepted for its place in the signature; the count is never cut."""
        options = {} if binning is None else {"binning": binning}
        return self._add("HasNumberOfDistinctValues", (column,), assertion, options=options)

    def isPrimaryKey(self, column: str, *columns: str) -> Check:
        return self._add("IsPrimaryKey", (column, *columns))

    def hasEntropy(self, column: str, assertion) -> Check:
        return self._add("HasEntropy", (column,), assertion)

    def hasMutualInformation(self, columnA: str, columnB: str, assertion) -> Check:
        return self._add("HasMutualInformation", (columnA, columnB), assertion)

    def hasHistogramValues(
        self,
        column: str,
        assertion,
        binning: Column | None = None,
        maxBins: int | None = None,
        value: str | None = None,
    ) -> Check:
        """Asserts the number of bins, or with ``value`` the ratio of that bin; with
        ``maxBins`` the histogram is that of the largest bins."""
        columns = (column,) if value is None else (column, value)
        options = {"binning": binning, "max_bins": maxBins}
        return self._add("HasHistogramValues", columns, assertion, options=options)

    # over time

    def hasMetricChange(
        self, aggregate: str, period: str, assertion, season: int = 1, window: int = 14
    ) -> Check:
        """Asserts how far the newest period's change of an aggregate deviates from earlier changes."""
        columns = (aggregate, period, str(season), str(window))
        return self._add("MetricChange", columns, assertion)

    # two data sets, named as in ``evaluate(..., references={name: DataFrame})``

    def referentialIntegrity(
        self, columns: Sequence[str], reference: str, reference_columns: Sequence[str], assertion=None
    ) -> Check:
        parents = [f"{reference}.{c}" for c in reference_columns]
        return self._add("ReferentialIntegrity", (*columns, *parents), assertion)

    def rowCountMatch(self, reference: str, assertion=None) -> Check:
        return self._add("RowCountMatch", (reference,), assertion)

    def aggregateMatch(
        self, aggregate: str, reference: str, reference_aggregate: str, assertion=None
    ) -> Check:
        columns = (aggregate, reference, reference_aggregate)
        return self._add("AggregateMatch", columns, assertion)

    def datasetMatch(
        self, reference: str, keys: Sequence[str], match: Sequence[str] = (), assertion=None
    ) -> Check:
        columns = (reference, ",".join(keys), *([",".join(match)] if match else []))
        return self._add("DatasetMatch", columns, assertion)

    def schemaMatch(self, reference: str, assertion=None) -> Check:
        return self._add("SchemaMatch", (reference,), assertion)

    def columnExists(self, column: str) -> Check:
        return self._add("ColumnExists", (column,))

    def columnCount(self, assertion) -> Check:
        return self._add("ColumnCount", (), assertion)

    def customSql(self, sql: str, assertion=None) -> Check:
        return self._add("CustomSql", (sql,), assertion)

    def status(self, results: DataFrame) -> DataFrame:
        """Overall status of this check: Success, or its level when a rule is not met."""
        from plumbline.plans.score import check_status

        return check_status(results.where(F.col("ruleset_name") == self.name), self.level)

    def run(self, df: DataFrame, **kwargs) -> DataFrame:
        from plumbline.plans.evaluate import evaluate

        return evaluate(df, self, **kwargs)
