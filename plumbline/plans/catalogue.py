"""From a rule to the metric it needs and the condition it sets."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace
from datetime import datetime, timedelta, timezone

from pyspark.errors import AnalysisException, ParseException, PySparkException
from pyspark.sql import DataFrame, functions as F, types as T

from plumbline.functions.assertions import ALL_ROWS, SUPPORTED, Assertion, assertion
from plumbline.functions.columns import is_numeric, is_string, literal
from plumbline.operators import aggregates as A
from plumbline.operators import grouped as G
from plumbline.operators import pairs as X
from plumbline.operators import quantiles as Q
from plumbline.operators import trends as R
from plumbline.operators.metric import FRAME, Metric, RuleError
from plumbline.plans.rules import Rule


@dataclass(frozen=True)
class Context:
    df: DataFrame
    references: Mapping[str, DataFrame] = field(default_factory=dict)
    as_of: datetime | None = None

    def dtype(self, col: str) -> T.DataType:
        if col not in self.df.schema.fieldNames():
            raise RuleError(f"column {col!r} does not exist")
        return self.df.schema[col].dataType

    def reference(self, name: str) -> DataFrame:
        if name not in self.references:
            raise RuleError(f"data set {name!r} is not known")
        return self.references[name]


@dataclass(frozen=True)
class Constraint:
    rule: Rule
    metric: Metric | None = None
    demand: object = None
    status: str | None = None  # SKIP or ERROR: settled without looking at data
    message: str = ""


# --- argument checks -----------------------------------------------------------


def _cols(rule: Rule, ctx: Context, n: int | None = None) -> tuple[str, ...]:
    cols = rule.columns if n is None else rule.columns[:n]
    if not cols or (n is not None and len(cols) < n):
        raise RuleError(f"{rule.rule_type} needs {n or 'at least 1'} column(s)")
    for c in cols:
        ctx.dtype(c)
    return cols


def _numeric(rule: Rule, ctx: Context, n: int = 1) -> tuple[str, ...]:
    cols = _cols(rule, ctx, n)
    for c in cols:
        if not is_numeric(ctx.dtype(c)):
            raise RuleError(f"column {c!r} is not numeric")
    return cols


def _text(rule: Rule, ctx: Context) -> str:
    (col,) = _cols(rule, ctx, 1)
    if not is_string(ctx.dtype(col)):
        raise RuleError(f"column {col!r} is not a text")
    return col


def _extra(rule: Rule, position: int, what: str) -> str:
    if len(rule.columns) <= position:
        raise RuleError(f"{rule.rule_type} needs {what}")
    return rule.columns[position]


def _number(rule: Rule, position: int, what: str) -> float:
    text = _extra(rule, position, what)
    try:
        return float(text)
    except ValueError:
        raise RuleError(f"{what} expected, found {text!r}") from None


def _listed(rule: Rule, what: str = "a list of values") -> tuple[str, ...]:
    if not rule.in_list:
        raise RuleError(f"{rule.rule_type} needs {what}")
    return rule.in_list


# --- metrics that take more than column names ----------------------------------


def _one(build: Callable[[str], Metric], numeric: bool = False):
    check = _numeric if numeric else _cols
    return lambda rule, ctx: build(*check(rule, ctx, 1))


def _two(build: Callable[[str, str], Metric], numeric: bool = False):
    check = _numeric if numeric else _cols
    return lambda rule, ctx: build(*check(rule, ctx, 2))


def _signed(build: Callable[[str, T.DataType], Metric]):
    def compile_(rule: Rule, ctx: Context) -> Metric:
        (col,) = _numeric(rule, ctx, 1)
        return build(col, ctx.dtype(col))

    return compile_


def _alike(a: T.DataType, b: T.DataType, what: str) -> None:
    """Types that Spark compares without a cast that could fail on a row."""
    temporal = (T.DateType, T.TimestampType, T.TimestampNTZType)
    same = (
        a == b
        or (is_numeric(a) and is_numeric(b))
        or (is_string(a) and is_string(b))
        or (isinstance(a, temporal) and isinstance(b, temporal))
    )
    if not same:
        raise RuleError(f"{what} are {a.simpleString()} and {b.simpleString()}")


def _compared(build: Callable[[str, str], Metric]):
    def compile_(rule: Rule, ctx: Context) -> Metric:
        a, b = _cols(rule, ctx, 2)
        _alike(ctx.dtype(a), ctx.dtype(b), f"columns {a!r} and {b!r}")
        return build(a, b)

    return compile_


def _regex(pattern: str, ctx: Context) -> str:
    """The pattern, if Spark's engine reads it; tried on a literal, without a job."""
    try:
        ctx.df.sparkSession.sql(f"SELECT '' RLIKE {literal(pattern)}").collect()
    except PySparkException:
        raise RuleError(f"pattern {pattern!r} is no regular expression") from None
    return pattern


def _lengths(build: Callable[[str], Metric]):
    return lambda rule, ctx: build(_text(rule, ctx))


def _any(build):
    return lambda rule, ctx: build(_cols(rule, ctx))


def _groups(statistic: str, n: int | None = None):
    def compile_(rule: Rule, ctx: Context) -> Metric:
        binning = rule.options.get("binning")
        cols = _cols(rule, ctx, n)
        return G.grouped(statistic, cols, [ctx.dtype(c) for c in cols], binning)

    return compile_


def _completeness(rule: Rule, ctx: Context) -> Metric:
    (col,) = _cols(rule, ctx, 1)
    blank = rule.options.get("blank_as_null") or rule.columns[1:2] == ("blank_as_null",)
    return A.completeness(col, ctx.dtype(col), bool(blank))


def _contained(rule: Rule, ctx: Context) -> Metric:
    (col,) = _cols(rule, ctx, 1)
    return A.contained(col, ctx.dtype(col), _listed(rule))


def _values(rule: Rule, ctx: Context) -> Metric:
    (col,) = _cols(rule, ctx, 1)
    if rule.op not in (*SUPPORTED, "matches"):
        raise RuleError(f"expression {rule.expression!r} is not supported")
    if rule.op == "matches":
        _regex(_listed(rule, "a pattern")[0], ctx)
    return A.values(col, ctx.dtype(col), rule.op, rule.lo, rule.hi, rule.in_list or ())


def _length(rule: Rule, ctx: Context) -> Metric:
    col = _text(rule, ctx)
    if rule.op not in SUPPORTED:
        raise RuleError(f"expression {rule.expression!r} is not supported")
    return A.length(col, rule.op, rule.lo, rule.hi, rule.in_list or ())


def _pattern(rule: Rule, ctx: Context) -> Metric:
    (col,) = _cols(rule, ctx, 1)
    return A.pattern(col, _regex(_listed(rule, "a pattern")[0], ctx))


def _data_type(rule: Rule, ctx: Context) -> Metric:
    (col,) = _cols(rule, ctx, 1)
    name = _listed(rule, "a type")[0]
    try:
        metric = A.data_type(col, name)
        ctx.df.select(metric.expr)
    except (AnalysisException, ParseException):
        raise RuleError(f"type {name!r} is not known for column {col!r}") from None
    return metric


def _satisfies(rule: Rule, ctx: Context) -> Metric:
    condition = _extra(rule, 0, "a condition")
    try:
        ctx.df.select(F.expr(condition).cast("boolean"))
    except (AnalysisException, ParseException):
        raise RuleError(f"condition {condition!r} does not fit the data set") from None
    return A.satisfies(condition, ctx.df.columns)


def _quantile(build):
    def compile_(rule: Rule, ctx: Context) -> Metric:
        (col,) = _numeric(rule, ctx, 1)
        q = _number(rule, 1, "a quantile")
        if not 0 <= q <= 1:
            raise RuleError("a quantile lies between 0 and 1")
        return build(col, q, **rule.options)

    return compile_


def _kll(rule: Rule, ctx: Context) -> Metric:
    """A quantile, or with ``"rank"`` and a value the share of values up to it."""
    if rule.columns[1:2] != ("rank",):
        return _quantile(A.kll_quantile)(rule, ctx)
    (col,) = _numeric(rule, ctx, 1)
    return A.kll_rank(col, _number(rule, 2, "a value"), **rule.options)


def _approx_distinct(rule: Rule, ctx: Context) -> Metric:
    (col,) = _cols(rule, ctx, 1)
    return A.approx_distinct(col, **rule.options)


def _freshness(rule: Rule, ctx: Context) -> Metric:
    (col,) = _cols(rule, ctx, 1)
    if not isinstance(ctx.dtype(col), (T.DateType, T.TimestampType, T.TimestampNTZType)):
        raise RuleError(f"column {col!r} is not a date or time")
    max_age = rule.options.get("max_age")
    if max_age is None:
        unit = (rule.unit or "").rstrip("s") + "s"
        if rule.op not in ("<=", "<") or unit not in ("days", "hours", "minutes"):
            raise RuleError("an age such as '<= 10 days' is needed")
        max_age = timedelta(**{unit: rule.lo})
    as_of = rule.options.get("as_of") or ctx.as_of
    metric = A.freshness(col, ctx.dtype(col), max_age, as_of or datetime.now(timezone.utc))
    # an age from now on is another number for every part
    return metric if as_of else replace(metric, state=None)


def _exists(rule: Rule, ctx: Context) -> Metric:
    if not rule.columns:
        raise RuleError("ColumnExists needs a column")
    return A.has_values(rule.columns[:1], ctx.df.columns)


def _column_count(rule: Rule, ctx: Context) -> Metric:
    return A.has_values(ctx.df.columns, ctx.df.columns)


def _histogram(rule: Rule, ctx: Context) -> Metric:
    (col,) = _cols(rule, ctx, 1)
    value = rule.columns[1] if len(rule.columns) > 1 else None
    return G.histogram_values(col, value, **rule.options)


def _metric_change(rule: Rule, ctx: Context) -> Metric:
    """An aggregate, the period it is taken over, and optionally the season and the window in periods."""
    aggregate, period = _extra(rule, 0, "an aggregate"), _extra(rule, 1, "a period")
    options = dict(rule.options)
    for position, name in ((2, "season"), (3, "window")):
        if len(rule.columns) > position:
            options[name] = int(_number(rule, position, f"a {name}"))
    if min(options.get("season", 1), options.get("window", 1)) < 1:
        raise RuleError("season and window are numbers of periods")
    try:
        ctx.df.groupBy(F.expr(period)).agg(F.expr(aggregate).cast("double"))
    except (AnalysisException, ParseException):
        raise RuleError("aggregate and period do not fit the data set") from None
    return R.metric_change(aggregate, period, ctx.df.columns, **options)


# --- metrics over two data sets ------------------------------------------------


def _frame(rule: Rule, columns, build: Callable[[DataFrame, tuple], DataFrame]) -> Metric:
    identity = (rule.rule_type, rule.columns, tuple(rule.options.items()))
    return Metric(FRAME, identity, tuple(columns), build=build)


def _referential_integrity(rule: Rule, ctx: Context) -> Metric:
    """Child columns, then the parent's as ``dataset.column`` in the same order."""
    half = len(rule.columns) // 2
    child, parents = rule.columns[:half], rule.columns[half:]
    if not half or len(child) != len(parents) or not all("." in p for p in parents):
        raise RuleError("columns and as many dataset.column names are needed")
    name = parents[0].split(".", 1)[0]
    parent = ctx.reference(name)
    parent_cols = [p.split(".", 1)[1] for p in parents]
    for c in child:
        ctx.dtype(c)
    if missing := [c for c in parent_cols if c not in parent.columns]:
        raise RuleError(f"column {missing[0]!r} does not exist in {name!r}")
    for c, p in zip(child, parent_cols):
        _alike(ctx.dtype(c), parent.schema[p].dataType, f"columns {c!r} and {p!r}")
    return _frame(
        rule, child, lambda df, by: X.referential_integrity(df, child, parent, parent_cols, by)
    )


def _row_count_match(rule: Rule, ctx: Context) -> Metric:
    other = ctx.reference(_extra(rule, 0, "a data set"))
    return _frame(rule, (), lambda df, by: X.row_count_match(df, other, by))


def _aggregate_match(rule: Rule, ctx: Context) -> Metric:
    """Own aggregate, the other data set's name, its aggregate."""
    expression = _extra(rule, 0, "an aggregate")
    other = ctx.reference(_extra(rule, 1, "a data set"))
    other_expression = _extra(rule, 2, "the data set's aggregate")
    try:
        ctx.df.agg(F.expr(expression)), other.agg(F.expr(other_expression))
    except (AnalysisException, ParseException):
        raise RuleError("the aggregates do not fit the data sets") from None
    return _frame(
        rule,
        ctx.df.columns,
        lambda df, by: X.aggregate_match(df, expression, other, other_expression, by),
    )


def _dataset_match(rule: Rule, ctx: Context) -> Metric:
    """Data set name, comma-separated key columns, optionally the columns to agree on."""
    other = ctx.reference(_extra(rule, 0, "a data set"))
    keys, match = (
        [c.strip() for c in rule.columns[i].split(",")] if len(rule.columns) > i else []
        for i in (1, 2)
    )
    if not keys:
        raise RuleError("key columns are needed")
    match = match or [c for c in other.columns if c not in keys]
    for c in (*keys, *match):
        ctx.dtype(c)
        if c not in other.columns:
            raise RuleError(f"column {c!r} does not exist in the reference data set")
        _alike(ctx.dtype(c), other.schema[c].dataType, f"both columns {c!r}")

    def build(df: DataFrame, by) -> DataFrame:
        if missing := [c for c in by if c not in other.columns]:
            raise RuleError(f"partitions by {missing[0]!r}, which the reference data set lacks")
        return X.dataset_match(df, other, keys, match, by)

    return _frame(rule, (*keys, *match), build)


def _schema_match(rule: Rule, ctx: Context) -> Metric:
    other = ctx.reference(_extra(rule, 0, "a data set"))
    return _frame(rule, ctx.df.columns, lambda df, by: X.schema_share(df, other, by))


def _custom_sql(rule: Rule, ctx: Context) -> Metric:
    sql = _extra(rule, 0, "a query")
    spark = ctx.df.sparkSession

    def build(df: DataFrame, by) -> DataFrame:
        if by:
            raise RuleError("a query over whole data sets is not evaluated per partition")
        try:
            return X.custom_sql(spark, sql, {**ctx.references, "primary": df})
        except (AnalysisException, ParseException) as error:
            raise RuleError(f"query does not run: {error.getCondition()}") from None

    return _frame(rule, ctx.df.columns, build)


# Rule type -> metric. Types whose expression describes the metric come first.
METRICS: dict[str, Callable[[Rule, Context], Metric]] = {
    "HasSize": lambda rule, ctx: A.size(),
    "HasMin": _one(A.minimum, numeric=True),
    "HasMax": _one(A.maximum, numeric=True),
    "HasMean": _one(A.mean, numeric=True),
    "HasSum": _one(A.total, numeric=True),
    "HasStandardDeviation": _one(A.standard_deviation, numeric=True),
    "HasCorrelation": _two(A.correlation, numeric=True),
    "HasMinLength": _lengths(A.min_length),
    "HasMaxLength": _lengths(A.max_length),
    "HasApproxCountDistinct": _approx_distinct,
    "HasApproxQuantile": _quantile(A.approx_quantile),
    "HasExactQuantile": _quantile(Q.exact_quantile),
    "KllSketchSatisfies": _kll,
    "IsComplete": _completeness,
    "HasCompleteness": _completeness,
    "AreComplete": _any(A.all_complete),
    "HaveCompleteness": _any(A.all_complete),
    "AreAnyComplete": _any(A.any_complete),
    "HaveAnyCompleteness": _any(A.any_complete),
    "IsNonNegative": _signed(A.non_negative),
    "IsPositive": _signed(A.positive),
    "IsLessThan": _compared(A.less_than),
    "IsLessThanOrEqualTo": _compared(A.less_or_equal),
    "IsGreaterThan": _compared(A.greater_than),
    "IsGreaterThanOrEqualTo": _compared(A.greater_or_equal),
    "Satisfies": _satisfies,
    "ContainsCreditCardNumber": _one(A.credit_card),
    "ContainsEmail": _one(A.email),
    "ContainsURL": _one(A.url),
    "ContainsSocialSecurityNumber": _one(A.social_security_number),
    "IsUnique": _groups("uniqueness", 1),
    "HasUniqueness": _groups("uniqueness"),
    "HasDistinctness": _groups("distinctness"),
    "HasUniqueValueRatio": _groups("unique_value_ratio"),
    "HasNumberOfDistinctValues": _groups("distinct", 1),
    "IsPrimaryKey": _groups("primary_key"),
    "HasEntropy": _groups("entropy", 1),
    "HasMutualInformation": _two(G.mutual_information),
    "HasHistogramValues": _histogram,
    "ColumnExists": _exists,
    "ColumnCount": _column_count,
    "MetricChange": _metric_change,
    "ReferentialIntegrity": _referential_integrity,
    "RowCountMatch": _row_count_match,
    "AggregateMatch": _aggregate_match,
    "DatasetMatch": _dataset_match,
    "SchemaMatch": _schema_match,
    "CustomSql": _custom_sql,
}

# Types whose expression describes the values: the demand is the threshold, else all rows.
VALUE_METRICS: dict[str, Callable[[Rule, Context], Metric]] = {
    "IsContainedIn": _contained,
    "HasPattern": _pattern,
    "HasDataType": _data_type,
    "ColumnValues": _values,
    "ColumnLength": _length,
    "DataFreshness": _freshness,
}

# Other names of the same checks.
ALIASES = {
    "RowCount": "HasSize",
    "Completeness": "HasCompleteness",
    "DistinctValuesCount": "HasNumberOfDistinctValues",
    "Entropy": "HasEntropy",
    "Mean": "HasMean",
    "Sum": "HasSum",
    "StandardDeviation": "HasStandardDeviation",
    "Uniqueness": "HasUniqueness",
    "UniqueValueRatio": "HasUniqueValueRatio",
    "ColumnCorrelation": "HasCorrelation",
    "ColumnDataType": "HasDataType",
}


def _demand(rule: Rule, by_value: bool):
    if rule.assertion is not None:
        return assertion(rule.assertion)
    if rule.threshold_op:
        op, lo, hi, items = rule.threshold_op, rule.threshold_lo, rule.threshold_hi, None
    elif by_value or not rule.expression:
        return ALL_ROWS
    else:
        op, lo, hi, items = rule.op, rule.lo, rule.hi, rule.in_list
    if op not in SUPPORTED:
        raise RuleError(f"expression {rule.expression!r} is not supported")
    if op == "in":
        try:
            return Assertion("in", None, None, tuple(float(v) for v in items))
        except (TypeError, ValueError):
            raise RuleError("the metric is compared with numbers") from None
    if lo is None or (op == "between" and hi is None):
        raise RuleError("the metric is compared with numbers")
    return Assertion(op, lo, hi)


def compile_rule(rule: Rule, ctx: Context) -> Constraint:
    name = ALIASES.get(rule.rule_type, rule.rule_type)
    by_value = name in VALUE_METRICS
    compile_ = (VALUE_METRICS if by_value else METRICS).get(name)
    if compile_ is None:
        # Fixed format: the message of a skipped rule.
        return Constraint(rule, status="SKIP", message=f"Rule Type '{rule.rule_type}' is not implemented.")
    try:
        return Constraint(rule, compile_(rule, ctx), _demand(rule, by_value))
    except RuleError as error:
        return Constraint(rule, status="ERROR", message=str(error))
