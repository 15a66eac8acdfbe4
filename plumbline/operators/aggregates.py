"""Checks answered by plain or sketch aggregates over one scan."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F, types as T

from plumbline.functions import predicates as P
from plumbline.functions.columns import every, identifier, mean_sql, ref, share, some, sum_sql
from plumbline.operators.metric import SCAN, SKETCH, Metric, State


def _scan(name: str, columns: Sequence[str], expr: Column, *extra, state: State | None = None) -> Metric:
    return Metric(SCAN, (name, *columns, *extra), tuple(columns), expr.cast("double"), state=state)


def _sketch(name: str, columns: Sequence[str], expr: Column, *extra, state: State | None = None) -> Metric:
    return Metric(SKETCH, (name, *columns, *extra), tuple(columns), expr.cast("double"), state=state)


# --- what parts keep of a metric -------------------------------------------------


def _kept(field: str, expr: Column) -> State:
    """One number that merges by itself."""
    return State({field: expr}, lambda: F.col(field))


def _ratio(hits: Column, n: Column) -> State:
    return State({"hits": hits, "n": n}, lambda: F.try_divide("hits", "n"))


def _shared(name: str, columns: Sequence[str], test: Column, *extra) -> Metric:
    """Share of all rows that meet a test."""
    state = _ratio(F.count_if(test), F.count(F.lit(1)))
    return _scan(name, columns, share(test), *extra, state=state)


def _moments(a: Column, b: Column | None = None) -> dict[str, Column]:
    """Number, means and centred sums of the rows where all are given."""
    if b is not None:
        both = a.isNotNull() & b.isNotNull()
        a, b = F.when(both, a), F.when(both, b)
    n = F.count(a)
    fields = {"n": n, "mean_a": F.avg(a), "square_a": F.var_pop(a) * n}
    if b is not None:
        fields |= {"mean_b": F.avg(b), "square_b": F.var_pop(b) * n, "product": F.covar_pop(a, b) * n}
    return fields


# --- size and plain statistics -------------------------------------------------


def size() -> Metric:
    return _scan("size", (), F.count(F.lit(1)), state=_kept("n", F.count(F.lit(1))))


def minimum(col: str) -> Metric:
    return _scan("min", (col,), F.min(ref(col)), state=_kept("low", F.min(ref(col))))


def maximum(col: str) -> Metric:
    return _scan("max", (col,), F.max(ref(col)), state=_kept("high", F.max(ref(col))))


def mean(col: str) -> Metric:
    fields = {"total": F.expr(sum_sql(identifier(col))), "n": F.count(ref(col))}
    state = State(fields, lambda: F.try_divide("total", "n"))
    return _scan("mean", (col,), F.expr(mean_sql(identifier(col))), state=state)


def total(col: str) -> Metric:
    expr = F.expr(sum_sql(identifier(col)))
    return _scan("sum", (col,), expr, state=_kept("total", expr))


def standard_deviation(col: str) -> Metric:
    state = State(_moments(ref(col).cast("double")), lambda: F.sqrt(F.try_divide("square_a", "n")))
    return _scan("stddev", (col,), F.stddev_pop(ref(col)), state=state)


def correlation(a: str, b: str) -> Metric:
    x, y = ref(a).cast("double"), ref(b).cast("double")
    both = x.isNotNull() & y.isNotNull()
    spread = F.stddev_pop(F.when(both, x)) * F.stddev_pop(F.when(both, y))
    # corr() itself fails where a column does not vary
    expr = F.try_divide(F.covar_pop(x, y), spread)
    root = lambda: F.sqrt(F.col("square_a")) * F.sqrt(F.col("square_b"))
    state = State(_moments(x, y), lambda: F.try_divide("product", root()))
    return _scan("corr", (a, b), expr, state=state)


def min_length(col: str) -> Metric:
    shortest = F.min(F.length(ref(col)))
    return _scan("min_length", (col,), shortest, state=_kept("low", shortest))


def max_length(col: str) -> Metric:
    longest = F.max(F.length(ref(col)))
    return _scan("max_length", (col,), longest, state=_kept("high", longest))


# --- completeness --------------------------------------------------------------


def completeness(col: str, dtype: T.DataType, blank_as_null: bool = False) -> Metric:
    filled = P.filled(ref(col), dtype, blank_as_null)
    return _shared("completeness", (col,), filled, blank_as_null)


def all_complete(cols: Sequence[str]) -> Metric:
    return _shared("all_complete", cols, every(ref(c).isNotNull() for c in cols))


def any_complete(cols: Sequence[str]) -> Metric:
    return _shared("any_complete", cols, some(ref(c).isNotNull() for c in cols))


def has_values(cols: Sequence[str], known: Sequence[str]) -> Metric:
    """How many of ``cols`` hold at least one value; a column that is gone holds none."""
    held = [F.when(F.count(ref(c)) > 0, 1).otherwise(0) for c in cols if c in known]
    counted = sum(held[1:], held[0]) if held else F.max(F.lit(0))
    state = _kept("high", counted) if len(cols) == 1 else None  # of more, the same ones must have held values
    return _scan("has_values", [c for c in cols if c in known], counted, *cols, state=state)


# --- compliance: share of rows meeting a predicate -----------------------------


def contained(col: str, dtype: T.DataType, values: Sequence[object]) -> Metric:
    test = P.contained(ref(col), dtype, values)
    return _shared("contained", (col,), test, tuple(map(str, values)))


def non_negative(col: str, dtype: T.DataType) -> Metric:
    return _shared("non_negative", (col,), P.non_negative(ref(col), dtype))


def positive(col: str, dtype: T.DataType) -> Metric:
    return _shared("positive", (col,), P.positive(ref(col), dtype))


def satisfies(condition: str, columns: Sequence[str]) -> Metric:
    """``columns``: what the condition may read, so that its pass is given them."""
    test = F.expr(condition)
    state = _ratio(F.count_if(test), F.count(F.lit(1)))
    return Metric(SCAN, ("satisfies", condition), tuple(columns), share(test).cast("double"), state=state)


def pattern(col: str, regex: str) -> Metric:
    return _shared("pattern", (col,), P.matches(ref(col), regex), regex)


def credit_card(col: str) -> Metric:
    return _shared("card", (col,), P.contains_credit_card_number(ref(col)))


def email(col: str) -> Metric:
    return _shared("email", (col,), P.contains_email(ref(col)))


def url(col: str) -> Metric:
    return _shared("url", (col,), P.contains_url(ref(col)))


def social_security_number(col: str) -> Metric:
    return _shared("ssn", (col,), P.contains_social_security_number(ref(col)))


def less_than(a: str, b: str) -> Metric:
    return _shared("lt", (a, b), ref(a) < ref(b))


def less_or_equal(a: str, b: str) -> Metric:
    return _shared("le", (a, b), ref(a) <= ref(b))


def greater_than(a: str, b: str) -> Metric:
    return _shared("gt", (a, b), ref(a) > ref(b))


def greater_or_equal(a: str, b: str) -> Metric:
    return _shared("ge", (a, b), ref(a) >= ref(b))


def data_type(col: str, type_name: str) -> Metric:
    """Share of the non-NULL values that can be read as ``type_name``."""
    c = ref(col)
    readable = F.count_if(P.castable(col, type_name))
    expr = F.try_divide(readable, F.count(c))
    return _scan("data_type", (col,), expr, type_name.lower(), state=_ratio(readable, F.count(c)))


def values(col: str, dtype: T.DataType, op: str, lo, hi, items: Sequence[str]) -> Metric:
    """Share of rows whose value meets the expression; NULL is no violation."""
    test = P.compare(ref(col), dtype, op, lo, hi, items)
    return _shared("values", (col,), test, op, lo, hi, tuple(items))


def length(col: str, op: str, lo, hi, items: Sequence[str]) -> Metric:
    """Share of rows whose text length meets the expression; NULL has no length."""
    c = F.length(ref(col))
    test = c.isNotNull() & P.compare(c, T.IntegerType(), op, lo, hi, items)
    return _shared("length", (col,), test, op, lo, hi, tuple(items))


def freshness(col: str, dtype: T.DataType, max_age: timedelta, as_of: datetime) -> Metric:
    test = P.fresh(ref(col), dtype, max_age, as_of)
    return _shared("freshness", (col,), test, max_age, as_of)


# --- sketches ------------------------------------------------------------------


def approx_distinct(col: str, rsd: float = 0.05) -> Metric:
    # a sketch of 2^k registers errs by 1.04 / 2^(k/2)
    k = min(21, max(4, math.ceil(2 * math.log2(1.04 / rsd))))
    sketch = F.hll_sketch_agg(ref(col).cast("string"), F.lit(k))
    state = State({"hll": sketch}, lambda: F.hll_sketch_estimate("hll"))
    return _sketch("approx_distinct", (col,), F.approx_count_distinct(ref(col), rsd), rsd, state=state)


def approx_quantile(col: str, q: float, accuracy: int = 10000) -> Metric:
    expr = F.percentile_approx(ref(col), q, accuracy)
    state = _kll_state(col, 4096, lambda s: F.kll_sketch_get_quantile_double(s, F.lit(q)))
    return _sketch("approx_quantile", (col,), expr, q, accuracy, state=state)


def _kll(col: str, k: int, read: Callable[[Column], Column]) -> Column:
    """What is read off the KLL sketch of a column, which passes over NULL and NaN; an empty
    sketch cannot be read."""
    c = ref(col).cast("double")
    sketch = F.kll_sketch_agg_double(c, F.lit(k))
    return F.when(F.count_if(c.isNotNull() & ~F.isnan(c)) > 0, read(sketch))


def _kll_state(col: str, k: int, read: Callable[[Column], Column]) -> State:
    c = ref(col).cast("double")
    fields = {"n": F.count_if(c.isNotNull() & ~F.isnan(c)), "kll": F.kll_sketch_agg_double(c, F.lit(k))}
    return State(fields, lambda: F.when(F.col("n") > 0, read(F.col("kll"))))


def kll_quantile(col: str, q: float, k: int = 800) -> Metric:
    """Quantile read off a KLL sketch; ``k`` sets its size and so its error."""
    read = lambda s: F.kll_sketch_get_quantile_double(s, F.lit(q))
    return _sketch("kll", (col,), _kll(col, k, read), q, k, state=_kll_state(col, k, read))


def kll_buckets(df: DataFrame, col: str, buckets: int = 64, k: int = 2048) -> DataFrame:
    """``(bucket, low, high, count)`` of equal-width buckets from the least to the greatest value.

    Counts are differences of ranks read off one KLL sketch; a bucket takes its upper bound and
    the first one the least value too. ``k`` sets the sketch's size and so the error. The bounds,
    one row, are read first: ranks are looked up at literals only.
    """
    c = F.nullif(ref(col).cast("double"), F.lit(float("nan")))
    lo, hi, n = df.agg(F.min(c), F.max(c), F.count(c)).first()
    if not n:
        lo = hi = 0.0
    edges = [lo + (hi - lo) * i / buckets for i in range(buckets + 1)]
    inner = F.array(*map(F.lit, edges[1:-1])) if buckets > 1 else F.array().cast("array<double>")
    sketch = F.kll_sketch_agg_double(c, F.lit(k))
    ranks = F.concat(F.array(F.lit(0.0)), F.kll_sketch_get_rank_double(sketch, inner), F.array(F.lit(1.0)))
    counted = df.where(F.lit(bool(n))).agg(F.count(c).alias("n"), ranks.alias("ranks")).where("n > 0")
    i, bounds = F.col("bucket"), F.array(*map(F.lit, edges))
    return counted.select(
        "n", "ranks", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket")
    ).select(
        "bucket",
        F.get(bounds, i).alias("low"),
        F.get(bounds, i + 1).alias("high"),
        F.round((F.get("ranks", i + 1) - F.get("ranks", i)) * F.col("n")).cast("long").alias("count"),
    )


def kll_rank(col: str, value: float, k: int = 800) -> Metric:
    """Share of values at or below ``value``, read off a KLL sketch."""
    read = lambda s: F.kll_sketch_get_rank_double(s, F.lit(value))
    return _sketch("kll_rank", (col,), _kll(col, k, read), value, k, state=_kll_state(col, k, read))
