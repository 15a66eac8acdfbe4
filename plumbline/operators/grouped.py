"""Checks answered by group sizes: one grouped count for all key sets, then one small aggregate.

Each row is counted under every key set at once, tagged with the set's number, so that the table is
read and shuffled once however many key sets there are. The grouped count combines on the map side, so a key that holds a third of the rows
reaches the shuffle as one partial count per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F, types as T

from plumbline.functions.columns import compact_key, every, ref, some
from plumbline.operators.metric import FRAME, GROUPS, Metric, RuleError

N = "_n"
# Statistics that are 0 where there are no groups; the others are NULL.
COUNTS = ("distinct", "bins")


def key_names(width: int) -> list[str]:
    return [f"_k{i}" for i in range(width)]


def group_sizes(df: DataFrame, keys: Sequence[Column], by: Sequence[str] = ()) -> DataFrame:
    """``by`` columns, ``_k0.._kn`` and the group size ``_n``; NULL keys form groups too."""
    names = key_names(len(keys))
    narrow = df.select(*map(ref, by), *[k.alias(n) for k, n in zip(keys, names)])
    return narrow.groupBy(*map(ref, by), *names).agg(F.count(F.lit(1)).alias(N))


def statistics(width: int) -> dict[str, Column]:
    """Aggregates over a group-size frame with ``width`` key columns."""
    keys = [F.col(k) for k in key_names(width)]
    return statistics_of(some(k.isNotNull() for k in keys), every(k.isNotNull() for k in keys))


def statistics_of(keyed: Column, complete: Column) -> dict[str, Column]:
    """Aggregates over groups of which some key, or each, is not NULL.

    Rows whose keys are all NULL stand outside of M, D and U.
    """
    n = F.col(N)
    m = F.sum(F.when(keyed, n).otherwise(0))
    d = F.count_if(keyed)
    u = F.count_if(keyed & (n == 1))
    n_ln_n = F.sum(F.when(keyed, n * F.ln(n)).otherwise(0.0))
    return {
        "uniqueness": F.try_divide(u, m),
        "distinctness": F.try_divide(d, m),
        "unique_value_ratio": F.try_divide(u, d),
        "distinct": d,
        "primary_key": F.try_divide(F.count_if(complete & (n == 1)), F.sum(n)),
        "entropy": F.when(m > 0, F.ln(m) - n_ln_n / m),
        "bins": F.count(F.lit(1)),
    }


def grouped(
    statistic: str,
    cols: Sequence[str],
    dtypes: Sequence[T.DataType],
    binning: Column | None = None,
) -> Metric:
    """``binning`` replaces the single column by an expression of it."""
    if binning is not None:
        keys = (binning,)
    else:
        keys = tuple(compact_key(ref(c), t) for c, t in zip(cols, dtypes))
    expr = statistics(len(keys))[statistic].cast("double")
    label = (str(binning),) if binning is not None else ()
    return Metric(GROUPS, (statistic, *cols, *label), tuple(cols), expr, keys=keys)


# Key sets counted in one exchange, and key columns that a row of it has at most.
SETS_PER_PASS, SLOTS_PER_PASS = 32, 12
TAG = "_set"


def key_types(df: DataFrame, key_sets: Sequence[Sequence[Column]]) -> list[list[T.DataType]]:
    """The types of the keys of each set, from one look at the plan."""
    named = [k.alias(f"k{i}_{j}") for i, keys in enumerate(key_sets) for j, k in enumerate(keys)]
    found = iter(df.select(*named).schema)
    return [[next(found).dataType for _ in keys] for keys in key_sets]


def slots_of(key_types: Sequence[Sequence[T.DataType]]) -> tuple[list[T.DataType], list[list[int]]]:
    """Typed slots that hold any one of the key sets, and which slots each set fills.

    Keys of one type share slots, so the row stays narrow and every key keeps its own type.
    """
    types: list[T.DataType] = []
    filled: list[list[int]] = []
    for keys in key_types:
        own: list[int] = []
        for dtype in keys:
            free = [i for i, t in enumerate(types) if t == dtype and i not in own]
            if not free:
                types.append(dtype)
            own.append(free[0] if free else len(types) - 1)
        filled.append(own)
    return types, filled


def tagged_sizes(
    df: DataFrame, key_sets: Sequence[Sequence[Column]], by: Sequence[str] = ()
) -> tuple[DataFrame, list[str]]:
    """Group sizes of several key sets from one scan and one exchange, and the names of their slots.

    A row becomes a row per key set with the set's number; a slot that the set does not fill is NULL.
    Groups are equal where number and keys are, so counts are exact; tasks count before the exchange.
    """
    types, filled = slots_of(key_types(df, key_sets))
    names = key_names(len(types))
    cells: list[Column] = []
    for number, (keys, own) in enumerate(zip(key_sets, filled)):
        held = dict(zip(own, keys))
        nothing = (F.lit(None).cast(t) for t in types)
        cells += [F.lit(number), *(held.get(i, none) for i, none in enumerate(nothing))]
    rows = df.select(*map(ref, by), F.stack(F.lit(len(key_sets)), *cells).alias(TAG, *names))
    return rows.groupBy(*map(ref, by), TAG, *names).agg(F.count(F.lit(1)).alias(N)), names


def statistics_by_set(
    df: DataFrame, key_sets: Sequence[Sequence[Column]], by: Sequence[str] = ()
) -> DataFrame:
    """``by`` columns, the number of the key set and its statistics, a row each."""
    sizes, names = tagged_sizes(df, key_sets, by)
    held = sum((F.col(k).isNotNull().cast("int") for k in names), F.lit(0))
    width = F.get(F.array(*[F.lit(len(k)) for k in key_sets]), F.col(TAG))
    found = statistics_of(held > 0, held == width)
    return sizes.groupBy(*map(ref, by), TAG).agg(*[c.alias(s) for s, c in found.items()])


def passes(df: DataFrame, key_sets: dict[tuple, list[Metric]]) -> list[list[Metric]]:
    """The metrics of the key sets, dealt to as few passes as the bounds on a pass allow."""
    sets = list(key_sets.values())
    try:
        types = key_types(df, [metrics[0].keys for metrics in sets])
    except AnalysisException:  # a key that does not fit the data set is found out alone
        return sets
    out: list[list[int]] = []
    for i in range(len(sets)):
        if out and len(out[-1]) < SETS_PER_PASS:
            if len(slots_of([types[j] for j in [*out[-1], i]])[0]) <= SLOTS_PER_PASS:
                out[-1].append(i)
                continue
        out.append([i])
    return [[m for i in own for m in sets[i]] for own in out]


def statistics_frame(df: DataFrame, metrics: Sequence[Metric], by: Sequence[str], names: Sequence[str]) -> DataFrame:
    """``by`` columns and each metric under its name: one exchange for all key sets."""
    by_cols = list(map(ref, by))
    sets: dict[tuple, int] = {}
    for m in metrics:
        sets.setdefault(key_set(m), len(sets))
    if len(sets) == 1:
        sizes = group_sizes(df, metrics[0].keys, by)
        return sizes.groupBy(*by_cols).agg(*[m.expr.alias(n) for m, n in zip(metrics, names)])
    keys = {sets[key_set(m)]: m.keys for m in metrics}
    found = statistics_by_set(df, [keys[i] for i in range(len(keys))], by)
    values = []
    for m, name in zip(metrics, names):
        own = F.max(F.when(F.col(TAG) == sets[key_set(m)], F.col(m.identity[0])))
        if m.identity[0] in COUNTS:  # of no rows
            own = F.coalesce(own, F.lit(0))
        values.append(own.cast("double").alias(name))
    return found.groupBy(*by_cols).agg(*values)


def key_set(metric: Metric) -> tuple:
    """Metrics with the same key set share one grouped count."""
    return metric.identity[1:]


# --- two columns ---------------------------------------------------------------


def mutual_information_frame(
    df: DataFrame, a: str, b: str, by: Sequence[str] = ()
) -> DataFrame:
    """H(a) + H(b) - H(a, b) in nats, over rows where both are non-NULL.

    The pairs are counted first; the marginals are grouping sets of those counts, so
    the rows of the table are never expanded.
    """
    both = df.where(ref(a).isNotNull() & ref(b).isNotNull())
    keys = [compact_key(ref(c), df.schema[c].dataType) for c in (a, b)]
    pairs = group_sizes(both, keys, by)
    by_cols = list(map(ref, by))
    k0, k1 = F.col("_k0"), F.col("_k1")
    margins = pairs.groupingSets(
        [[*by_cols, k0], [*by_cols, k1], [*by_cols, k0, k1]], *by_cols, k0, k1
    ).agg(F.sum(N).alias("_c"), F.grouping_id().alias("_set"))
    c = F.col("_c")
    n_ln_n = c * F.ln(c)
    joint = F.col("_set") == 0
    m = F.sum(F.when(joint, c))
    signed = F.sum(F.when(joint, n_ln_n).otherwise(-n_ln_n))
    return margins.groupBy(*by_cols).agg((F.ln(m) + signed / m).alias("metric"))


def mutual_information(a: str, b: str) -> Metric:
    return Metric(
        FRAME,
        ("mutual_information", a, b),
        (a, b),
        build=lambda df, by: mutual_information_frame(df, a, b, by),
    )


# --- histogram -----------------------------------------------------------------


def bin_shares(
    df: DataFrame, col: str, value: str | None, binning: Column | None, by: Sequence[str]
) -> DataFrame:
    """Per partition ``metric``: the share of one bin, or the number of bins."""
    dtype = df.schema[col].dataType
    key = binning if binning is not None else compact_key(ref(col), dtype)
    sizes = group_sizes(df, [key], by).groupBy(*map(ref, by))
    if value is None:
        return sizes.agg(F.count(F.lit(1)).cast("double").alias("metric"))
    wanted = F.lit(value) if binning is not None else compact_key(F.lit(value), dtype)
    own = F.sum(F.when(F.col("_k0").cast("string") == wanted, F.col(N)).otherwise(0))
    return sizes.agg(F.try_divide(own, F.sum(N)).alias("metric"))


def histogram(
    df: DataFrame, col: str, binning: Column | None = None, max_bins: int | None = None
) -> DataFrame:
    """``(value, count, ratio)`` of every bin; NULL is a bin of its own.

    ``max_bins`` asks for a report of the largest bins only, ties ordered by value. Ratios
    are over all rows of the table in any case, which are summed from the groups' sizes.
    """
    key = binning if binning is not None else ref(col)
    sizes = group_sizes(df, [key])
    rows = sizes.agg(F.sum(N)).scalar()
    bins = sizes.select(
        F.col("_k0").cast("string").alias("value"),
        F.col(N).alias("count"),
        (F.col(N) / rows).alias("ratio"),
    )
    if max_bins is None:
        return bins
    return bins.orderBy(F.desc("count"), F.asc_nulls_first("value")).limit(max_bins)


def histogram_values(
    col: str,
    value: str | None = None,
    binning: Column | None = None,
    max_bins: int | None = None,
) -> Metric:
    """Ratio of one bin of the histogram (0 when it is not in it), or the number of bins."""

    def build(df: DataFrame, by: Sequence[str]) -> DataFrame:
        if max_bins is None:
            return bin_shares(df, col, value, binning, by)
        if by:
            raise RuleError("a report of the largest bins is not made per partition")
        bins = histogram(df, col, binning, max_bins)
        if value is None:
            return bins.agg(F.count(F.lit(1)).cast("double").alias("metric"))
        ratio = F.max(F.when(F.col("value") == value, F.col("ratio")))
        return bins.agg(F.coalesce(ratio, F.lit(0.0)).alias("metric"))

    label = "" if binning is None else str(binning)
    return Metric(FRAME, ("histogram", col, value, label, max_bins), (col,), build=build)
