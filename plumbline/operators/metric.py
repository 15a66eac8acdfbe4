"""The unit shared by all checks: one number per data set (or per partition of it)."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame

SCAN = "scan"  # plain aggregates: one code-generated pass
SKETCH = "sketch"  # sketch aggregates: object buffers, kept apart from the plain pass
GROUPS = "groups"  # a statistic of the group sizes of one key set
FRAME = "frame"  # needs a plan of its own (two tables, several groupings)


class RuleError(ValueError):
    """The rule cannot be run on this data set; becomes an ERROR result."""


@dataclass(frozen=True)
class State:
    """What each part of a data set keeps of a metric, and the metric of the merged parts.

    ``fields``: aggregates over a part's rows, by the name that says how they merge (``states.MERGED``).
    ``finish``: the metric, from the merged fields.
    """

    fields: Mapping[str, Column]
    finish: Callable[[], Column]


@dataclass(frozen=True)
class Metric:
    """``identity`` says when two rules mean the same number, which is then computed once."""

    family: str
    identity: tuple
    columns: tuple[str, ...] = ()
    expr: Column | None = field(default=None, compare=False)
    build: Callable[[DataFrame, Sequence[str]], DataFrame] | None = field(
        default=None, compare=False
    )
    keys: tuple[Column, ...] = field(default=(), compare=False)
    state: State | None = field(default=None, compare=False)
