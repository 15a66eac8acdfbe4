"""What a rule demands of its metric, as a Column condition on that metric."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column

NUMBER = r"[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?"
SUPPORTED = ("=", ">", "<", ">=", "<=", "between", "in")


@dataclass(frozen=True)
class Assertion:
    """A comparison with one number, an open interval, or a list of numbers."""

    op: str = "="
    lo: float | None = 1.0
    hi: float | None = None
    values: tuple[float, ...] = ()

    @property
    def text(self) -> str:
        if self.op == "between":
            return f"between {self.lo:.15g} and {self.hi:.15g}"
        if self.op == "in":
            return "in [" + ",".join(f"{v:.15g}" for v in self.values) + "]"
        return f"{self.op} {self.lo:.15g}"

    def holds(self, metric: Column) -> Column:
        if self.op == "between":
            return (metric > self.lo) & (metric < self.hi)
        if self.op == "in":
            return metric.isin(*self.values)
        tests = {
            "=": metric == self.lo,
            ">": metric > self.lo,
            "<": metric < self.lo,
            ">=": metric >= self.lo,
            "<=": metric <= self.lo,
        }
        return tests[self.op]


@dataclass(frozen=True)
class Custom:
    """A Python function from the metric Column to a boolean Column."""

    function: Callable[[Column], Column]
    text: str = "the given condition"

    def holds(self, metric: Column) -> Column:
        return self.function(metric)


ALL_ROWS = Assertion()


def assertion(value) -> Assertion | Custom:
    """Accepts ``None`` (metric = 1), a text such as ``">= 3"``, a number or a function."""
    if value is None:
        return ALL_ROWS
    if isinstance(value, (Assertion, Custom)):
        return value
    if callable(value):
        return Custom(value)
    if isinstance(value, (int, float)):
        return Assertion("=", float(value))
    text = str(value).strip()
    if m := re.fullmatch(rf"between\s+({NUMBER})\s+and\s+({NUMBER})", text):
        return Assertion("between", float(m[1]), float(m[2]))
    if m := re.fullmatch(r"in\s*\[(.*)\]", text):
        return Assertion("in", None, None, tuple(float(v) for v in m[1].split(",")))
    if m := re.fullmatch(rf"(>=|<=|=|>|<)\s*({NUMBER})", text):
        return Assertion(m[1], float(m[2]))
    raise ValueError(f"not an assertion: {text!r}")
