"""Row predicates behind the compliance checks. Each returns a boolean Column."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, functions as F, types as T

from plumbline.functions.columns import identifier, is_string, literal, ref, typed

# Text shapes looked for by the contains* checks. One character before the
# @ tells as much about there being an address as all of them, at linear cost.
EMAIL = r"[A-Za-z0-9._%+-]@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
URL = r"https?://[^\s/$.?#][^\s]*"
SOCIAL_SECURITY = (
    r"(?:00[1-9]|0[1-9]\d|[1-578]\d\d|6[0-57-9]\d|66[0-57-9])(?<=\b\d{3})-\d{2}-\d{4}\b"
)
CARD = r"\d(?<=\b\d)(?:[ -]?\d){12}"
# Digits of a card, and a card of so many from any word's start to any word's end.
CARD_SIZES = range(13, 20)
CARD_OF = r"\b(?=(\d(?:[ -]?\d){%d}\b))"

# Text shapes that decide the inferred type of a string column.
INTEGRAL = r"^[+-]?\d+\z"
FRACTIONAL = r"^[+-]?(\d+\.\d*|\.\d+|\d+[eE][+-]?\d+|\d+\.\d*[eE][+-]?\d+)\z"
BOOLEAN = r"^(?i)(true|false)\z"


def contained(c: Column, dtype: T.DataType, values: Sequence[object]) -> Column:
    """NULL, or one of ``values``."""
    return c.isNull() | c.isin(*[typed(v, dtype) for v in values])


def is_number(c: Column, dtype: T.DataType) -> Column:
    """Not NaN, which Spark orders above all numbers and which meets no demand here."""
    return ~F.isnan(c) if isinstance(dtype, (T.FloatType, T.DoubleType)) else F.lit(True)


def non_negative(c: Column, dtype: T.DataType) -> Column:
    return c.isNull() | ((c >= 0) & is_number(c, dtype))


def positive(c: Column, dtype: T.DataType) -> Column:
    return c.isNull() | ((c > 0) & is_number(c, dtype))


def filled(c: Column, dtype: T.DataType, blank_as_null: bool = False) -> Column:
    """Not NULL; with ``blank_as_null`` a text of blanks is empty too."""
    if blank_as_null and is_string(dtype):
        return F.trim(c) != ""
    return c.isNotNull()


def matches(c: Column, pattern: str) -> Column:
    return c.cast("string").rlike(pattern)


def _with(c: Column, mark: str, pattern: str) -> Column:
    """A match of a pattern that cannot do without ``mark``, which is looked for first:
    a byte search in place of decoding the text and running the pattern over it."""
    text = c.cast("string")
    return text.contains(mark) & text.rlike(pattern)


def contains_email(c: Column) -> Column:
    return _with(c, "@", EMAIL)


def contains_url(c: Column) -> Column:
    return _with(c, "://", URL)


def contains_social_security_number(c: Column) -> Column:
    return _with(c, "-", SOCIAL_SECURITY)


def contains_credit_card_number(c: Column) -> Column:
    """Thirteen to nineteen digits in card spelling that pass the Luhn test.

    Digits that go on, such as an expiry date or a code, do not hide a card: every stretch from
    the start of a group of digits to the end of one is tried. Most texts fail the first search.
    """
    text = c.cast("string")
    found = F.concat(
        *(F.regexp_extract_all(text, F.lit(CARD_OF % (n - 1)), F.lit(1)) for n in CARD_SIZES)
    )
    valid = F.exists(
        found, lambda n: F.call_function("luhn_check", F.regexp_replace(n, "[ -]", ""))
    )
    return F.when(text.rlike(CARD), valid).when(text.isNotNull(), False)


# What any number or truth value has: looked at first, so that long texts are passed over
# without being decoded. Numbers begin with one of + - . 0-9, which sort from '+' to '9'.
_NUMBER_START = "{c} >= '+' AND {c} < ':'"
_BOOLEAN_SIZE = "octet_length({c}) BETWEEN 4 AND 5"


def shape_sql(c: str) -> dict[str, str]:
    """Conditions on a text, as SQL: reads as an integer, a fraction, a truth value."""
    number, size = _NUMBER_START.format(c=c), _BOOLEAN_SIZE.format(c=c)
    return {
        "integral": f"({number} AND {c} RLIKE {literal(INTEGRAL)})",
        "fractional": f"({number} AND {c} RLIKE {literal(FRACTIONAL)})",
        "boolean": f"({size} AND {c} RLIKE {literal(BOOLEAN)})",
    }


def castable(col: str, type_name: str) -> Column:
    """Whether a non-NULL value can be read as ``type_name``.

    Takes the profiler's kinds (Integral, Fractional, Numeric, Boolean, String) or any
    Spark type name.
    """
    kind = type_name.lower()
    shapes = shape_sql(f"CAST({identifier(col)} AS STRING)")
    if kind in ("integral", "boolean"):
        return F.expr(shapes[kind])
    if kind in ("fractional", "numeric"):
        return F.expr(f"{shapes['integral']} OR {shapes['fractional']}")
    if kind == "string":
        return ref(col).isNotNull()
    return ref(col).try_cast(type_name).isNotNull()


def fresh(c: Column, dtype: T.DataType, max_age: timedelta, as_of: datetime) -> Column:
    """``as_of - c <= max_age``, compared in the column's own time type; times are UTC."""
    if as_of.tzinfo is not None:
        as_of = as_of.astimezone(timezone.utc).replace(tzinfo=None)
    oldest = F.lit((as_of - max_age).isoformat(sep=" "))
    if isinstance(dtype, T.DateType):
        return c >= F.to_date(oldest.cast("timestamp_ntz"))
    if isinstance(dtype, T.TimestampType):
        return c >= F.concat(oldest, F.lit("Z")).cast("timestamp")
    return c.cast("timestamp_ntz") >= oldest.cast("timestamp_ntz")


def _bound(value, dtype: T.DataType) -> Column:
    """Number of a rule as a literal, whole ones without a fraction; a text in the column's type."""
    if isinstance(value, float) and value.is_integer():
        value = int(value)
    return F.lit(value) if isinstance(value, (int, float)) else typed(value, dtype)


def _comparable(c: Column, dtype: T.DataType, limit) -> Column:
    """A text compared with a number counts by its number, if it has one."""
    numeric = isinstance(limit, (int, float))
    return c.try_cast("double") if numeric and is_string(dtype) else c


def compare(c: Column, dtype: T.DataType, op: str, lo, hi, values) -> Column:
    """Value expression of a rule: in, matches, between (exclusive) or a comparison."""
    if op == "in":
        return contained(c, dtype, values)
    if op == "matches":
        return c.isNull() | matches(c, values[0])
    if op == "between":
        low, high = _bound(lo, dtype), _bound(hi, dtype)
        value = _comparable(c, dtype, lo)
        return c.isNull() | ((value > low) & (value < high))
    limit = values[0] if values else lo
    bound, value = _bound(limit, dtype), _comparable(c, dtype, limit)
    kind = T.DoubleType() if value is not c else dtype
    test = {
        "=": value == bound,
        ">": (value > bound) & is_number(value, kind),
        "<": value < bound,
        ">=": (value >= bound) & is_number(value, kind),
        "<=": value <= bound,
    }
    return c.isNull() | test[op]
