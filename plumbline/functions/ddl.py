"""Warehouse column types as Spark types."""

from __future__ import annotations

import re
import warnings

# Warehouse type name -> Spark type name.
DDL_TO_SPARK = {
    "bigint": "long",
    "int": "int",
    "integer": "int",
    "smallint": "short",
    "boolean": "boolean",
    "date": "date",
    "timestamp": "timestamp",
    "string": "string",
}


def spark_type(ddl_type: str) -> str:
    """Spark type name for a warehouse type; an unknown one becomes string, with a warning."""
    name = re.sub(r"\s+", "", ddl_type.lower())
    if name in DDL_TO_SPARK:
        return DDL_TO_SPARK[name]
    if name.startswith("double"):
        return "double"
    if m := re.fullmatch(r"(?:numeric|decimal)(\(\d+(?:,(\d+))?\))?", name):
        return "long" if m[2] == "0" else "decimal" + (m[1] or "")
    if "char" in name:
        return "string"
    warnings.warn(f"unsupported column type {ddl_type!r}, read as string", stacklevel=2)
    return "string"
