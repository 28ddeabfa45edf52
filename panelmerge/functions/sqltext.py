"""Helpers for expressions written as SQL text.

Generated expression lists (one aggregate per metric, one struct per report
row) are written as SQL text and parsed once by Spark, instead of being
assembled from many small Column objects on the Python side.
"""

from __future__ import annotations


def q(name: str) -> str:
    """Quote an identifier."""
    return "`" + name.replace("`", "``") + "`"


def lit(value) -> str:
    """A SQL literal: strings quoted and escaped, floats as DOUBLE, ints as is."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(value, float):
        return f"CAST({value!r} AS DOUBLE)"
    return repr(value)


def num(value) -> str:
    """A DOUBLE literal (``100.0`` alone would be DECIMAL in Spark SQL)."""
    return f"CAST({float(value)!r} AS DOUBLE)"
