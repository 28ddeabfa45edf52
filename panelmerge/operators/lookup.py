"""Lookups: joins with derived tables, and literal rule maps.

A lookup (name map, code -> label map) is derived from data, so its size isn't
known when the plan is written. It is an ordinary join: Spark broadcasts the
side once its measured bytes are under ``spark.sql.autoBroadcastJoinThreshold``,
and splits skewed partitions otherwise. Literal rule tables built from fixed
values are small by construction and are applied as map literals (no join).
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def map_literal(mapping: dict) -> Column:
    """A ``map<string,string>`` literal from a fixed Python dict."""
    if not mapping:
        return F.create_map().cast("map<string,string>")
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def replace_values(c, mapping: dict) -> Column:
    """Whole-value, one-step replacement (no chaining of rules)."""
    c = F.col(c) if isinstance(c, str) else c
    if not mapping:
        return c
    return F.coalesce(F.try_element_at(map_literal(mapping), c), c)
