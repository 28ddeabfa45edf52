"""Values within validity periods: an interval join by bins of the intervals' own size.

Bins of one width make a long interval fall into many of them. Here an interval goes to the level whose bins are at
least as wide as it is (powers of ``fanout``), where it touches two bins at most, and a point looks into one bin on each
level that its key has intervals on. Both sides meet by (key, level, bin), an equality that Spark shuffles and spreads, so a
hot key's points are spread over its bins; the exact comparison follows.

A key of few intervals needs no bins: its points meet all of them by the key alone and travel once, not once a level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegralType, TimestampNTZType, TimestampType

OPEN = 99  # the level of intervals without a start or an end: one bin
FEW = 64  # intervals of a key that each of its points is compared with, without bins


def _number(df: DataFrame, col: str) -> Column:
    """Integers as they are, dates as days, timestamps as microseconds."""
    kind = df.schema[col].dataType
    if isinstance(kind, IntegralType):
        return F.col(col).cast("long")
    if isinstance(kind, DateType):
        return F.unix_date(col).cast("long")
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.unix_micros(F.col(col).cast("timestamp"))
    raise TypeError(f"{col}: {kind.simpleString()} is no integer, date or timestamp")


def _bin(at: Column, level: Column, bits: int) -> Column:
    """The start of the bin of ``at``: its lowest bits off, which is a floor for negative numbers too."""
    below = F.call_function("shiftleft", F.lit(1).cast("long"), level * bits) - 1
    return F.when(level == OPEN, F.lit(0).cast("long")).otherwise(at.bitwiseAND(F.bitwise_not(below)))


def interval_join(points: DataFrame, intervals: DataFrame, by, at: str, start: str, end: str, fanout: int = 16) -> DataFrame:
    """Rows of ``points`` with each row of ``intervals`` of the same ``by`` where start <= at < end.

    A null start or end is open. Points with a null in ``by`` or ``at`` match nothing, intervals with a null in ``by`` or
    without a length neither. Returns the points' columns and the intervals' others; columns that both have, ``by``
    apart, are an error. ``at``, ``start`` and ``end`` are of one type; ``fanout`` is a power of two up to 64."""
    by = list(by)
    if fanout not in (2, 4, 8, 16, 32, 64):
        raise ValueError("fanout is a power of two from 2 to 64")
    others = [c for c in intervals.columns if c not in by]
    clash = set(others) & set(points.columns)
    if clash:
        raise ValueError(f"columns of both sides: {sorted(clash)}")
    if len({points.schema[at].dataType, intervals.schema[start].dataType, intervals.schema[end].dataType}) > 1:
        raise TypeError("at, start and end are of one type")
    bits = fanout.bit_length() - 1

    spans = intervals.withColumns({"__lo": _number(intervals, start), "__hi": _number(intervals, end)})
    spans = spans.filter("__lo IS NULL OR __hi IS NULL OR __lo < __hi")
    looks = points.withColumn("__at", _number(points, at)).filter(F.col("__at").isNotNull())
    holds = "(__lo IS NULL OR __lo <= __at) AND (__hi IS NULL OR __at < __hi)"
    columns = [*points.columns, *others]

    crowded = spans.groupBy(*by).agg(F.count("*").alias("__n")).filter(F.col("__n") > FEW).drop("__n")
    plain = looks.join(spans.join(crowded, by, "left_anti"), by).filter(holds)

    spans = spans.join(crowded, by, "left_semi")
    length = F.expr("cast(__hi as decimal(20,0)) - cast(__lo as decimal(20,0))")
    # A length of n binary digits fits into bins of 2 ** n; from 57 digits on one bin will do.
    sized = F.ceil(F.length(F.bin(length.cast("long"))) / bits).cast("int")
    spans = spans.withColumn("__level", F.when(length < F.lit(1 << 56), sized).otherwise(F.lit(OPEN)))
    first, last = _bin(F.col("__lo"), F.col("__level"), bits), _bin(F.col("__hi") - 1, F.col("__level"), bits)
    spans = spans.withColumn("__bin", F.explode(F.array_distinct(F.array(first, last))))

    levels = spans.groupBy(*by).agg(F.collect_set("__level").alias("__levels"))
    looks = looks.join(levels, by).withColumn("__level", F.explode("__levels"))
    looks = looks.withColumn("__bin", _bin(F.col("__at"), F.col("__level"), bits))
    binned = looks.join(spans, [*by, "__level", "__bin"]).filter(holds)
    return plain.select(*columns).unionByName(binned.select(*columns))
