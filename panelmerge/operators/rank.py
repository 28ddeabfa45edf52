"""Ordering, top-k and period selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def sort_panel(df: DataFrame, keys) -> DataFrame:
    """Total order by key (range-partitioned sort; use at the sink only)."""
    return df.orderBy(*keys)


def top_k(df: DataFrame, by: str, k: int, tie_keys, ascending: bool = False) -> DataFrame:
    """First ``k`` rows by ``by`` (NULLs dropped), ties broken by ``tie_keys``.

    ``orderBy(..).limit(k)`` plans as TakeOrderedAndProject: each task keeps
    its own k best, the driver merges k x tasks rows - never the full data.
    """
    order = F.asc(by) if ascending else F.desc(by)
    return df.filter(F.col(by).isNotNull()).orderBy(order, *tie_keys).limit(k)


def select_period(df: DataFrame, period: str, want, required) -> DataFrame:
    """Rows of the chosen period: ``want`` if it has complete rows (all of
    ``required`` present), else the latest period with complete rows.

    The choice is one global aggregate row joined back (broadcast), no collect.
    """
    complete = df.na.drop(subset=list(required))
    chosen = complete.agg(F.coalesce(F.max(F.when(F.col(period) == F.lit(want), F.col(period))),
                                     F.max(period)).alias("__chosen"))
    return (complete.join(F.broadcast(chosen), F.col(period) == F.col("__chosen"), "inner")
            .drop("__chosen"))


def latest_period(df: DataFrame, period: str, required) -> DataFrame:
    """Rows of the latest period with complete rows."""
    complete = df.na.drop(subset=list(required))
    last = complete.agg(F.max(period).alias("__last"))
    return complete.join(F.broadcast(last), F.col(period) == F.col("__last"), "inner").drop("__last")


def rank_ticks(df: DataFrame, period: str, k: int = 6) -> DataFrame:
    """Period at ``k`` evenly spaced row positions of the period-sorted table.

    Positions are ``int(linspace(0, n - 1, k))``. No global window over rows:
    rows are counted per period (one small row per period), a running sum
    over those counts gives each period's position range, and each tick
    position is matched to the period whose range covers it. The table of
    distinct periods is sorted in one task: periods are years or days, not
    timestamps.
    """
    per = df.groupBy(period).agg(F.count(F.lit(1)).alias("__c"))
    w = Window.orderBy(period).rowsBetween(Window.unboundedPreceding, 0)
    # one row per distinct period: the window runs over that small table only
    ranges = per.withColumn("__end", F.sum("__c").over(w)).withColumn("__start", F.col("__end") - F.col("__c"))
    total = per.agg(F.sum("__c").alias("__n"))
    ticks = total.select(F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("tick"), "__n")
    step = (F.col("__n") - 1) / F.lit(float(k - 1)) if k > 1 else F.lit(0.0)
    ticks = ticks.select("tick", F.when(F.col("tick") == k - 1, F.col("__n") - 1)
                         .otherwise(F.floor(F.col("tick") * step)).cast("long").alias("position"))
    # k ticks: broadcast, so that the range condition never becomes a Cartesian product
    return (F.broadcast(ticks).join(ranges, (F.col("position") >= F.col("__start")) & (F.col("position") < F.col("__end")))
            .select(F.col("tick").cast("int").alias("tick"), "position", F.col(period)))
