"""The last value at or before a row, by entity: as-of join and values carried forward.

A window by entity would sort a hot entity in one task. Here the rows are cut into ranges of (entity, time), whatever the
entity's size; each range notes its last values, and a row that finds none in its own range takes those that the ranges
before hand on. The notes are a row a range, so the window over them is bounded by the number of ranges.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelmerge.session import ensure_checkpoint_dir

_PART, _AT, _SIDE, _SALT, _ROW = "__part", "__at", "__side", "__salt", "__row"


def _carried(rows: DataFrame, by, order, payloads: dict[str, Column], parts: int | None) -> DataFrame:
    """``rows`` with, for each payload, its last non-null value so far within ``by`` (columns of the payload's name).

    ``order`` follows ``by``; ties are rows whose order doesn't matter, and are dealt to ranges by a salt. The ranges
    are written to the shared folder, so both passes see the same ones and a lost executor re-reads them."""
    spark = rows.sparkSession
    width = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.withColumns(payloads).withColumn(_SALT, F.xxhash64(F.spark_partition_id(), *rows.columns))
    path = f"{ensure_checkpoint_dir(spark)}/ranges-{uuid.uuid4().hex}"
    cut = rows.repartitionByRange(width, *by, *order, _SALT).withColumn(_PART, F.spark_partition_id())
    cut.write.parquet(path)
    cut = spark.read.schema(cut.schema).parquet(path)

    keys = F.struct(*by, *order)
    last = cut.groupBy(_PART).agg(*(F.max(F.when(F.col(p).isNotNull(), F.struct(keys.alias("k"), F.col(p).alias("v")))).alias(f"{p}__last") for p in payloads))
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    handed = last.select(_PART, *(F.last(f"{p}__last", ignorenulls=True).over(before).alias(f"{p}__handed") for p in payloads))

    so_far = Window.partitionBy(_PART, *by).orderBy(*order, _SALT).rowsBetween(Window.unboundedPreceding, 0)
    own = cut.select("*", *(F.last(p, ignorenulls=True).over(so_far).alias(f"{p}__own") for p in payloads))
    out = own.join(handed, _PART, "left")

    def found(p: str) -> Column:
        same = F.lit(True)
        for c in by:
            same = same & (F.col(f"{p}__handed.k").getField(c) == F.col(c))
        return F.coalesce(f"{p}__own", F.when(same, F.col(f"{p}__handed.v"))).alias(p)

    return out.select(*(c for c in rows.columns if c not in payloads and c != _SALT), *(found(p) for p in payloads))


def asof_join(left: DataFrame, right: DataFrame, by, at: str, right_at: str | None = None, matched: str = "matched_at",
              parts: int | None = None) -> DataFrame:
    """Each row of ``left`` with the values of the latest row of ``right`` of the same ``by`` at or before ``at``.

    Returns left's columns, ``matched`` (right's time) and right's other columns; nulls if there is no such row, or if
    the left row has a null in ``by`` or ``at``. Of several right rows of one time the greatest counts (its columns
    compared in order, null least). Right rows with a null in ``by`` or the time match nothing. Columns that both sides
    have, ``by`` and time apart, are an error."""
    by, right_at = list(by), right_at or at
    values = [c for c in right.columns if c not in (*by, right_at)]
    clash = (set(values) | {matched}) & set(left.columns)
    if clash:
        raise ValueError(f"columns of both sides: {sorted(clash)}")
    whole = F.struct(*(F.col(f"`{c}`") for c in left.columns))
    queries = left.select(*by, F.col(at).alias(_AT), F.lit(1).alias(_SIDE), whole.alias(_ROW))
    # One row of right for each time, so equal times are no tie.
    known = right.na.drop(subset=[*by, right_at]).select(
        *by, F.col(right_at).alias(_AT), F.struct(F.col(right_at).alias(matched), *values).alias("__known"))
    known = known.groupBy(*by, _AT).agg(F.max("__known").alias("__known")).withColumn(_SIDE, F.lit(0))
    rows = known.unionByName(queries, allowMissingColumns=True)
    out = _carried(rows, by, [_AT, _SIDE], {"__match": F.col("__known")}, parts)
    known_at = F.when(F.col(_AT).isNotNull(), F.col("__match"))
    return out.filter(F.col(_SIDE) == 1).select(F.col(_ROW), known_at.alias("__match")).select(
        *(F.col(_ROW).getField(c).alias(c) for c in left.columns), *(F.col("__match").getField(c).alias(c) for c in (matched, *values)))


def carry_last(panel: DataFrame, by, at: str, metrics, parts: int | None = None) -> DataFrame:
    """``panel`` with each metric's gaps filled by its last value before, within ``by`` in the order of ``at``.

    Leading gaps stay null. The panel has one row per (by, at); of repeated ones any counts as the later. Rows with a
    null in ``by`` or ``at`` are kept as they are."""
    by, metrics = list(by), list(metrics)
    whole = F.lit(True)
    for c in (*by, at):
        whole = whole & F.col(c).isNotNull()
    payloads = {f"__c{i}": F.when(whole, F.col(m)) for i, m in enumerate(metrics)}
    out = _carried(panel, by, [at], payloads, parts)
    taken = {m: F.coalesce(F.col(m), F.when(whole, F.col(f"__c{i}"))) for i, m in enumerate(metrics)}
    return out.withColumns(taken).select(*panel.columns)
