"""Tables behind the charts (drawing itself is not part of the library)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmerge.operators.rank import latest_period, select_period, top_k


def health_gap_ranking(df: DataFrame, keys, period: str, total: str, healthy: str,
                       want, k: int = 15, extra=()) -> DataFrame:
    """Chosen period (``want`` or latest complete), top ``k`` by ``total``,
    ``gap = total - healthy``, ordered by gap ascending."""
    rows = select_period(df, period, want, [total, healthy])
    top = top_k(rows, total, k, keys)
    return (top.select(*keys, *extra, total, healthy, (F.col(total) - F.col(healthy)).alias("gap"))
            .orderBy("gap", *keys))


def conflict_matrix(df: DataFrame, keys, period: str, a: str, b: str, extra: str | None = None,
                    k: int = 20, min_extra: int = 0, label=None) -> DataFrame:
    """Latest period where ``a`` and ``b`` are both present; the ``k`` rows
    with the largest |a - b|. ``min_extra`` asks that ``extra`` is shown only when
    so many rows of that period have it (NULL otherwise), so the schema never
    depends on the data."""
    rows = latest_period(df, period, [a, b])
    cols = list(keys) + ([label] if label else []) + [a, b]
    div = F.abs(F.col(a) - F.col(b)).alias("divergence")
    if extra:
        avail = rows.agg(F.count(F.col(extra)).alias("__avail"))
        rows = rows.crossJoin(F.broadcast(avail)).withColumn(
            extra, F.when(F.col("__avail") >= min_extra, F.col(extra)))
        cols.append(extra)
    top = rows.select(*cols, div)
    return top.orderBy(F.desc("divergence"), *keys).limit(k)


def coverage_ranking(df: DataFrame, metrics, labels: dict) -> DataFrame:
    """Per source: label, non-null share (%), by share desc."""
    n = F.count(F.lit(1))
    wide = df.agg(*[F.coalesce(F.try_divide(F.count(F.col(m)) * 100.0, n), F.lit(0.0)).alias(f"p{i}")
                    for i, m in enumerate(metrics)])
    arr = F.array(*[F.struct(F.lit(labels.get(m, m)).alias("source"), F.lit(m).alias("column"),
                             F.col(f"p{i}").alias("coverage_pct")) for i, m in enumerate(metrics)])
    return wide.select(F.explode(arr).alias("r")).select("r.*").orderBy(F.desc("coverage_pct"), "column")


def presence_matrix(df: DataFrame, keys, period: str, metrics) -> DataFrame:
    """0/1 availability per row and source, ordered by period (raw form)."""
    return df.select(*keys, *[F.col(m).isNotNull().cast("int").alias(f"has_{m}") for m in metrics]) \
        .orderBy(period, *[k for k in keys if k != period])


def presence_by_period(df: DataFrame, period: str, metrics) -> DataFrame:
    """Share of rows with each source per period (the scalable form of the
    availability matrix): ``(period, column, rows, present, share_pct)``."""
    aggs = [F.count(F.lit(1)).alias("rows")] + [F.count(F.col(m)).alias(f"c{i}") for i, m in enumerate(metrics)]
    per = df.groupBy(period).agg(*aggs)
    arr = F.array(*[F.struct(F.lit(m).alias("column"), F.col(f"c{i}").alias("present")) for i, m in enumerate(metrics)])
    return per.select(period, "rows", F.explode(arr).alias("r")).select(
        period, "r.column", "rows", "r.present", (F.col("r.present") * 100.0 / F.col("rows")).alias("share_pct"))
