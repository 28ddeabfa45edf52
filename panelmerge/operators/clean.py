"""Row-level cleaning steps: renames, filters, coercion, de-duplication, lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from panelmerge.functions.nulls import nan_to_null, to_number


def require_columns(df: DataFrame, cols) -> DataFrame:
    """Fail fast (driver side, no job) when expected columns are missing."""
    missing = set(cols) - set(df.columns)
    if missing:
        raise ValueError(f"Missing expected columns: {sorted(missing)}")
    return df


def rename(df: DataFrame, mapping: dict) -> DataFrame:
    """Rename columns that exist; unknown names are ignored."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def strip_headers(df: DataFrame) -> DataFrame:
    """Strip surrounding whitespace from column names."""
    return df.toDF(*[c.strip() for c in df.columns])


def canonical_order(df: DataFrame, cols) -> DataFrame:
    """Project to ``cols`` in that order, keeping only those that exist."""
    return df.select(*[c for c in cols if c in df.columns])


def drop_null(df: DataFrame, subset=None) -> DataFrame:
    """Drop rows with a NULL in ``subset`` (any column when None)."""
    return df.na.drop(how="any", subset=list(subset) if subset else None)


def exclude_prefix(df: DataFrame, col: str, prefix: str) -> DataFrame:
    """Drop rows whose ``col`` starts with ``prefix`` (NULL codes are kept)."""
    c = F.col(col)
    return df.filter(c.isNull() | ~c.startswith(prefix))


def prefix_lineage(df: DataFrame, col: str, prefix: str) -> DataFrame:
    """Rows before and after :func:`exclude_prefix`, as a cleaning lineage."""
    c = F.col(col)
    return clean_lineage(df, [("exclude_prefix", c.isNull() | ~c.startswith(prefix))])


def first_rows(df: DataFrame, n: int, order) -> DataFrame:
    """The first ``n`` rows under an explicit order (top-n per task, then one merge)."""
    return df.orderBy(*order).limit(n)


def period_predicate(col: str, lo, hi) -> Column:
    """Inclusive range. A NULL period yields NULL, which ``filter`` drops and
    ``count_if`` does not count; kept a plain range so Parquet can push it."""
    return F.col(col).between(lo, hi)


def period_filter(df: DataFrame, col: str, lo, hi) -> DataFrame:
    return df.filter(period_predicate(col, lo, hi))


def filter_if_present(df: DataFrame, col: str, value) -> DataFrame:
    """Equality filter applied only when the column exists."""
    return df.filter(F.col(col) == F.lit(value)) if col in df.columns else df


def filter_first_present(df: DataFrame, col: str, prefs) -> DataFrame:
    """Keep the rows of the first preferred value that occurs in the data.

    No collect: a preference rank is computed per row, the minimum rank over
    the table is one global aggregate row (cross-joined back as a broadcast),
    and rows with that rank survive. When no preferred value occurs the
    frame is returned unfiltered.
    """
    if col not in df.columns:
        return df
    rank = None
    for i, p in enumerate(prefs):
        rank = F.when(F.col(col) == F.lit(p), F.lit(i)) if rank is None else rank.when(F.col(col) == F.lit(p), F.lit(i))
    ranked = df.withColumn("__pref", rank)
    best = ranked.agg(F.min("__pref").alias("__best"))
    return (ranked.crossJoin(F.broadcast(best))
            .filter(F.col("__best").isNull() | (F.col("__pref") == F.col("__best")))
            .drop("__pref", "__best"))


def coerce_numeric(df: DataFrame, col: str, dtype: str = "double") -> DataFrame:
    """Bad values -> NULL; numeric columns only get NaN -> NULL."""
    field = df.schema[col].dataType
    if isinstance(field, NumericType):
        c = F.col(col).cast(dtype)
        return df.withColumn(col, nan_to_null(c) if dtype in ("double", "float") else c)
    return df.withColumn(col, to_number(col, dtype))


def dedup_mean(df: DataFrame, keys, metric: str) -> DataFrame:
    """One row per key with the mean of ``metric`` (NULL keys dropped first)."""
    return drop_null(df, keys).groupBy(*keys).agg(F.avg(metric).alias(metric))


def dedup_first(df: DataFrame, keys, order) -> DataFrame:
    """Keep the first row per key under an explicit total order.

    ``dropDuplicates`` keeps an arbitrary row; here ``order`` (column names)
    makes "first" deterministic. Realised as the minimum of an
    ``(order..., other columns...)`` struct per key: a partial aggregation, so a
    key holding a third of the rows is reduced map-side instead of being
    sorted in one task as a ``row_number`` window would.
    """
    order = list(order)
    rest = [c for c in df.columns if c not in set(keys) | set(order)]
    packed = F.min(F.struct(*[F.col(c) for c in order + rest])).alias("__first")
    out = df.groupBy(*keys).agg(packed)
    return out.select(*keys, *[F.col("__first").getField(c).alias(c) for c in order + rest]).select(*df.columns)


def dedup_first_agg(df: DataFrame, keys, order_col: str, value_cols) -> DataFrame:
    """Keep-first as an aggregate: min of a (order, values) struct per key.

    Same result as :func:`dedup_first` when ``order_col`` is unique per key,
    but partial-aggregated, so one hot key never sits in a single sort.
    """
    packed = F.min(F.struct(F.col(order_col), *[F.col(v) for v in value_cols])).alias("__first")
    out = df.groupBy(*keys).agg(packed)
    return out.select(*keys, *[F.col("__first").getField(v).alias(v) for v in value_cols])


def clean_lineage(df: DataFrame, steps: list[tuple[str, Column]]) -> DataFrame:
    """Row counts after each cumulative cleaning step, in one aggregation.

    ``steps`` is ``[(name, predicate), ...]``; predicate k applies on top of
    the previous ones. Output: one row per step ``(step, ordinal, rows,
    removed)`` with a leading ``input`` row.
    """
    conds = []
    acc = F.lit(True)
    for _, pred in steps:
        acc = acc & F.coalesce(pred, F.lit(False))
        conds.append(acc)
    aggs = [F.count(F.lit(1)).alias("c0")] + [F.count_if(c).alias(f"c{i + 1}") for i, c in enumerate(conds)]
    wide = df.agg(*aggs)
    names = ["input"] + [n for n, _ in steps]
    stack = ", ".join(f"'{n}', {i}, c{i}, c{max(i - 1, 0)}" for i, n in enumerate(names))
    return wide.selectExpr(f"stack({len(names)}, {stack}) as (step, ordinal, rows, prev_rows)") \
        .select("step", F.col("ordinal").cast("int").alias("ordinal"), "rows",
                (F.col("prev_rows") - F.col("rows")).alias("removed"))
