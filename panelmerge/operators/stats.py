"""Panel statistics. Every function is one (or a few) fused aggregations over
all requested columns at once, then ``unpivot`` to a long report - never one
pass per column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from panelmerge.functions.scalar import abs_gap, accuracy_status, decade, fill_flag, source_count
from panelmerge.functions.sqltext import lit, num, q
from panelmerge.operators.quantiles import exact_quantiles

ROUND = 6


def _pct(num: Column, den: Column) -> Column:
    return F.try_divide(num * F.lit(100.0), den)


def _long(wide: DataFrame, cols, fields: dict, id_cols=()) -> DataFrame:
    """Turn ``wide`` (one row, ``<field>__<i>`` columns) into one row per col."""
    rows = ", ".join(
        "named_struct('column', " + lit(c) + f", 'ordinal', {i}, "
        + ", ".join(f"'{f}', {f}__{i}" for f in fields) + ")"
        for i, c in enumerate(cols))
    return wide.selectExpr(*[q(c) for c in id_cols], f"explode(array({rows})) AS r").select(*id_cols, "r.*")


# ---------------------------------------------------------------- fill

def column_fill(df: DataFrame, cols) -> DataFrame:
    """Per column: present, missing, fill_pct (one aggregation)."""
    cols = list(cols)
    aggs = ["count(1) AS __total"] + [f"count({q(c)}) AS present__{i}" for i, c in enumerate(cols)]
    wide = df.agg(*[F.expr(a) for a in aggs])
    out = _long(wide, cols, {"present": None}, id_cols=["__total"])
    pct = F.coalesce(_pct(F.col("present"), F.col("__total")), F.lit(0.0))
    return out.select("column", F.col("ordinal").cast("int").alias("ordinal"), "present",
                      (F.col("__total") - F.col("present")).alias("missing"),
                      F.col("__total").alias("total"), pct.alias("fill_pct"), fill_flag(pct).alias("flag"))


def overall_fill(df: DataFrame, metrics) -> DataFrame:
    """Filled metric cells / all metric cells, and the mean of column fills."""
    metrics = list(metrics)
    n = F.count(F.lit(1))
    filled = sum((F.count(F.col(m)) for m in metrics), F.lit(0))
    cells = n * len(metrics)
    avg_fill = sum((F.coalesce(_pct(F.count(F.col(m)), n), F.lit(0.0)) for m in metrics), F.lit(0.0)) / len(metrics)
    return df.agg(filled.cast("long").alias("filled_cells"), cells.cast("long").alias("metric_cells"),
                  F.coalesce(_pct(filled, cells), F.lit(0.0)).alias("overall_fill_pct"),
                  avg_fill.alias("avg_column_fill_pct"))


def source_coverage(df: DataFrame, metrics) -> DataFrame:
    """Histogram of non-null metrics per row: ``(n_sources, rows, pct, avg_sources)``.

    Only non-empty buckets appear; ``avg_sources`` is the mean over all rows.
    One pass over the data: totals come from the histogram itself (at most
    ``len(metrics) + 1`` rows), not from a second scan.
    """
    from pyspark.sql import Window
    per_row = df.select(source_count(metrics).alias("n_sources"))
    hist = per_row.groupBy("n_sources").agg(F.count(F.lit(1)).alias("rows"))
    w = Window.partitionBy()  # over the tiny histogram only
    total = F.sum("rows").over(w)
    return hist.select(F.col("n_sources").cast("int").alias("n_sources"), "rows",
                       _pct(F.col("rows"), total).alias("pct"),
                       (F.sum(F.col("n_sources") * F.col("rows")).over(w) / total).alias("avg_sources"))


# ---------------------------------------------------------------- keys & extent

def panel_extent(df: DataFrame, entity: str, period: str, approx: bool = False) -> DataFrame:
    """rows, distinct entities / periods, min / max period."""
    cd = (lambda c: F.approx_count_distinct(c)) if approx else (lambda c: F.count_distinct(c))
    return df.agg(F.count(F.lit(1)).alias("rows"), cd(entity).alias("entities"),
                  cd(period).alias("periods"), F.min(period).alias("min_period"),
                  F.max(period).alias("max_period"))


def grid_density(df: DataFrame, entity: str, period: str) -> DataFrame:
    """rows / (entities x periods) in percent."""
    e = panel_extent(df, entity, period)
    grid = F.col("entities") * F.col("periods")
    return e.select("rows", "entities", "periods", grid.alias("grid_cells"),
                    _pct(F.col("rows"), grid).alias("density_pct"))


def key_uniqueness(df: DataFrame, keys) -> DataFrame:
    """Group sizes per key: distinct keys, max rows per key, repeated keys,
    duplicate keys beyond the first. Two-level aggregation, both partial."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__s"))
    return sizes.agg(F.count(F.lit(1)).alias("distinct_keys"),
                     F.coalesce(F.sum("__s"), F.lit(0)).cast("long").alias("rows"),
                     F.max("__s").alias("max_rows_per_key"),
                     F.count_if(F.col("__s") > 1).alias("repeated_keys"),
                     F.coalesce(F.sum(F.col("__s") - 1), F.lit(0)).cast("long").alias("duplicate_keys"))


def duplicate_rows(df: DataFrame, cols=None) -> DataFrame:
    """Exact duplicate rows beyond the first (NULLs compare equal) and %."""
    cols = list(cols or df.columns)
    sizes = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__s"))
    return sizes.agg(F.coalesce(F.sum("__s"), F.lit(0)).cast("long").alias("rows"),
                     F.coalesce(F.sum(F.col("__s") - 1), F.lit(0)).cast("long").alias("duplicate_rows")) \
        .withColumn("duplicate_pct", F.coalesce(_pct(F.col("duplicate_rows"), F.col("rows")), F.lit(0.0)))


def key_facts(df: DataFrame, keys) -> DataFrame:
    """Key uniqueness and exact duplicate rows in one two-level aggregation.

    ``groupBy(all columns)`` then ``groupBy(keys)``: both are clustered by
    a superset of the keys, so on a panel that is already partitioned by its
    keys neither level shuffles. Output: distinct_keys, rows,
    max_rows_per_key, repeated_keys, duplicate_keys, duplicate_rows,
    duplicate_pct.
    """
    rows = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__s"))
    per_key = rows.groupBy(*keys).agg(F.sum("__s").alias("__k"), F.sum(F.col("__s") - 1).alias("__d"))
    out = per_key.agg(F.count(F.lit(1)).alias("distinct_keys"),
                      F.coalesce(F.sum("__k"), F.lit(0)).cast("long").alias("rows"),
                      F.max("__k").alias("max_rows_per_key"),
                      F.count_if(F.col("__k") > 1).alias("repeated_keys"),
                      F.coalesce(F.sum(F.col("__k") - 1), F.lit(0)).cast("long").alias("duplicate_keys"),
                      F.coalesce(F.sum("__d"), F.lit(0)).cast("long").alias("duplicate_rows"))
    return out.withColumn("duplicate_pct", F.coalesce(_pct(F.col("duplicate_rows"), F.col("rows")), F.lit(0.0)))


def subtotals(df: DataFrame, sets, entity: str, metrics) -> DataFrame:
    """Totals for several groupings at once (``sets``: lists of columns, [] for all rows), by one
    Expand and one shuffle: ``level`` (the grouping's columns), the columns (null where summed
    up), rows, distinct entities, and for each metric its filled rows, sum and mean."""
    dims = list(dict.fromkeys(c for s in sets for c in s))
    aggs = [F.count(F.lit(1)).alias("rows"), F.count_distinct(entity).alias("entities")]
    for m in metrics:
        aggs += [F.count(m).alias(f"{m}_filled"), F.sum(m).alias(f"{m}_sum"), F.avg(m).alias(f"{m}_mean")]
    # An entity that is a dimension too would be null where it is summed up: it's counted on a copy.
    own = df.withColumn("__entity", F.col(entity))
    aggs[1] = F.count_distinct("__entity").alias("entities")
    flags = [F.when(F.grouping(c) == 0, F.lit(c)) for c in dims]
    out = own.groupingSets([[F.col(c) for c in s] for s in sets], *dims).agg(F.concat_ws(",", *flags).alias("level"), *aggs)
    return out.select("level", *dims, *(c for c in out.columns if c not in {"level", *dims}))


# ---------------------------------------------------------------- validity

def bounds_check(df: DataFrame, metrics, lo, hi, period: str | None = None,
                 period_lo=None, period_hi=None) -> DataFrame:
    """Per metric: values strictly below ``lo`` / above ``hi`` and their sum.

    With ``period`` an extra row counts periods outside the inclusive range
    (NULL periods count as outside).
    """
    metrics = list(metrics)
    lo_s, hi_s = num(lo), num(hi)
    aggs = []
    for i, m in enumerate(metrics):
        aggs += [f"count_if({q(m)} < {lo_s}) AS below__{i}", f"count_if({q(m)} > {hi_s}) AS above__{i}"]
    cols = list(metrics)
    if period is not None:
        i = len(metrics)
        p = q(period)
        aggs += [f"count_if({p} IS NULL OR {p} < {lit(period_lo)}) AS below__{i}",
                 f"count_if({p} > {lit(period_hi)}) AS above__{i}"]
        cols.append(period)
    aggs = [F.expr(a) for a in aggs]
    wide = df.agg(*aggs)
    out = _long(wide, cols, {"below": None, "above": None})
    return out.select("column", F.col("ordinal").cast("int").alias("ordinal"), "below", "above",
                      (F.col("below") + F.col("above")).alias("out_of_bounds"))


def type_check(df: DataFrame, metrics) -> list[tuple[str, str, bool]]:
    """Driver-side schema inspection: (column, type, is_numeric)."""
    return [(m, df.schema[m].dataType.simpleString(), isinstance(df.schema[m].dataType, NumericType))
            for m in metrics if m in df.columns]


def type_report(df: DataFrame, metrics) -> DataFrame:
    """:func:`type_check` as a table, with the non-null values each verdict stands for."""
    checked = type_check(df, metrics)
    wide = df.agg(*[F.count(q_col).alias(f"n__{i}") for i, q_col in enumerate(F.col(f"`{c}`") for c, _, _ in checked)])
    rows = ", ".join(f"named_struct('column', {lit(c)}, 'type', {lit(t)}, 'is_numeric', {str(ok).lower()}, 'present', n__{i})"
                     for i, (c, t, ok) in enumerate(checked))
    return wide.selectExpr(f"explode(array({rows})) AS r").select("r.*")


# ---------------------------------------------------------------- agreement

def pair_agreement(df: DataFrame, pairs) -> DataFrame:
    """Per (a, b, label): n both present, mean / max |a-b|, Pearson r.

    One aggregation for all pairs; pairs with n = 0 are omitted.
    """
    if not pairs:
        return df.sparkSession.createDataFrame(
            [], "pair string, ordinal int, n long, mean_abs double, max_abs double, corr double, status string")
    aggs = []
    for i, (a, b, _) in enumerate(pairs):
        both = f"({q(a)} IS NOT NULL AND {q(b)} IS NOT NULL)"
        xa, xb = f"CASE WHEN {both} THEN {q(a)} END", f"CASE WHEN {both} THEN {q(b)} END"
        d = f"CASE WHEN {both} THEN abs({q(a)} - {q(b)}) END"
        aggs += [f"count_if({both}) AS n__{i}", f"avg({d}) AS mean_abs__{i}", f"max({d}) AS max_abs__{i}",
                 # Pearson r that is NULL (not an error) for zero variance or n < 2
                 f"try_divide(covar_samp({xa}, {xb}), stddev_samp({xa}) * stddev_samp({xb})) AS corr__{i}"]
    aggs = [F.expr(a) for a in aggs]
    wide = df.agg(*aggs)
    labels = [p[2] for p in pairs]
    out = _long(wide, labels, {"n": None, "mean_abs": None, "max_abs": None, "corr": None})
    return (out.withColumnRenamed("column", "pair").filter(F.col("n") > 0)
            .select("pair", F.col("ordinal").cast("int").alias("ordinal"), "n", "mean_abs", "max_abs", "corr",
                    accuracy_status(F.col("mean_abs")).alias("status")))


def below_any(df: DataFrame, limits: dict, keep) -> DataFrame:
    """Rows with any column under its limit (``{column: limit}``): ``keep`` and the columns."""
    low = F.lit(False)
    for c, limit in limits.items():
        low = low | (F.col(c) < limit)
    return df.filter(low).select(*keep, *limits)


def gap_rows(df: DataFrame, a: str, b: str, keep, gap_col: str = "gap") -> DataFrame:
    """Rows with both present and ``gap = a - b``."""
    return df.na.drop(subset=[a, b]).select(*keep, (F.col(a) - F.col(b)).alias(gap_col))


def gap_stats(df: DataFrame, a: str, b: str, method: str = "exact") -> DataFrame:
    """mean, exact median, sample std, min, max, n of ``a - b`` (both present)."""
    g = df.na.drop(subset=[a, b]).select((F.col(a) - F.col(b)).alias("__g"))
    basic = g.agg(F.count(F.lit(1)).alias("n"), F.avg("__g").alias("mean"),
                  F.stddev_samp("__g").alias("std"), F.min("__g").alias("min"), F.max("__g").alias("max"))
    med = exact_quantiles(g, "__g", [0.5], method=method).agg(F.max("q_0").alias("median"))
    return basic.crossJoin(med) \
        .select("n", "mean", "median", "std", "min", "max")


def divergence_stats(df: DataFrame, a: str, b: str, under: float = 1.0, method: str = "exact") -> DataFrame:
    """n, mean / median / max of |a-b|, share (%) of rows with |a-b| < ``under``."""
    d = df.na.drop(subset=[a, b]).select(abs_gap(a, b).alias("__d"))
    basic = d.agg(F.count(F.lit(1)).alias("n"), F.avg("__d").alias("mean_abs"), F.max("__d").alias("max_abs"),
                  (F.avg(F.when(F.col("__d") < under, 1.0).otherwise(0.0)) * 100).alias("pct_under"))
    med = exact_quantiles(d, "__d", [0.5], method=method).agg(F.max("q_0").alias("median_abs"))
    return basic.crossJoin(med).select("n", "mean_abs", "median_abs", "max_abs", "pct_under")


def extreme_by_entity(df: DataFrame, a: str, b: str, entity: str, threshold: float) -> DataFrame:
    """Entities with |a-b| > threshold: count and mean, by mean desc."""
    d = df.na.drop(subset=[a, b]).select(entity, abs_gap(a, b).alias("__d")).filter(F.col("__d") > threshold)
    return (d.groupBy(entity).agg(F.count(F.lit(1)).alias("rows"), F.avg("__d").alias("mean_abs"))
            .orderBy(F.desc("mean_abs"), entity))


# ---------------------------------------------------------------- distribution

def decade_distribution(df: DataFrame, period: str, metric: str, method: str = "exact") -> DataFrame:
    """Box-plot numbers per decade of ``period`` for ``metric``.

    n, q1, median, q3, whiskers (furthest value within 1.5 IQR of the box),
    outlier count, and the overall mean of the metric. Quartiles come from
    :func:`exact_quantiles`; whiskers and outliers are a second aggregation
    against the per-decade quartiles (one row per decade, joined back).
    """
    v = df.filter(F.col(metric).isNotNull()).select(decade(period).alias("decade"), F.col(metric).alias("__v"))
    quart = exact_quantiles(v, "__v", [0.25, 0.5, 0.75], ["decade"], method=method) \
        .withColumnRenamed("q_0", "q1").withColumnRenamed("q_1", "median").withColumnRenamed("q_2", "q3")
    iqr = F.col("q3") - F.col("q1")
    fence_lo, fence_hi = F.col("q1") - 1.5 * iqr, F.col("q3") + 1.5 * iqr
    x = F.col("__v")
    inside = x.between(fence_lo, fence_hi)
    per = v.join(quart, "decade").groupBy("decade", "q1", "median", "q3").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.when(inside, x)).alias("whisker_lo"), F.max(F.when(inside, x)).alias("whisker_hi"),
        F.count_if(~inside).alias("outliers"))
    overall = v.agg(F.avg("__v").alias("overall_mean"))
    return per.crossJoin(F.broadcast(overall)).select(
        "decade", "n", "q1", "median", "q3", "whisker_lo", "whisker_hi", "outliers", "overall_mean")


def decade_outliers(df: DataFrame, keys, period: str, metric: str, method: str = "exact") -> DataFrame:
    """The outlier points behind :func:`decade_distribution` (outside 1.5 IQR)."""
    base = df.filter(F.col(metric).isNotNull()).withColumn("decade", decade(period))
    quart = exact_quantiles(base, metric, [0.25, 0.75], ["decade"], method=method)
    iqr = F.col("q_1") - F.col("q_0")
    out = base.join(quart, "decade").filter(
        (F.col(metric) < F.col("q_0") - 1.5 * iqr) | (F.col(metric) > F.col("q_1") + 1.5 * iqr))
    return out.select(*keys, "decade", metric)
