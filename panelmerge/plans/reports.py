"""Composite reports. Each returns DataFrames (one-row summaries or small
tables); nothing is printed and nothing is collected."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelmerge.functions.nulls import to_number
from panelmerge.functions.scalar import (
    grade_dq, grade_value, missing_flag, row_spread, source_count, truncate_label,
)
from panelmerge.functions.sqltext import lit, num, q
from panelmerge.operators import stats

# Keyword lists for merge-key detection (case-insensitive substring).
ENTITY_KEYWORDS = ("country", "entity", "area", "iso3", "iso_code", "countryiso3code", "ref_area", "location")
PERIOD_KEYWORDS = ("year", "time", "date", "time_period", "period")

# Scorecard pass rules.
COMPLETENESS_MIN_FILL = 30.0
ACCURACY_MAX_MEAN_ABS = 3.5
VALUE_MIN_ENTITIES = 200


# ------------------------------------------------------------- conflicts (G8, G9)

def le_conflicts(df: DataFrame, sources, tolerance: float, min_sources: int = 2) -> DataFrame:
    """Apples-to-apples: rows with >= ``min_sources`` values are testable;
    severe when max - min > ``tolerance``."""
    n = source_count(sources)
    spread = row_spread(sources)
    testable = n >= min_sources
    severe = testable & (spread > tolerance)
    return df.agg(F.count(F.lit(1)).alias("total_rows"), F.count_if(testable).alias("testable_rows"),
                  F.count_if(testable & ~F.coalesce(spread > tolerance, F.lit(False))).alias("within_tolerance"),
                  F.count_if(severe).alias("severe_conflicts"))


def top_conflicts(df: DataFrame, keys, sources, tolerance: float, k: int = 5,
                  min_sources: int = 2, extra=()) -> DataFrame:
    """Severe rows by spread desc (ties by key), first ``k``."""
    spread = row_spread(sources)
    sev = df.filter((source_count(sources) >= min_sources) & (spread > tolerance))
    return (sev.select(*keys, *extra, *sources, spread.alias("spread"))
            .orderBy(F.desc("spread"), *keys).limit(k))


def rule_consistency(df: DataFrame, lower: str, upper: str) -> DataFrame:
    """Apples-to-oranges rule ``lower <= upper`` where both are present."""
    both = F.col(lower).isNotNull() & F.col(upper).isNotNull()
    viol = both & (F.col(lower) > F.col(upper))
    return df.agg(F.count_if(both).alias("overlapping_rows"),
                  F.count_if(both & ~viol).alias("consistent_rows"),
                  F.count_if(viol).alias("violations"))


def rule_violations(df: DataFrame, keys, lower: str, upper: str, k: int | None = None, extra=()) -> DataFrame:
    """Rows breaking ``lower <= upper`` with ``excess = lower - upper``, in key
    order; ``k`` asks for the first ones only."""
    v = df.filter(F.col(lower) > F.col(upper)).select(
        *keys, *extra, lower, upper, (F.col(lower) - F.col(upper)).alias("excess"))
    v = v.orderBy(*keys)
    return v.limit(k) if k else v


def gap_violations(df: DataFrame, keys, a: str, b: str, extra=()) -> DataFrame:
    """All rows with ``a - b < 0``, most negative first."""
    g = stats.gap_rows(df, a, b, list(keys) + list(extra) + [a, b])
    return g.filter(F.col("gap") < 0).orderBy("gap", *keys)


def violation_summary(df: DataFrame, entity: str, period: str, a: str, b: str) -> DataFrame:
    """Violations of ``a >= b``: count, entities, period range, mean gap."""
    g = stats.gap_rows(df, a, b, [entity, period]).filter(F.col("gap") < 0)
    return g.agg(F.count(F.lit(1)).alias("violations"), F.count_distinct(entity).alias("entities"),
                 F.min(period).alias("min_period"), F.max(period).alias("max_period"),
                 F.avg("gap").alias("mean_gap"))


def top_mean_gap(df: DataFrame, entity: str, a: str, b: str, k: int = 10) -> DataFrame:
    """Entities by mean ``a - b`` (both present), largest first."""
    g = stats.gap_rows(df, a, b, [entity])
    per = g.groupBy(entity).agg(F.avg("gap").alias("mean_gap"), F.count(F.lit(1)).alias("rows"))
    return per.orderBy(F.desc("mean_gap"), entity).limit(k)


# ------------------------------------------------------------- DQ scorecard (G10-G15)

def dq_scorecard(df: DataFrame, keys, metrics, *, bounds, period_range, pairs, rule,
                 min_fill: float = COMPLETENESS_MIN_FILL,
                 max_mean_abs: float = ACCURACY_MAX_MEAN_ABS) -> DataFrame:
    """Five dimensions, one row each: ``(dimension, ordinal, passed, value,
    checked_rows, type_ok)``. ``checked_rows`` makes vacuous passes visible;
    ``type_ok`` says whether all metrics are numeric, which every line relies on.

    Two aggregations over the panel in total: one fused pass for
    completeness, validity, accuracy and consistency, and the two-level key
    aggregation of :func:`stats.key_facts` for uniqueness.
    """
    entity, period = keys
    lo, hi = (num(x) for x in bounds)
    plo, phi = period_range
    lower, upper = rule
    metrics = [m for m in metrics if m in df.columns]
    pairs = [p for p in pairs if p[0] in df.columns and p[1] in df.columns]
    # the fused aggregation is generated, so it is written as SQL text (one call each)
    fills = [f"coalesce(try_divide(count({q(m)}) * 100.0D, count(1)), 0.0D)" for m in metrics]
    avg_fill = f"(({' + '.join(fills)}) / {len(metrics)})" if metrics else "0.0D"
    pc = q(period)
    oob = " + ".join([f"count_if({q(m)} < {lo} OR {q(m)} > {hi})" for m in metrics]
                     + [f"count_if({pc} IS NULL OR {pc} < {plo} OR {pc} > {phi})"])
    aggs = ["count(1) AS __rows", f"{avg_fill} AS c_value", f"CAST({oob} AS BIGINT) AS v_value"]
    for i, (a, b, _) in enumerate(pairs):
        both = f"({q(a)} IS NOT NULL AND {q(b)} IS NOT NULL)"
        aggs += [f"count_if({both}) AS pn{i}", f"avg(CASE WHEN {both} THEN abs({q(a)} - {q(b)}) END) AS pm{i}"]
    if lower in df.columns and upper in df.columns:
        both = f"({q(lower)} IS NOT NULL AND {q(upper)} IS NOT NULL)"
        aggs += [f"count_if({both}) AS overlapping_rows", f"count_if({both} AND {q(lower)} > {q(upper)}) AS violations"]
    else:
        aggs += ["CAST(0 AS BIGINT) AS overlapping_rows", "CAST(0 AS BIGINT) AS violations"]
    facts = df.agg(*[F.expr(a) for a in aggs])
    # accuracy: pairs without overlap are left out, as in the pair report
    idx = range(len(pairs))
    checked = " + ".join(f"pn{i}" for i in idx) or "0"
    bad = " + ".join(f"CASE WHEN pn{i} > 0 AND pm{i} >= {num(max_mean_abs)} THEN 1 ELSE 0 END" for i in idx) or "0"
    worst = (f"greatest({', '.join(f'pm{i}' for i in idx)})" if len(pairs) > 1
             else ("pm0" if pairs else "CAST(NULL AS DOUBLE)"))
    facts = facts.selectExpr("*", f"CAST({checked} AS BIGINT) AS a_checked", f"{bad} AS a_bad", f"{worst} AS a_value")
    uniq = stats.key_facts(df, keys).selectExpr("max_rows_per_key", "duplicate_rows AS __dups")
    one = facts.crossJoin(uniq)

    numeric = all(ok for _, _, ok in stats.type_check(df, metrics))

    def dim(name, ordinal, passed, value, checked_rows):
        type_ok = str(numeric).lower()
        return (f"named_struct('dimension', '{name}', 'ordinal', {ordinal}, 'passed', coalesce({passed}, false), "
                f"'value', CAST({value} AS DOUBLE), 'checked_rows', CAST({checked_rows} AS BIGINT), 'type_ok', {type_ok})")

    dims = ", ".join([
        dim("completeness", 1, f"c_value > {num(min_fill)}", "c_value", "__rows"),
        dim("uniqueness", 2, "coalesce(max_rows_per_key, 1) = 1 AND __dups = 0", "max_rows_per_key", "__rows"),
        dim("validity", 3, "v_value = 0", "v_value", "__rows"),
        dim("accuracy", 4, "a_bad = 0", "a_value", "a_checked"),
        dim("consistency", 5, "violations = 0", "violations", "overlapping_rows"),
    ])
    return one.selectExpr(f"explode(array({dims})) AS d").select("d.*")


def dq_grade(scorecard: DataFrame) -> DataFrame:
    """passed / total, score %, grade (A = 100, B >= 80, C >= 60, else D)."""
    s = scorecard.agg(F.count_if("passed").alias("passed"), F.count(F.lit(1)).alias("total"))
    score = F.col("passed") * 100.0 / F.col("total")
    return s.select("passed", "total", score.alias("score_pct"), grade_dq(score).alias("grade"))


# ------------------------------------------------------------- audit (G7)

def audit_columns(df: DataFrame) -> DataFrame:
    """Missing per column with a flag (none / warn < 50 % / red)."""
    fill = stats.column_fill(df, df.columns)
    pct = F.coalesce(F.try_divide(F.col("missing") * 100.0, F.col("total")), F.lit(0.0))
    return fill.select("column", "ordinal", "missing", "total", pct.alias("missing_pct"),
                       missing_flag(pct).alias("flag"))


def audit_keys(df: DataFrame, entity: str, period: str) -> DataFrame:
    """Key nulls, extent, duplicate keys and duplicate rows in one row, from one scan: equal
    rows are counted, then keys, and all else weighs by these counts."""
    sizes = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__s"))
    per_key = sizes.groupBy(entity, period).agg(F.sum("__s").alias("__k"), F.sum(F.col("__s") - 1).alias("__d"))
    total = lambda e: F.coalesce(F.sum(e), F.lit(0)).cast("long")
    out = per_key.agg(
        total(F.col("__k")).alias("rows"), total(F.when(F.col(entity).isNull(), F.col("__k"))).alias("entity_nulls"),
        total(F.when(F.col(period).isNull(), F.col("__k"))).alias("period_nulls"), F.count_distinct(entity).alias("entities"),
        F.min(period).alias("min_period"), F.max(period).alias("max_period"), total(F.col("__k") - 1).alias("duplicate_keys"),
        total(F.col("__d")).alias("duplicate_rows"))
    pct = F.coalesce(F.try_divide(F.col("duplicate_rows") * 100.0, F.col("rows")), F.lit(0.0))
    return out.withColumn("duplicate_pct", pct).withColumn("columns", F.lit(len(df.columns)))


# ------------------------------------------------------------- profiles (G1-G6)

def column_profile(df: DataFrame, order_cols, sample_rows: int | None = None) -> DataFrame:
    """Per column: dtype, non-null %, first non-null value by ``order_cols``
    (label-truncated). ``sample_rows`` asks for a profile of the first rows only."""
    sample = df if sample_rows is None else df.orderBy(*order_cols).limit(sample_rows)
    order = F.struct(*[F.col(c) for c in order_cols])
    aggs = [F.count(F.lit(1)).alias("__n")]
    for i, c in enumerate(df.columns):
        aggs.append(F.count(F.col(c)).alias(f"nn__{i}"))
        first = F.min(F.when(F.col(c).isNotNull(), F.struct(order.alias("o"), F.col(c).cast("string").alias("v"))))
        aggs.append(first.getField("v").alias(f"sample__{i}"))
    wide = sample.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"), F.lit(i).alias("ordinal"),
                     F.lit(df.schema[c].dataType.simpleString()).alias("dtype"),
                     F.col(f"nn__{i}").alias("nn"), F.col(f"sample__{i}").alias("sample"))
            for i, c in enumerate(df.columns)]
    out = wide.select("__n", F.explode(F.array(*rows)).alias("r")).select("__n", "r.*")
    return out.select("column", "ordinal", "dtype",
                      F.coalesce(F.try_divide(F.col("nn") * 100.0, F.col("__n")), F.lit(0.0)).alias("non_null_pct"),
                      F.coalesce(truncate_label(F.col("sample")), F.lit("N/A")).alias("sample"))


def merge_keys(spark: SparkSession, tables: dict, with_stats: bool = False) -> DataFrame:
    """Candidate merge keys per table from column names: ``(table_name,
    column_name, role, has_iso)``.

    With ``with_stats`` each candidate column is also measured on the data -
    ``present`` (non-null rows) and ``distinct_values`` - in one aggregation
    per table, which tells a usable key from a sparse or constant one. A table
    without a candidate has one row with NULL column and role, measured as 0.
    """
    rows = []
    for t, df in tables.items():
        has_iso = any("iso" in c.lower() for c in df.columns)
        before = len(rows)
        for c in df.columns:
            low = c.lower()
            for role, kws in (("entity", ENTITY_KEYWORDS), ("period", PERIOD_KEYWORDS)):
                if any(k in low for k in kws):
                    rows.append((t, c, role, has_iso))
        if len(rows) == before:
            rows.append((t, None, None, has_iso))
    found = spark.createDataFrame(rows, "table_name string, column_name string, role string, has_iso boolean")
    if not with_stats:
        return found
    measured = []
    for t, df in tables.items():
        cand = sorted({c for tt, c, _, _ in rows if tt == t and c})
        if not cand:
            continue
        wide = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"p{i}") for i, c in enumerate(cand)],
                      *[F.count_distinct(F.col(f"`{c}`")).alias(f"d{i}") for i, c in enumerate(cand)])
        arr = F.array(*[F.struct(F.lit(t).alias("table_name"), F.lit(c).alias("column_name"),
                                 F.col(f"p{i}").alias("present"), F.col(f"d{i}").alias("distinct_values"))
                        for i, c in enumerate(cand)])
        measured.append(wide.select(F.explode(arr).alias("r")).select("r.*"))
    if not measured:
        return found.withColumn("present", F.lit(0).cast("long")).withColumn("distinct_values", F.lit(0).cast("long"))
    stats_df = reduce(lambda a, b: a.unionByName(b), measured)
    return found.join(stats_df, ["table_name", "column_name"], "left").na.fill(0, ["present", "distinct_values"])


def inferred_types(df: DataFrame, cols) -> DataFrame:
    """``(column, dtype)`` that the text columns ``cols`` hold: bigint, double or
    string, by one aggregation over all values; a column without values is string."""
    aggs = []
    for i, c in enumerate(cols):
        v, n = F.col(f"`{c}`"), to_number(F.col(f"`{c}`"))
        aggs += [F.count(v).alias(f"n{i}"), F.count(n).alias(f"d{i}"),
                 F.count_if(v.rlike(r"^\s*[+-]?[0-9]{1,18}\s*$")).alias(f"i{i}")]
    rows = [F.struct(F.lit(c).alias("column"), F.when(F.col(f"n{i}") == 0, "string").when(F.col(f"i{i}") == F.col(f"n{i}"), "bigint")
                     .when(F.col(f"d{i}") == F.col(f"n{i}"), "double").otherwise("string").alias("inferred"))
            for i, c in enumerate(cols)]
    return df.agg(*aggs).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def profile_files(spark: SparkSession, paths, sample_rows: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Profile raw CSV files: per file, the column profile (of the first
    ``sample_rows`` rows in file order, if given) with the types that the values
    have, and its candidate merge keys.

    Each file is decoded as UTF-8 or Latin-1 (per-file detection); a file
    that cannot be read is reported in the profile with ``load_error`` and
    the others still appear. Returns ``(columns, merge_keys)``.
    """
    from panelmerge.sources.readers import ROW, read_csv_any_encoding
    schema = "file string, column string, ordinal int, dtype string, non_null_pct double, sample string, load_error string"
    cols, tables = [], {}
    for path in paths:
        name = path.rstrip("/").split("/")[-1]
        try:
            df = read_csv_any_encoding(spark, path, order_col=ROW)
            df.schema  # noqa: B018 - resolves the file now, so a bad one is caught here
        except Exception as exc:
            msg = "File not found" if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc) else "Failed to read file"
            cols.append(spark.createDataFrame([(name, None, None, None, None, None, msg)], schema))
            continue
        tables[name] = df.drop(ROW)
        prof = column_profile(df, [ROW], sample_rows).filter(F.col("column") != ROW).drop("dtype")
        prof = prof.join(F.broadcast(inferred_types(df, tables[name].columns)), "column").withColumnRenamed("inferred", "dtype")
        cols.append(prof.select(F.lit(name).alias("file"), "column", "ordinal", "dtype", "non_null_pct", "sample",
                                F.lit("").alias("load_error")))
    columns = reduce(lambda a, b: a.unionByName(b), cols) if cols else spark.createDataFrame([], schema)
    return columns, merge_keys(spark, tables)


def _weighted(condition: str) -> str:
    """Rows where the condition holds, from distinct rows with their counts ``__s``."""
    return f"CAST(coalesce(sum(CASE WHEN {condition} THEN __s END), 0) AS BIGINT)"


def _weighted_pct(e: str) -> str:
    return f"coalesce(try_divide(sum(CASE WHEN {e} IS NOT NULL THEN __s ELSE 0 END) * 100.0D, sum(__s)), 0.0D)"


_DUPLICATES = ("CAST(coalesce(sum(__s - 1), 0) AS BIGINT) AS duplicate_rows",
               "coalesce(try_divide(sum(__s - 1) * 100.0D, sum(__s)), 0.0D) AS duplicate_pct")


def source_profile(spark: SparkSession, sources, bounds) -> DataFrame:
    """One row per raw source (G3). ``sources`` is a list of dicts with
    ``label``, ``load`` (callable returning a DataFrame) and optional
    ``metric``, ``code``, ``name``, ``period`` column names. A source that
    fails to load yields a row with ``load_error`` set and zero counts."""
    lo_s, hi_s = num(bounds[0]), num(bounds[1])
    schema = ("label string, ordinal int, rows long, columns int, has_code boolean, code_fill_pct double, "
              "metric_fill_pct double, metric_min double, metric_max double, out_of_bounds long, "
              "period_fill_pct double, period_min double, period_max double, duplicate_rows long, "
              "duplicate_pct double, entities long, load_error string")
    parts = []
    for i, s in enumerate(sources):
        try:
            df = s["load"]()
        except Exception as exc:  # absent path, unreadable file
            err = "File not found" if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc) else "Failed to read file"
            parts.append(spark.createDataFrame(
                [(s["label"], i, 0, 0, False, 0.0, 0.0, None, None, 0, 0.0, None, None, 0, 0.0, 0, err)], schema))
            continue
        cols = df.columns
        code, metric, period, name = (s.get(k) if s.get(k) in cols else None
                                      for k in ("code", "metric", "period", "name"))
        pct = _weighted_pct
        m = f"try_cast(trim(CAST({q(metric)} AS STRING)) AS DOUBLE)" if metric else None
        p = f"try_cast(trim(CAST({q(period)} AS STRING)) AS DOUBLE)" if period else None
        ent = name or code
        null_d = "CAST(NULL AS DOUBLE)"
        # One scan: equal rows are counted, and everything else weighs by that count.
        sizes = df.groupBy(*cols).agg(F.expr("count(1) AS __s"))
        agg = sizes.agg(*[F.expr(a) for a in (
            f"{_weighted('true')} AS rows",
            f"{pct(q(code)) if code else '0.0D'} AS code_fill_pct",
            f"{pct(m) if metric else '0.0D'} AS metric_fill_pct",
            f"{f'min({m})' if metric else null_d} AS metric_min",
            f"{f'max({m})' if metric else null_d} AS metric_max",
            f"{_weighted(f'{m} < {lo_s} OR {m} > {hi_s}') if metric else 'CAST(0 AS BIGINT)'} AS out_of_bounds",
            f"{pct(p) if period else '0.0D'} AS period_fill_pct",
            f"{f'min({p})' if period else null_d} AS period_min",
            f"{f'max({p})' if period else null_d} AS period_max",
            f"{f'count(DISTINCT {q(ent)})' if ent else 'CAST(0 AS BIGINT)'} AS entities", *_DUPLICATES)])
        parts.append(agg.selectExpr(
            f"{lit(s['label'])} AS label", f"{i} AS ordinal", "rows", f"{len(cols)} AS columns",
            f"{'true' if code is not None else 'false'} AS has_code", "code_fill_pct", "metric_fill_pct",
            "metric_min", "metric_max", "out_of_bounds", "period_fill_pct", "period_min", "period_max",
            "duplicate_rows", "duplicate_pct", "entities", "'' AS load_error"))
    return reduce(lambda a, b: a.unionByName(b), parts)


def source_profile_grouped(df: DataFrame, label_col: str, labels, bounds, *, code: str | None = None,
                           metric: str | None = None, period: str | None = None,
                           name: str | None = None) -> DataFrame:
    """G3 for sources that are slices of one long table (one per ``label_col``
    value): one scan and one grouped aggregation instead of one pass per
    source. Same output as :func:`source_profile`; ``labels`` fixes the
    order (and which slices are reported)."""
    lo, hi = num(bounds[0]), num(bounds[1])
    labels = list(labels)
    df = df.filter(F.col(label_col).isin(labels))
    cols = [c for c in df.columns if c != label_col]
    pct = _weighted_pct
    m = f"CAST({q(metric)} AS DOUBLE)" if metric else None
    p = f"CAST({q(period)} AS DOUBLE)" if period else None
    ent = name or code
    null_d = "CAST(NULL AS DOUBLE)"
    aggs = [
        f"{_weighted('true')} AS rows",
        f"{pct(q(code)) if code else '0.0D'} AS code_fill_pct",
        f"{pct(m) if metric else '0.0D'} AS metric_fill_pct",
        f"{f'min({m})' if metric else null_d} AS metric_min",
        f"{f'max({m})' if metric else null_d} AS metric_max",
        f"{_weighted(f'{m} < {lo} OR {m} > {hi}') if metric else 'CAST(0 AS BIGINT)'} AS out_of_bounds",
        f"{pct(p) if period else '0.0D'} AS period_fill_pct",
        f"{f'min({p})' if period else null_d} AS period_min",
        f"{f'max({p})' if period else null_d} AS period_max",
        f"{f'count(DISTINCT {q(ent)})' if ent else 'CAST(0 AS BIGINT)'} AS entities", *_DUPLICATES,
    ]
    # One scan: equal rows are counted, and everything else weighs by that count.
    sizes = df.groupBy(label_col, *cols).agg(F.expr("count(1) AS __s"))
    agg = sizes.groupBy(label_col).agg(*[F.expr(a) for a in aggs])
    order = "map(" + ", ".join(f"{lit(lab)}, {i}" for i, lab in enumerate(labels)) + ")"
    lc = q(label_col)
    return agg.selectExpr(
        f"CAST({lc} AS STRING) AS label", f"{order}[{lc}] AS ordinal", "rows", f"{len(cols)} AS columns",
        f"{'true' if code is not None else 'false'} AS has_code", "code_fill_pct", "metric_fill_pct", "metric_min",
        "metric_max", "out_of_bounds", "period_fill_pct", "period_min", "period_max", "duplicate_rows",
        "duplicate_pct", "entities", "'' AS load_error")


def final_profile(df: DataFrame, entity: str, period: str, name: str | None, metrics, bounds) -> DataFrame:
    """One row describing the final panel (G4)."""
    lo, hi = num(bounds[0]), num(bounds[1])
    metrics = [m for m in metrics if m in df.columns]
    oob = " + ".join(f"count_if({q(m)} < {lo} OR {q(m)} > {hi})" for m in metrics) or "0"
    # One scan: sums by key, then over the keys.
    filled = {f"__f{i}": q(m) for i, m in enumerate(metrics)} | ({"__name": q(name)} if name else {})
    per_key = df.groupBy(entity, period).agg(
        F.expr("count(1) AS __s"), F.expr(f"CAST({oob} AS BIGINT) AS __oob"), *(F.expr(f"count({e}) AS {a}") for a, e in filled.items()))
    pct = lambda e: f"coalesce(try_divide(sum({e}) * 100.0D, sum(__s)), 0.0D)"
    avg_fill = f"(({' + '.join(pct(f'__f{i}') for i in range(len(metrics)))}) / {len(metrics)})" if metrics else "0.0D"
    base = per_key.agg(*[F.expr(a) for a in (
        f"{_weighted('true')} AS rows", f"count(DISTINCT {q(entity)}) AS entities", f"min({q(period)}) AS min_period",
        f"max({q(period)}) AS max_period", f"{_weighted_pct(q(entity))} AS code_fill_pct",
        f"{pct('__name') if name else '0.0D'} AS name_fill_pct", f"{avg_fill} AS avg_metric_fill_pct",
        "CAST(coalesce(sum(__oob), 0) AS BIGINT) AS out_of_bounds", "CAST(coalesce(sum(__s - 1), 0) AS BIGINT) AS duplicate_keys")])
    return base.selectExpr("rows", f"{len(df.columns)} AS columns", "entities", "min_period",
                                         "max_period", "code_fill_pct", "name_fill_pct", "duplicate_keys",
                                         "avg_metric_fill_pct", "out_of_bounds")


def before_after(raw: DataFrame, final: DataFrame) -> DataFrame:
    """Raw source profiles vs final profile, one row (G5). Gains are signed."""
    ok = raw.filter(F.col("load_error") == "")
    best = "struct(rows, -ordinal)"
    r = ok.agg(*[F.expr(a) for a in (
        "count(1) AS schemas", "CAST(sum(columns) AS BIGINT) AS raw_total_columns",
        "CAST(sum(rows) AS BIGINT) AS raw_rows", "count_if(has_code) AS sources_with_code",
        "count_if(NOT has_code) AS sources_without_code", "CAST(sum(duplicate_rows) AS BIGINT) AS raw_duplicates",
        "CAST(sum(out_of_bounds) AS BIGINT) AS raw_out_of_bounds", f"max_by(label, {best}) AS best_source",
        f"max_by(rows, {best}) AS best_source_rows", f"max_by(entities, {best}) AS best_source_entities")])
    f = final.selectExpr("rows AS final_rows", "columns AS final_columns", "entities AS final_entities",
                         "duplicate_keys AS final_duplicate_keys", "out_of_bounds AS final_out_of_bounds",
                         "code_fill_pct", "min_period", "max_period")
    return r.crossJoin(f).selectExpr(
        "schemas", "raw_total_columns", "raw_rows", "final_rows", "final_columns",
        "CASE WHEN raw_rows > 0 THEN (1 - final_rows * 1.0D / raw_rows) * 100 ELSE 0.0D END AS record_compression_pct",
        "sources_with_code", "sources_without_code", "raw_duplicates", "final_duplicate_keys",
        "raw_out_of_bounds", "final_out_of_bounds", "best_source", "best_source_rows", "best_source_entities",
        "CASE WHEN best_source_rows > 0 THEN (final_rows - best_source_rows) * 100.0D / best_source_rows "
        "ELSE 0.0D END AS row_gain_pct",
        "final_entities - best_source_entities AS entity_gain", "final_entities", "code_fill_pct",
        "min_period", "max_period")


def value_scorecard(ba: DataFrame, min_entities: int = VALUE_MIN_ENTITIES, legacy: bool = False) -> DataFrame:
    """Six value-added lines, score % and grade (A >= 90, B >= 75, C >= 60).

    With ``legacy`` three lines are constant passes as in the original
    report; otherwise they are computed: one schema out of several inputs,
    rows linked (final rows > 0 and fewer than raw rows), no out-of-bounds.
    """
    lines = [
        ("schema_consolidation", "true" if legacy else "schemas > 1 AND final_columns > 0"),
        ("entity_resolution", "code_fill_pct = 100.0D"),
        ("duplicate_elimination", "final_duplicate_keys = 0"),
        ("record_integration", "true" if legacy else "final_rows > 0 AND final_rows <= raw_rows"),
        ("coverage_amplification", f"final_entities > {int(min_entities)}"),
        ("validity_enforcement", "true" if legacy else "final_out_of_bounds = 0"),
    ]
    arr = ", ".join(f"named_struct('dimension', '{n}', 'ordinal', {i + 1}, 'passed', coalesce({c}, false))"
                    for i, (n, c) in enumerate(lines))
    rows = ba.selectExpr(f"explode(array({arr})) AS d").select("d.*")
    score = rows.agg(F.expr("count_if(passed) * 100.0D / count(1) AS score_pct"))
    return rows.crossJoin(score).withColumn("grade", grade_value(F.col("score_pct")))
