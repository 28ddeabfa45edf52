"""Merging any number of sources into one wide panel.

Two physical strategies with one contract:

* ``union`` (default): every source is tagged with its ordinal, the sources
  are stacked with ``unionByName`` and reduced with one ``groupBy(keys)``.
  That is a single hash exchange whatever the number of sources, the
  aggregation is partial (map-side) so a hot key is combined before it is
  shuffled, and filters on the key are pushed into every branch.
* ``join``: the left fold of full outer joins the reference performs. It
  costs two exchanges and a sort-merge join per source, and multiplies rows
  when a source repeats a key; it exists for ``on_duplicate='multiply'`` and
  as the property-test partner of ``union``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelmerge.functions.sqltext import lit as _lit
from panelmerge.functions.sqltext import q as _q

_SRC = "__src"
_ORD = "__ord"
_NAME = "__name"

DUPLICATE_POLICIES = ("error", "first", "mean", "max", "multiply")


def _metric_cols(df: DataFrame, keys, name_col, order_col=None) -> list[str]:
    skip = set(keys) | ({name_col} if name_col else set()) | ({order_col} if order_col else set())
    return [c for c in df.columns if c not in skip and not c.startswith("__")]


def merge_panel(sources: list[DataFrame], keys: list[str], *, name_col: str | None = None,
                strategy: str = "union", on_duplicate: str = "error",
                order_col: str | None = None, metric_aggs: dict | None = None) -> DataFrame:
    """Full outer merge of ``sources`` on ``keys`` into one wide DataFrame.

    Each source holds the key columns, its own metric column(s) and
    optionally ``name_col``. Output columns: keys, name (first non-null in
    source order), then the metrics in source order. Rows with a null key
    component are dropped (a null key identifies no panel cell).

    ``on_duplicate`` says what happens when one source repeats a key:
    ``error`` fails the job, ``first`` keeps the value with the smallest
    ``order_col`` (ties: smallest value), ``mean`` averages, ``max`` keeps the
    largest, ``multiply`` reproduces outer-join row multiplication.
    """
    if on_duplicate not in DUPLICATE_POLICIES:
        raise ValueError(f"on_duplicate must be one of {DUPLICATE_POLICIES}")
    sources = [s for s in sources if s is not None]
    if not sources:
        raise ValueError("merge_panel needs at least one source")
    metric_aggs = dict(metric_aggs or {})
    if strategy == "join" or on_duplicate == "multiply":
        if metric_aggs:
            sources = [_pre_aggregate(s, keys, name_col, metric_aggs) for s in sources]
        return _merge_join(sources, keys, name_col)
    if strategy != "union":
        raise ValueError("strategy must be 'union' or 'join'")
    return _merge_union(sources, keys, name_col, on_duplicate, order_col, metric_aggs)


_AGG_FNS = {"sum": F.sum, "mean": F.avg, "max": F.max, "min": F.min, "count": F.count}


def _pre_aggregate(src: DataFrame, keys, name_col, metric_aggs) -> DataFrame:
    ms = [m for m in _metric_cols(src, keys, name_col) if m in metric_aggs]
    if not ms:
        return src
    return src.groupBy(*keys).agg(*[_AGG_FNS[metric_aggs[m]](m).alias(m) for m in ms])


def _not_null_keys(df: DataFrame, keys) -> DataFrame:
    return df.na.drop(subset=list(keys))


def _merge_union(sources, keys, name_col, on_duplicate, order_col, metric_aggs=None) -> DataFrame:
    metric_aggs = metric_aggs or {}
    metrics: list[str] = []
    parts = []
    for i, src in enumerate(sources):
        ms = _metric_cols(src, keys, name_col, order_col if on_duplicate == "first" else None)
        clash = set(ms) & set(metrics)
        if clash:
            raise ValueError(f"metric columns appear in two sources: {sorted(clash)}")
        metrics.extend(ms)
        cols = [F.col(k) for k in keys] + [F.col(m) for m in ms]
        cols.append(F.lit(i).alias(_SRC))
        if name_col and name_col in src.columns:
            cols.append(F.col(name_col).cast("string").alias(_NAME))
        if on_duplicate == "first":
            if not order_col or order_col not in src.columns:
                raise ValueError("on_duplicate='first' needs an order column in every source")
            cols.append(F.col(order_col).alias(_ORD))
        parts.append(_not_null_keys(src, keys).select(*cols))
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)

    aggs: list[Column] = []
    if name_col:
        if _NAME in stacked.columns:
            # first non-null name in source order; min of a struct ignores NULL inputs.
            # (A string-valued buffer makes this a sort-based aggregation: still
            # partial and spill-safe, so it is only added when a source has names.)
            first_name = F.min(F.when(F.col(_NAME).isNotNull(), F.struct(F.col(_SRC), F.col(_NAME))))
            aggs.append(first_name.getField(_NAME).alias(name_col))
        else:
            aggs.append(F.lit(None).cast("string").alias(name_col))
    types = dict(stacked.dtypes)
    for m in metrics:
        if m in metric_aggs:
            aggs.append(_AGG_FNS[metric_aggs[m]](F.col(m)).alias(m))
        else:
            aggs.append(_reduce_metric(m, on_duplicate, types[m]).alias(m))
    out = stacked.groupBy(*keys).agg(*aggs)
    return out.select(*keys, *([name_col] if name_col else []), *metrics)


def _reduce_metric(m: str, on_duplicate: str, dtype: str) -> Column:
    c = F.col(m)
    if on_duplicate == "mean":
        return F.avg(c)
    if on_duplicate == "max":
        return F.max(c)
    if on_duplicate == "first":
        # smallest order first; value breaks exact ties so the result is stable
        return F.min(F.when(c.isNotNull(), F.struct(F.col(_ORD), c))).getField(m)
    # error: one source may contribute at most one row per key
    return F.when(F.count(c) > 1,
                  F.raise_error(F.lit(f"duplicate key in source of column {m}")).cast(dtype)
                  ).otherwise(F.max(c))


def _merge_join(sources, keys, name_col) -> DataFrame:
    metrics: list[str] = []
    names: list[str] = []
    renamed = []
    for i, src in enumerate(sources):
        src = _not_null_keys(src, keys)
        metrics.extend(_metric_cols(src, keys, name_col))
        if name_col and name_col in src.columns:
            tmp = f"{name_col}__{i}"
            src = src.withColumnRenamed(name_col, tmp)
            names.append(tmp)
        renamed.append(src)
    merged = reduce(lambda a, b: a.join(b, on=list(keys), how="full_outer"), renamed)
    cols = [F.col(k) for k in keys]
    if name_col:
        cols.append((F.coalesce(*[F.col(n) for n in names]) if names
                     else F.lit(None).cast("string")).alias(name_col))
    cols += [F.col(m) for m in metrics]
    return merged.select(*cols)


def long_to_panel(df: DataFrame, keys: list[str], source_col: str, value_col: str,
                  sources: dict, *, how: str = "mean") -> DataFrame:
    """Panel from a long table ``(keys, source, value)`` in one shuffle.

    ``sources`` maps a value of ``source_col`` to the output metric column.
    Each metric is the ``how`` (mean | max | min | sum | count) of that
    source's values per key; one scan, partial aggregation, one exchange.
    """
    fn = {"mean": "avg", "max": "max", "min": "min", "sum": "sum", "count": "count"}[how]
    base = _not_null_keys(df, keys).filter(F.col(source_col).isin(list(sources)))
    # generated expression list written as SQL text: one call per expression
    aggs = [F.expr(f"{fn}(CASE WHEN {_q(source_col)} = {_lit(s)} THEN {_q(value_col)} END) AS {_q(m)}")
            for s, m in sources.items()]
    return base.groupBy(*keys).agg(*aggs)

