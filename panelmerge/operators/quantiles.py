"""Exact quantiles without putting a whole group into one task.

Spark's exact ``percentile`` merges one value -> count map per group in a
single task; with a handful of groups (decades) or none at all (a global
median) that is the whole column in one task. ``exact_quantiles`` instead
runs a distributed selection:

1. per group: ``n`` and a bounded quantile sketch (partial aggregation), read at
   ``buckets`` + 1 evenly spaced ranks: the grid;
2. the ranks needed for linear interpolation, ``floor(q(n-1))`` and
   ``ceil(q(n-1))``, become a small *state* table ``(group, rank, lo, hi)``: grid
   values that surely enclose the rank, as the grid's steps are ten times the
   sketch's error and the bracket leaves two steps on either side;
3. each further pass counts the values below the bracket and sketches those
   inside, which gives a new grid and a bracket of some thousandths of the old;
4. the last step compacts the surviving values to ``(value, count)`` pairs, one
   more row counts all values below, and a running sum finds the rank.

Brackets are cut by rank, not by width, so what is left for step 4 is about
(5 / ``buckets``) ** ``passes`` of the group whatever the values are (2.5e-5 with the
defaults); equal values are one pair. Every step is a lazily composed DataFrame (no
collect, no driver loop over data). ``method="approx"`` switches to
``percentile_approx`` (one pass, bounded sketch) and ``method="single"`` to
Spark's exact ``percentile``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmerge.functions.sqltext import q as _q

DEFAULT_PASSES = 2
DEFAULT_BUCKETS = 1000


def _join_state(base: DataFrame, state: DataFrame, groups) -> DataFrame:
    if groups:
        # state: <= 2 rows per (group, rank). No hint: AQE measures the
        # materialised state and broadcasts it when small; a forced broadcast of
        # a data-dependent chain only adds re-planning rounds.
        return base.join(state, on=list(groups), how="inner")
    # no groups: the state has at most 2 rows per quantile, bounded by construction
    return base.crossJoin(F.broadcast(state))


def _grid(value: str, buckets: int) -> str:
    """The values of ``value`` at ``buckets`` + 1 evenly spaced ranks, within a tenth of a step."""
    ranks = ", ".join(f"{i / buckets!r}D" for i in range(buckets + 1))
    return f"percentile_approx({value}, array({ranks}), {10 * buckets}) AS __grid"


def _bracket(share: str, buckets: int) -> list[str]:
    """Grid values two steps outside the share of the ranks."""
    return [f"__grid[CAST(greatest(0, floor({share} * {buckets}) - 2) AS INT)] AS __a",
            f"__grid[CAST(least({buckets}, ceil({share} * {buckets}) + 2) AS INT)] AS __b"]


def survivors(base: DataFrame, targets: DataFrame, groups, passes: int, buckets: int) -> DataFrame:
    """``(groups, __k, __v, __c)``: for each wanted rank the values that its last bracket
    holds with their counts, and a row with a NULL value that counts those below."""
    g = [_q(c) for c in groups]
    state = (targets.selectExpr(*g, "__n", "__grid", "explode(array(__k1, __k2)) AS __k").distinct()
             .selectExpr(*g, "__k", *_bracket("__k / __n", buckets)))
    for _ in range(passes - 1):
        reach = _join_state(base, state, groups).filter("__v <= __b")
        inner = "CASE WHEN __v >= __a THEN __v END"
        seen = reach.groupBy(*groups, "__k").agg(
            F.expr("count_if(__v < __a) AS __below"), F.expr(f"count({inner}) AS __m"), F.expr(_grid(inner, buckets)))
        state = seen.selectExpr(*g, "__k", *_bracket("(__k - __below) / __m", buckets))
    return (_join_state(base, state, groups).filter("__v <= __b")
            .selectExpr(*g, "__k", "CASE WHEN __v >= __a THEN __v END AS __v")
            .groupBy(*groups, "__k", "__v").agg(F.expr("count(1) AS __c")))


def exact_quantiles(df: DataFrame, value_col: str, qs, groups=(), *, method: str = "exact",
                    passes: int = DEFAULT_PASSES, buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """Quantiles with linear interpolation (numpy / ``quantile_cont``).

    Returns one row per group: the group columns and one double column per
    quantile named ``q_<index>`` (in the order of ``qs``). NULL and NaN values
    are ignored; groups without values are absent.
    """
    groups = list(groups)
    qs = [float(q) for q in qs]
    v = F.col(value_col)
    if method == "approx":
        return df.groupBy(*groups).agg(*[
            F.percentile_approx(v, q, 10000).cast("double").alias(f"q_{i}") for i, q in enumerate(qs)])
    if method == "single":
        return df.filter(v.isNotNull()).groupBy(*groups).agg(*[
            F.percentile(v, F.lit(q)).alias(f"q_{i}") for i, q in enumerate(qs)])
    if method != "exact":
        raise ValueError("method must be exact, approx or single")

    # NULL and NaN are both "missing" (the library's null model, and pandas')
    base = df.select(*groups, v.cast("double").alias("__v")) \
        .filter(F.col("__v").isNotNull() & ~F.isnan(F.col("__v")))
    # Internal expressions are written as SQL text (one JVM call each).
    g = [_q(c) for c in groups]
    stats = base.groupBy(*groups).agg(F.expr("count(1) AS __n"), F.expr(_grid("__v", buckets))).filter("__n > 0")
    # targets: per group and quantile, the two ranks and the interpolation weight
    qarr = "array(" + ", ".join(f"named_struct('qi', {i}, 'q', CAST({q!r} AS DOUBLE))" for i, q in enumerate(qs)) + ")"
    targets = (stats.selectExpr(*g, "__n", "__grid", f"explode({qarr}) AS __q")
               .selectExpr(*g, "__n", "__grid", "__q.qi AS __qi",
                           "CAST(floor(__q.q * (__n - 1)) AS BIGINT) AS __k1",
                           "CAST(ceil(__q.q * (__n - 1)) AS BIGINT) AS __k2",
                           "__q.q * (__n - 1) - floor(__q.q * (__n - 1)) AS __frac"))
    part = "PARTITION BY " + ", ".join([*g, "__k"])
    vals = survivors(base, targets, groups, passes, buckets).selectExpr(
        "*", f"sum(__c) OVER ({part} ORDER BY __v NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS __cum")
    picked = vals.filter("__cum - __c <= __k AND __k < __cum").selectExpr(*g, "__k", "__v AS __val")

    # one row per group: rank -> value map (at most 2 entries per quantile), joined once
    by_rank = picked.groupBy(*groups).agg(F.expr("map_from_entries(collect_list(struct(__k, __val))) AS __m"))
    targets = targets.drop("__grid")
    t = targets.join(by_rank, on=groups, how="inner") if groups else targets.crossJoin(F.broadcast(by_rank))
    value = "__m[__k1] + (__m[__k2] - __m[__k1]) * __frac"
    wide = t.groupBy(*groups).agg(*[
        F.expr(f"max(CASE WHEN __qi = {i} THEN {value} END) AS q_{i}") for i in range(len(qs))])
    return wide
