"""Facts counted by the pass that stores the rows, not by a scan of their own.

Each function writes Parquet and observes the rows on their way. Observed counts are exact only in the stage that
writes: a map stage that is run again after a lost executor would count its rows twice. So nothing here shuffles
between the observed rows and the file; sorts and de-duplication come after, on the stored rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from panelmerge.functions.sqltext import q as _q
from panelmerge.operators import clean

LINEAGE = "source string, step string, ordinal int, rows long, removed long"
FACTS = "column string, ordinal int, rows long, filled long, fill_pct double, min double, max double, out_of_bounds long"


def store_steps(df: DataFrame, steps: list[tuple[str, Column]], path: str) -> tuple[DataFrame, list[tuple[str, int]]]:
    """Write the rows that pass all ``steps`` and read them back, with the count of rows that come in and that pass each
    step on top of the ones before (the counts of :func:`clean.clean_lineage`)."""
    passed, conds = F.lit(True), []
    for _, pred in steps:
        passed = passed & F.coalesce(pred, F.lit(False))
        conds.append(passed)
    seen = Observation()
    counts = [F.count(F.lit(1)).alias("c0")] + [F.count_if(c).alias(f"c{i + 1}") for i, c in enumerate(conds)]
    df.observe(seen, *counts).filter(passed).write.mode("overwrite").parquet(path)
    names = ["input"] + [name for name, _ in steps]
    got = seen.get
    return df.sparkSession.read.schema(df.schema).parquet(path), [(n, got.get(f"c{i}") or 0) for i, n in enumerate(names)]


def lineage_frame(spark: SparkSession, counts: dict[str, list[tuple[str, int]]]) -> DataFrame:
    """source, step, ordinal, rows, removed of what :func:`store_steps` counted for each source."""
    rows = [(source, step, i, n, (steps[i - 1][1] - n) if i else 0)
            for source, steps in counts.items() for i, (step, n) in enumerate(steps)]
    return spark.createDataFrame(rows, LINEAGE)


def store_facts(panel: DataFrame, metrics, path: str, bounds: dict | tuple | None = None) -> tuple[DataFrame, DataFrame]:
    """Write the panel and read it back, with a row of facts per column: rows, filled and their share, and for
    ``metrics`` the range and the values out of ``bounds`` (one pair for all, or a pair by metric)."""
    metrics, spark = list(metrics), panel.sparkSession
    aggs = [F.expr("count(1) AS rows")]
    for i, c in enumerate(panel.columns):
        aggs.append(F.expr(f"count({_q(c)}) AS f{i}"))
        if c in metrics:
            aggs += [F.expr(f"min(cast({_q(c)} as double)) AS a{i}"), F.expr(f"max(cast({_q(c)} as double)) AS z{i}")]
            pair = bounds.get(c) if isinstance(bounds, dict) else bounds
            if pair:
                aggs.append(F.expr(f"count_if({_q(c)} < {float(pair[0])!r}D OR {_q(c)} > {float(pair[1])!r}D) AS o{i}"))
    seen = Observation()
    panel.observe(seen, *aggs).write.mode("overwrite").parquet(path)
    got = seen.get
    n = got.get("rows") or 0
    rows = []
    for i, c in enumerate(panel.columns):
        filled = got.get(f"f{i}") or 0
        rows.append((c, i, n, filled, filled * 100.0 / n if n else None, got.get(f"a{i}"), got.get(f"z{i}"), got.get(f"o{i}", 0 if c in metrics else None)))
    return spark.read.schema(panel.schema).parquet(path), spark.createDataFrame(rows, FACTS)


def cleaning_steps(spec, code: str, period: str, period_range) -> list[tuple[str, Column]]:
    """The row drops of a source's cleaner, in order."""
    steps = [("code_present", F.col(code).isNotNull())]
    if spec.drop_null_metric:
        steps.append(("value_present", F.col(spec.metric).isNotNull()))
    if spec.exclude_code_prefix:
        steps.append(("not_aggregate", ~F.col(code).startswith(spec.exclude_code_prefix)))
    steps.append(("in_period", clean.period_predicate(period, *period_range)))
    return steps
