"""Run every report over one stored copy of the panel.

Each report is a lazy DataFrame; built straight on a merge they would all
re-run the merge (and its source scans). ``materialize`` writes the panel
once as Parquet to shared storage - the folder the cluster names in
``spark.checkpoint.dir`` unless a path is given - and reads it back, which
also cuts the lineage: a lost executor re-reads files instead of
re-running the merge.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame

from panelmerge.operators import rank, stats
from panelmerge.plans import charts, reports
from panelmerge.session import ensure_checkpoint_dir
from panelmerge.spec import PanelSpec


def materialize(panel: DataFrame, name: str, path: str | None = None) -> DataFrame:
    spark = panel.sparkSession
    target = path or os.path.join(ensure_checkpoint_dir(spark), "panels", name)
    panel.write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def quality_suite(panel: DataFrame, spec: PanelSpec, *, bounds, period_range, pairs, rule,
                  conflict_sources, tolerance: float, top: int = 5) -> dict[str, DataFrame]:
    """All panel reports as lazy DataFrames over ``panel`` (store it first)."""
    keys = spec.keys
    metrics = list(spec.metrics)
    lower, upper = rule
    card = reports.dq_scorecard(panel, keys, metrics, bounds=bounds, period_range=period_range,
                                pairs=pairs, rule=rule)
    out = {
        "column_fill": stats.column_fill(panel, panel.columns),
        "overall_fill": stats.overall_fill(panel, metrics),
        "source_coverage": stats.source_coverage(panel, metrics),
        "panel_extent": stats.panel_extent(panel, spec.entity, spec.period),
        "grid_density": stats.grid_density(panel, spec.entity, spec.period),
        "key_facts": stats.key_facts(panel, keys),
        "bounds_check": stats.bounds_check(panel, metrics, *bounds, period=spec.period,
                                           period_lo=period_range[0], period_hi=period_range[1]),
        "pair_agreement": stats.pair_agreement(panel, pairs),
        "le_conflicts": reports.le_conflicts(panel, conflict_sources, tolerance),
        "top_conflicts": reports.top_conflicts(panel, keys, conflict_sources, tolerance, k=top),
        "rule_consistency": reports.rule_consistency(panel, lower, upper),
        "rule_violations": reports.rule_violations(panel, keys, lower, upper, k=top),
        "gap_stats": stats.gap_stats(panel, upper, lower),
        "dq_scorecard": card,
        "dq_grade": reports.dq_grade(card),
        "audit_columns": reports.audit_columns(panel),
        "audit_keys": reports.audit_keys(panel, spec.entity, spec.period),
        "final_profile": reports.final_profile(panel, spec.entity, spec.period, spec.name, metrics, bounds),
        "coverage_ranking": charts.coverage_ranking(panel, metrics, spec.labels),
        "presence_by_period": charts.presence_by_period(panel, spec.period, metrics),
        "rank_ticks": rank.rank_ticks(panel, spec.period),
    }
    if pairs:
        a, b, _ = pairs[0]
        scored = panel.na.drop(subset=[a, b]).withColumn("abs_diff", stats.abs_gap(a, b))
        out["top_divergence"] = rank.top_k(scored.select(*keys, a, b, "abs_diff"), "abs_diff", top, keys)
    return out
