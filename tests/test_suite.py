"""The report suite over a stored panel equals the per-query bindings."""

import os

import pytest

from panelmerge.plans import bindings as B
from panelmerge.plans.suite import materialize, quality_suite
from panelmerge.spec import PanelSpec

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_suite_matches_bindings(spark, tmp_path):
    panel = materialize(B.ev_panel(spark, SF), "ev", path=str(tmp_path / "ev"))
    spec = PanelSpec("user_id", "day", B.EV_METRICS, labels=B.EV_LABELS)
    suite = quality_suite(panel, spec, bounds=B.EV_BOUNDS, period_range=B.EV_PERIOD_RANGE, pairs=B.EV_PAIRS,
                          rule=B.EV_RULE, conflict_sources=B.EV_CONFLICT_SOURCES, tolerance=B.EV_TOLERANCE)
    for name, binding in (("dq_scorecard", B.q_dq_scorecard), ("source_coverage", B.q_source_coverage),
                          ("le_conflicts", B.q_le_conflicts), ("top_divergence", B.q_top_divergence)):
        got = sorted(tuple(r) for r in B.rounded(suite[name]).collect())
        exp = sorted(tuple(r) for r in B.rounded(binding(spark, SF)).collect())
        assert got == exp, name
    for df in suite.values():
        assert "FileScan" in df._jdf.queryExecution().executedPlan().toString()


def test_grouped_profile_equals_per_source_profile(spark):
    from pyspark.sql import functions as F
    from panelmerge.plans import reports
    rows = [("a", 1, 10, 1.0), ("a", 1, 10, 1.0), ("a", 2, None, 200.0), ("b", 3, 11, None), ("c", 4, 12, 5.0)]
    df = spark.createDataFrame(rows, "src string, id int, code int, v double")
    grouped = reports.source_profile_grouped(df, "src", ["b", "a"], (0, 100), code="code", metric="v")
    per = reports.source_profile(spark, [
        {"label": lab, "code": "code", "metric": "v",
         "load": (lambda lab=lab: df.filter(F.col("src") == lab).drop("src"))} for lab in ["b", "a"]], (0, 100))
    assert sorted(map(tuple, grouped.collect())) == sorted(map(tuple, per.collect()))
