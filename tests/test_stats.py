"""Statistics, quantiles, ranking and report invariants."""

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelmerge.operators import rank, stats
from panelmerge.operators.quantiles import exact_quantiles
from panelmerge.plans import reports


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(vals=st.lists(st.tuples(st.integers(0, 2), st.integers(-20, 20).map(lambda x: x / 4)), min_size=1, max_size=40))
def test_exact_quantiles_match_numpy(spark, vals):
    df = spark.createDataFrame(vals, "g int, v double")
    qs = [0.0, 0.25, 0.5, 0.75, 1.0]
    out = {r.g: [r[f"q_{i}"] for i in range(5)] for r in exact_quantiles(df, "v", qs, ["g"], buckets=4).collect()}
    for g in {g for g, _ in vals}:
        exp = np.quantile(np.array([v for gg, v in vals if gg == g]), qs)
        assert np.allclose(out[g], exp)


def test_quantiles_hot_value_and_methods(spark):
    rows = [(0, 1.0)] * 500 + [(0, float(i)) for i in range(100)]
    df = spark.createDataFrame(rows, "g int, v double")
    exact = exact_quantiles(df, "v", [0.5, 0.9], ["g"], passes=1, buckets=8).first()
    single = exact_quantiles(df, "v", [0.5, 0.9], ["g"], method="single").first()
    exp = np.quantile([v for _, v in rows], [0.5, 0.9])
    assert np.allclose([exact.q_0, exact.q_1], exp) and np.allclose([single.q_0, single.q_1], exp)


def test_corr_zero_variance_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (None, 1.0)], "a double, b double")
    r = stats.pair_agreement(df, [("a", "b", "ab"), ("a", "a", "aa")]).orderBy("ordinal").collect()
    assert r[0].n == 2 and r[0].corr is None and r[0].max_abs == 2.0
    single = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    assert stats.pair_agreement(single, [("a", "b", "x")]).first().corr is None
    empty = spark.createDataFrame([(1.0, None)], "a double, b double")
    assert stats.pair_agreement(empty, [("a", "b", "x")]).count() == 0


def test_conflict_invariants_and_coverage(spark):
    rows = [(1, 1, 10.0, 12.6, None), (1, 2, 10.0, 12.5, 11.0), (2, 1, None, None, 5.0), (2, 2, None, None, None)]
    df = spark.createDataFrame(rows, "e int, p int, a double, b double, c double")
    r = reports.le_conflicts(df, ["a", "b", "c"], 2.5).first()
    assert (r.total_rows, r.testable_rows, r.severe_conflicts) == (4, 2, 1)
    assert r.within_tolerance + r.severe_conflicts == r.testable_rows
    cov = {x.n_sources: x.rows for x in stats.source_coverage(df, ["a", "b", "c"]).collect()}
    assert cov == {2: 1, 3: 1, 1: 1, 0: 1} and sum(cov.values()) == 4


def test_top_k_ties_break_by_key(spark):
    df = spark.createDataFrame([(3, 5.0), (1, 5.0), (2, 5.0), (4, None)], "e int, v double")
    assert [r.e for r in rank.top_k(df, "v", 2, ["e"]).collect()] == [1, 2]


def test_select_period_fallback_and_ticks(spark):
    df = spark.createDataFrame([(1, 2018, 1.0, 1.0), (2, 2019, 1.0, None), (3, 2017, 2.0, 2.0)],
                               "e int, y int, a double, b double")
    assert [r.y for r in rank.select_period(df, "y", 2019, ["a", "b"]).collect()] == [2018]
    assert [r.y for r in rank.select_period(df, "y", 2017, ["a", "b"]).collect()] == [2017]
    years = sorted([1950] * 3 + [1960] * 5 + [2000] * 2)
    t = spark.createDataFrame([(y,) for y in years], "y int")
    ticks = [r.y for r in rank.rank_ticks(t, "y", 6).orderBy("tick").collect()]
    pos = np.linspace(0, len(years) - 1, 6).astype(int)
    assert ticks == [years[p] for p in pos]


def test_bounds_edges_and_dq_vacuous_pass(spark):
    df = spark.createDataFrame([(1, 1950, 13.0, 95.0), (1, 2024, 12.99, 95.01)], "e int, p int, a double, b double")
    r = {x.column: x for x in stats.bounds_check(df, ["a", "b"], 13, 95, "p", 1950, 2024).collect()}
    assert (r["a"].below, r["b"].above, r["p"].out_of_bounds) == (1, 1, 0)
    card = reports.dq_scorecard(df, ["e", "p"], ["a", "b"], bounds=(13, 95), period_range=(1950, 2024),
                                pairs=[("x", "y", "absent")], rule=("x", "y"))
    got = {x.dimension: x for x in card.collect()}
    assert got["accuracy"].passed and got["accuracy"].checked_rows == 0
    assert got["consistency"].passed and got["consistency"].checked_rows == 0
    assert not got["validity"].passed and got["uniqueness"].passed
    g = reports.dq_grade(card).first()
    assert (g.passed, g.total, g.grade) == (4, 5, "B")


def test_decade_distribution_whiskers(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 100.0]
    df = spark.createDataFrame([(1990 + i, v) for i, v in enumerate(vals)], "y int, v double")
    r = stats.decade_distribution(df, "y", "v").first()
    q1, q3 = np.quantile(vals, [0.25, 0.75])
    assert (r.q1, r.q3, r.outliers, r.whisker_hi, r.whisker_lo) == (q1, q3, 1, 4.0, 1.0)


def test_value_scorecard_legacy_constants(spark):
    ba = spark.createDataFrame([(1, 9, 100, 200, 0, 5, 100.0, 1)],
                               "schemas long, final_columns int, final_rows long, raw_rows long, "
                               "final_duplicate_keys long, final_out_of_bounds long, code_fill_pct double, "
                               "final_entities long")
    computed = {r.dimension: r.passed for r in reports.value_scorecard(ba, min_entities=0).collect()}
    legacy = {r.dimension: r.passed for r in reports.value_scorecard(ba, min_entities=0, legacy=True).collect()}
    assert computed["validity_enforcement"] is False and legacy["validity_enforcement"] is True
    assert reports.value_scorecard(ba, min_entities=0, legacy=True).first().grade == "A"


def test_quantiles_skip_nan_and_extreme_magnitudes(spark):
    vals = [float("nan"), None, -1e308, 1e308, 0.0, 1.5]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    r = exact_quantiles(df, "v", [0.0, 0.5, 1.0]).first()
    clean = np.array([-1e308, 1e308, 0.0, 1.5])
    assert [r.q_0, r.q_1, r.q_2] == list(np.quantile(clean, [0.0, 0.5, 1.0]))


def test_quantile_survivors_do_not_depend_on_the_values(spark):
    """Three far outliers must not leave the whole column for the last step."""
    from pyspark.sql import functions as F

    from panelmerge.operators import quantiles as Qn
    n = 100_000
    df = spark.range(n).select((F.col("id") * 7919 % n).cast("double").alias("v"))
    df = df.unionByName(spark.createDataFrame([(1e100,), (1e200,), (1e300,)], "v double"))
    base = df.select(F.col("v").alias("__v"))
    stats_ = base.agg(F.expr("count(1) AS __n"), F.expr(Qn._grid("__v", Qn.DEFAULT_BUCKETS)))
    targets = stats_.selectExpr("__n", "__grid", f"CAST({n // 2} AS BIGINT) AS __k1", f"CAST({n // 2} AS BIGINT) AS __k2")
    left = Qn.survivors(base, targets, [], Qn.DEFAULT_PASSES, Qn.DEFAULT_BUCKETS)
    assert left.count() < 100 and left.agg(F.sum("__c")).first()[0] > n // 2
    got = exact_quantiles(df, "v", [0.0, 0.25, 0.5, 1.0]).first()
    assert tuple(got) == (0.0, 25000.5, 50001.0, 1e300)


def test_scorecard_uniqueness_can_fail_and_types_are_reported(spark):
    from panelmerge.plans import reports
    rows = [("a", 1, 50.0, 50.0), ("a", 1, 50.0, 50.0), ("b", 2, 60.0, 61.0)]
    df = spark.createDataFrame(rows, "e string, p int, x double, y double")
    card = {r.dimension: r for r in reports.dq_scorecard(df, ["e", "p"], ["x", "y"], bounds=(0, 100), period_range=(0, 9),
                                                         pairs=[("x", "y", "x y")], rule=("x", "y")).collect()}
    assert not card["uniqueness"].passed and card["validity"].type_ok
