"""Merge strategies: properties (join == union on key-unique sources, order
invariance, key-set union, fill preservation) and plan shape."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from panelmerge.operators.merge import long_to_panel, merge_panel

KEYS = ["e", "p"]

src_rows = st.lists(st.tuples(st.integers(0, 4), st.integers(0, 3),
                              st.one_of(st.none(), st.floats(-50, 50, allow_nan=False).map(lambda x: round(x, 2)))),
                    max_size=12)


def _unique(rows):
    seen, out = set(), []
    for e, p, v in rows:
        if (e, p) not in seen:
            seen.add((e, p))
            out.append((e, p, v))
    return out


def _df(spark, rows, m, name=None):
    df = spark.createDataFrame(rows, f"e int, p int, {m} double")
    if name:
        from pyspark.sql import functions as F
        df = df.withColumn("name", F.concat(F.lit(name), F.col("e").cast("string")))
    return df


def _set(df):
    return sorted(tuple(r) for r in df.collect())


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(a=src_rows, b=src_rows, c=src_rows)
def test_join_equals_union_and_order_invariant(spark, a, b, c):
    srcs = [_df(spark, _unique(a), "m1"), _df(spark, _unique(b), "m2"), _df(spark, _unique(c), "m3")]
    u = merge_panel(srcs, KEYS, strategy="union")
    j = merge_panel(srcs, KEYS, strategy="join")
    assert _set(u) == _set(j)
    rev = merge_panel(srcs[::-1], KEYS).select("e", "p", "m1", "m2", "m3")
    assert _set(rev) == _set(u)
    # key set is the union of source key sets; fill counts are preserved
    keys = {(e, p) for rows in (a, b, c) for e, p, _ in _unique(rows)}
    assert {(r.e, r.p) for r in u.collect()} == keys
    for i, rows in enumerate((a, b, c), 1):
        assert u.filter(f"m{i} IS NOT NULL").count() == sum(v is not None for *_, v in _unique(rows))


def test_collision_first_non_null_name_in_source_order(spark):
    s1 = spark.createDataFrame([(1, 1, 1.0, None), (2, 1, 2.0, "b1")], "e int, p int, m1 double, name string")
    s2 = spark.createDataFrame([(1, 1, 5.0, "a2"), (2, 1, 6.0, "b2"), (3, 1, 7.0, "c2")],
                               "e int, p int, m2 double, name string")
    for strategy in ("union", "join"):
        out = merge_panel([s1, s2], KEYS, name_col="name", strategy=strategy)
        assert {(r.e, r.name) for r in out.collect()} == {(1, "a2"), (2, "b1"), (3, "c2")}


def test_duplicate_policies(spark):
    s1 = spark.createDataFrame([(1, 1, 1.0, 2), (1, 1, 3.0, 1)], "e int, p int, m1 double, o int")
    s2 = spark.createDataFrame([(1, 1, 5.0, 0)], "e int, p int, m2 double, o int")
    srcs = [s1.drop("o"), s2.drop("o")]
    assert merge_panel(srcs, KEYS, on_duplicate="mean").first().m1 == 2.0
    assert merge_panel(srcs, KEYS, on_duplicate="max").first().m1 == 3.0
    assert merge_panel([s1, s2], KEYS, on_duplicate="first", order_col="o").first().m1 == 3.0
    assert merge_panel(srcs, KEYS, on_duplicate="multiply").count() == 2
    with pytest.raises(Exception, match="duplicate key"):
        merge_panel(srcs, KEYS, on_duplicate="error").collect()


def test_null_keys_dropped(spark):
    s1 = spark.createDataFrame([(None, 1, 1.0), (1, 1, 2.0)], "e int, p int, m1 double")
    assert merge_panel([s1], KEYS).count() == 1


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_union_plan_has_single_exchange(spark):
    srcs = [spark.range(100).selectExpr("id % 10 AS e", "id % 7 AS p", f"CAST(id AS DOUBLE) AS m{i}") for i in range(5)]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(merge_panel(srcs, KEYS, on_duplicate="mean"))
        assert plan.count("Exchange hashpartitioning") == 1
        jplan = _plan(merge_panel(srcs, KEYS, strategy="join"))
        assert jplan.count("SortMergeJoin") == 4
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_long_to_panel_matches_union_merge(spark):
    rows = [(i % 5, i % 3, ["a", "b", "c"][i % 3 if i % 4 else 0], float(i)) for i in range(60)]
    lng = spark.createDataFrame(rows, "e int, p int, s string, v double")
    wide = long_to_panel(lng, KEYS, "s", "v", {"a": "m_a", "b": "m_b", "c": "m_c"})
    srcs = [lng.filter(f"s = '{s}'").selectExpr("e", "p", f"v AS m_{s}") for s in "abc"]
    assert _set(wide) == _set(merge_panel(srcs, KEYS, on_duplicate="mean"))


def test_metric_aggs_merge_finer_grain_in_one_shuffle(spark):
    orders = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, 30.0)], "k int, total double")
    lines = spark.createDataFrame([(1, 4.0), (1, 5.0), (2, 25.0), (4, 1.0)], "k int, net double")
    exp = {(1, 10.0, 9.0), (2, 20.0, 25.0), (3, 30.0, None), (4, None, 1.0)}
    for strategy in ("union", "join"):
        out = merge_panel([orders, lines], ["k"], strategy=strategy, metric_aggs={"net": "sum"})
        assert {tuple(r) for r in out.collect()} == exp
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(merge_panel([orders, lines], ["k"], metric_aggs={"net": "sum"}))
        assert plan.count("Exchange hashpartitioning") == 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
