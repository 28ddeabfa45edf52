"""One key holding a third of all rows: results stay exact and no operator
puts raw rows of a key into a window."""

import numpy as np
from pyspark.sql import functions as F

from panelmerge.operators.clean import dedup_first
from panelmerge.operators.merge import merge_panel
from panelmerge.operators.quantiles import exact_quantiles
from panelmerge.operators.stats import key_facts

N = 30000


def _skewed(spark):
    # ids 0..N-1; every third row belongs to the hot key (0, 0)
    return spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("e"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 7).alias("p"),
        (F.col("id") % 101).cast("double").alias("m1"),
        F.col("id").alias("o"))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_merge_dedup_and_facts(spark):
    df = _skewed(spark)
    hot = [i for i in range(N) if i % 3 == 0]
    merged = merge_panel([df.drop("o")], ["e", "p"], on_duplicate="mean")
    row = merged.filter("e = 0 AND p = 0").first()
    assert row.m1 == np.mean([i % 101 for i in hot])
    first = dedup_first(df, ["e", "p"], ["o"])
    assert first.filter("e = 0 AND p = 0").first().o == 0
    assert first.count() == N - len(hot) + 1
    kf = key_facts(df.drop("o"), ["e", "p"]).first()
    assert kf.max_rows_per_key == len(hot) and kf.duplicate_keys == len(hot) - 1
    for d in (merged, first, kf and key_facts(df, ["e", "p"])):
        assert "Window" not in _plan(d)


def test_hot_group_quantiles_exact(spark):
    df = _skewed(spark).select(F.when(F.col("e") == 0, 0).otherwise(1).alias("g"), "m1")
    out = {r.g: (r.q_0, r.q_1) for r in exact_quantiles(df, "m1", [0.5, 0.99], ["g"]).collect()}
    hot = np.array([float(i % 101) for i in range(N) if i % 3 == 0])
    assert np.allclose(out[0], np.quantile(hot, [0.5, 0.99]))
