"""United sketches: exact parts equal, estimates within the stated errors, a refresh touches its partitions only."""

import os

from pyspark.sql import functions as F

from panelmerge.operators import sketches


def data(spark, n=40000):
    return spark.range(n).select((F.col("id") % 4).cast("int").alias("p"), (F.col("id") % 9001).alias("e"), (F.col("id") % 3).cast("string").alias("s"),
                                 F.when(F.col("id") % 5 > 0, (F.xxhash64("id") % 100000).cast("double")).alias("v"), F.lit(None).cast("double").alias("w"))


def test_united_sketches_keep_their_errors(spark, tmp_path):
    df, path = data(spark), str(tmp_path / "s")
    sketches.refresh_sketches(df, path, "p", "e", ["v", "w"], dims=["s"])
    stored = sketches.stored_sketches(spark, path)
    for by in ([], ["s"], ["p", "s"]):
        got = sketches.united_report(stored, ["v", "w"], by)
        want = {tuple(r[c] for c in by): r for r in df.groupBy(*by).agg(
            F.count("*").alias("rows"), F.countDistinct("e").alias("entities"), F.count("v").alias("filled"), F.avg("v").alias("mean"),
            F.min("v").alias("min"), F.max("v").alias("max"), F.sort_array(F.collect_list("v")).alias("all")).collect()}
        assert got.count() == 2 * len(want)
        for r in got.collect():
            w = want[tuple(r[c] for c in by)]
            assert r.rows == w.rows and abs(r.entities - w.entities) <= 0.04 * w.entities
            if r.metric == "w":
                assert r.filled == 0 and r.mean is r.min is r.q50 is None
                continue
            assert (r.filled, r.min, r.max) == (w.filled, w["min"], w["max"]) and abs(r["mean"] - w["mean"]) < 1e-6 * abs(w["max"])
            for q, est in ((0.25, r.q25), (0.5, r.q50), (0.75, r.q75)):
                below = sum(x < est for x in w["all"]) / r.filled
                upto = sum(x <= est for x in w["all"]) / r.filled
                assert below - 0.02 <= q <= upto + 0.02


def test_a_refresh_replaces_its_partitions_only(spark, tmp_path):
    path = str(tmp_path / "s")
    sketches.refresh_sketches(data(spark), path, "p", "e", ["v"])
    before = {p: sorted(os.listdir(f"{path}/p={p}")) for p in range(4)}
    sketches.refresh_sketches(spark.createDataFrame([(2, 1, 5.0), (2, 2, float("nan")), (7, None, 6.0)], "p int, e long, v double"), path, "p", "e", ["v"])
    assert all(sorted(os.listdir(f"{path}/p={p}")) == before[p] for p in (0, 1, 3)) and sorted(os.listdir(f"{path}/p=2")) != before[2]
    got = {r.p: r for r in sketches.united_report(sketches.stored_sketches(spark, path), ["v"], ["p"]).collect()}
    assert set(got) == {0, 1, 2, 3, 7} and (got[2].rows, got[2].entities, got[2].filled, got[2].q50) == (2, 2, 1, 5.0)
    assert (got[7].rows, got[7].entities) == (1, 0)
    # Reports read the sketches: some kilobytes a partition whatever its rows.
    assert sketches.stored_sketches(spark, path).count() == 5
