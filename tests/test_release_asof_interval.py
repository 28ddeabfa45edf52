"""New releases by digest trees, as-of joins over ranges, interval joins by bins: against plain Python."""

import datetime
import os
import random

import pytest
from pyspark.sql import functions as F

from panelmerge.operators import interval, release
from panelmerge.operators.asof import asof_join, carry_last
from panelmerge.operators.interval import interval_join
from panelmerge.operators.merge import merge_panel

KEYS = ["e", "p"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def source(spark, data, metric):
    return spark.createDataFrame([(*k, v) for k, v in data], f"e string, p int, {metric} double")


def random_source(rng, n=60):
    return [((rng.choice("abcdefgh"), rng.randint(0, 12)), rng.choice([None, 1.0, 2.0, 3.0])) for _ in range(n)]


def test_releases_equal_the_full_merge(spark, tmp_path):
    rng, folder = random.Random(1), str(tmp_path)
    held = {"x": random_source(rng), "y": random_source(rng), "z": []}
    with pytest.raises(ValueError):
        release.current_panel(spark, folder)
    given = list(held)
    for number in range(5):
        frames = {s: source(spark, held[s], f"m_{s}") for s in given}
        assert release.apply_release(spark, folder, frames, KEYS, buckets=8, fanout=2, on_duplicate="mean") == number
        full = merge_panel([source(spark, data, f"m_{s}") for s, data in held.items()], KEYS, on_duplicate="mean")
        got = release.current_panel(spark, folder)
        assert got.columns == full.columns and rows(got) == rows(full)
        if number == 0:  # a value, a new key, a lost row
            held["x"][3] = (held["x"][3][0], 9.0)
            held["y"] = held["y"][1:] + [(("new", 1), 4.0)]
            given = ["x", "y"]
        elif number == 1:  # the same rows in another order: nothing changes
            held["x"] = held["x"][::-1]
            given = ["x"]
        elif number == 2:  # a source comes to be, another loses all rows, one is new
            held["z"], held["y"], held["w"] = random_source(rng, 9), [], [(("a", 1), 5.0), (("a", 1), 7.0), ((None, 1), 1.0)]
            given = ["z", "y", "w"]
        elif number == 3:
            held["w"].append((("a", 1), 5.0))  # a repeated row
            given = ["w"]
    with pytest.raises(ValueError):
        release.apply_release(spark, folder, {"x": source(spark, [], "m_x")}, KEYS, buckets=4, fanout=2)


def test_a_release_reads_and_writes_only_what_changed(spark, tmp_path):
    folder = str(tmp_path)
    data = [((f"e{i}", 0), float(i)) for i in range(200)]
    release.apply_release(spark, folder, {"x": source(spark, data, "x"), "y": source(spark, data, "y")}, KEYS, buckets=32, fanout=4)
    data[7] = (data[7][0], -1.0)
    release.apply_release(spark, folder, {"x": source(spark, data, "x")}, KEYS, buckets=32, fanout=4)

    def folders(path):
        return sorted(d for d in os.listdir(path) if not d.startswith((".", "_")))

    assert folders(f"{folder}/sources/release=1") == ["source=x"]
    bucket = folders(f"{folder}/sources/release=1/source=x")
    assert len(bucket) == 1 and folders(f"{folder}/panel/release=1") == bucket
    manifest = spark.read.parquet(f"{folder}/manifest/release=1")
    number = int(bucket[0].split("=")[1])
    read = release.source_rows(spark, folder, manifest, "y", [number])
    assert read.count() < 30
    assert all(f"bucket={number}/" in f or "PartitionFilters" in plan(read) for f in read.inputFiles())
    before, after = (spark.read.parquet(f"{folder}/manifest/release={i}") for i in (0, 1))
    assert rows(release.changed_buckets(before, after, 32, 4)) == [("x", number)]
    assert release.changed_buckets(after, after, 32, 4).count() == 0
    # A run that dies before its manifest leaves the former release in force.
    spark.range(3).write.parquet(f"{folder}/panel/release=2")
    assert release.latest_release(spark, folder) == 1
    assert {tuple(r) for r in release.current_panel(spark, folder).filter("e = 'e7'").collect()} == {("e7", 0, -1.0, 7.0)}


def test_digests_tell_nulls_and_repeats(spark):
    a = spark.createDataFrame([("s", 0, 1, None)], "source string, bucket int, u int, v int")
    b = spark.createDataFrame([("s", 0, None, 1)], a.schema)
    assert rows(release.digests(a, ["source", "bucket"])) != rows(release.digests(b, ["source", "bucket"]))
    twice = release.digests(a.union(a), ["source", "bucket"])
    assert rows(twice) != rows(release.digests(a, ["source", "bucket"]))
    assert rows(twice) == rows(release.digests(a.union(a).repartition(3), ["source", "bucket"]))


def test_asof_equals_brute_force(spark):
    rng = random.Random(2)
    key = lambda: "hot" if rng.random() < 0.4 else rng.choice(["a", "b", None])
    left = [(i, key(), rng.choice([None, *range(-5, 40)])) for i in range(300)]
    right = [(key(), rng.choice([None, *range(-3, 35)]), rng.choice([None, "u", "v"]), float(rng.randint(0, 3))) for _ in range(120)]
    a = spark.createDataFrame(left + left[:5], "id int, k string, t int")
    b = spark.createDataFrame(right, "k string, rt int, name string, v double")
    want = []
    for i, k, t in left + left[:5]:
        seen = [r for r in right if k is not None and t is not None and r[0] == k and r[1] is not None and r[1] <= t]
        best = max(seen, key=lambda r: (r[1], r[2] is not None, r[2] or "", r[3])) if seen else (None,) * 4
        want.append((i, k, t, *best[1:]))
    for parts in (1, 3, 16):
        got = asof_join(a, b, ["k"], "t", "rt", parts=parts)
        assert got.columns == ["id", "k", "t", "matched_at", "name", "v"]
        assert rows(got) == sorted(want, key=repr)
    assert rows(asof_join(a, b.limit(0), ["k"], "t", "rt").select("matched_at").distinct()) == [(None,)]
    assert asof_join(a.limit(0), b, ["k"], "t", "rt").count() == 0
    with pytest.raises(ValueError):
        asof_join(a, b.withColumn("id", F.lit(1)), ["k"], "t", "rt")


def test_a_hot_entity_is_cut_into_ranges(spark):
    """A third of the rows is one entity, of one time for the most part; no window holds them all."""
    n = 30000
    left = spark.range(n).select("id", F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), F.lit(5).alias("t"))
    right = spark.createDataFrame([(0, 1, 10.0), (0, 4, 40.0), (0, 6, 60.0), (1, 5, 1.0)], "k long, rt int, v double")
    got = asof_join(left, right, ["k"], "t", "rt", parts=8)
    assert got.filter("k = 0 AND v = 40.0").count() == n // 3 and got.filter("v IS NOT NULL").count() == n // 3 + 1
    text = plan(got)
    assert "Window" in text and "hashpartitioning(__part" in text


def test_carried_values_equal_brute_force(spark):
    rng = random.Random(3)
    data = [(k, t, rng.choice([None, None, 1.0, 2.0]), rng.choice([None, 5.0])) for k in ("a", "b", "c") for t in rng.sample(range(60), 40)]
    extra = [(None, 1, None, 5.0), ("a", None, None, 5.0)]
    df = spark.createDataFrame(data + extra, "k string, t int, u double, v double")
    want = list(extra)
    for k, t, *ms in data:
        filled = []
        for i in (0, 1):
            seen = [(r[1], r[2 + i]) for r in data if r[0] == k and r[1] <= t and r[2 + i] is not None]
            filled.append(max(seen)[1] if seen else None)
        want.append((k, t, *filled))
    for parts in (1, 7):
        assert rows(carry_last(df, ["k"], "t", ["u", "v"], parts=parts)) == sorted(want, key=repr)
    assert carry_last(df.limit(0), ["k"], "t", ["u"]).count() == 0


def test_intervals_equal_brute_force(spark):
    rng = random.Random(4)
    spans = [(rng.choice(["a", "b", None]), i, rng.choice([None, rng.randint(-200, 200)]), rng.choice([None, rng.randint(-200, 400)])) for i in range(80)]
    spans += [("a", 900, -(2**62), 2**62), ("a", 901, 5, 6), ("a", 902, -17, -16), ("b", 903, 0, 2**57), ("b", 904, -(2**63), 2**63 - 1)]
    points = [(rng.choice(["a", "b", "c", None]), j, rng.choice([None, rng.randint(-250, 450)])) for j in range(120)] + [("a", 500, -17), ("b", 501, 2**56)]
    a = spark.createDataFrame(points, "k string, j int, t long")
    b = spark.createDataFrame(spans, "k string, i int, lo long, hi long")
    want = sorted(((k, j, t, i, lo, hi) for k, j, t in points for c, i, lo, hi in spans
                   if k is not None and k == c and t is not None and (lo is None or lo <= t) and (hi is None or t < hi)), key=repr)
    for fanout in (2, 16, 64):
        assert rows(interval_join(a, b, ["k"], "t", "lo", "hi", fanout=fanout)) == want
    text = plan(interval_join(a, b, ["k"], "t", "lo", "hi"))
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert interval_join(a, b.limit(0), ["k"], "t", "lo", "hi").count() == 0 == interval_join(a.limit(0), b, ["k"], "t", "lo", "hi").count()
    day = datetime.date
    dates = interval_join(spark.createDataFrame([("a", day(1960, 1, 1))], "k string, d date"),
                          spark.createDataFrame([("a", day(1959, 12, 31), day(1960, 1, 2), "x"), ("a", day(1960, 1, 2), None, "y")], "k string, f date, u date, n string"),
                          ["k"], "d", "f", "u")
    assert [r.n for r in dates.collect()] == ["x"]
    with pytest.raises(TypeError):
        interval_join(a, b.withColumn("hi", F.col("hi").cast("int")), ["k"], "t", "lo", "hi")


def test_points_of_keys_with_few_intervals_travel_once(spark, monkeypatch):
    rng = random.Random(5)
    spans = [(key, i, lo, rng.choice([None, lo + rng.randint(0, 300)])) for i in range(60) for key, lo in [(rng.choice("aab"), rng.randint(-200, 200))]]
    spans += [("c", 100, 1, 9), ("c", 101, None, None), (None, 102, 1, 9)]
    points = [(rng.choice(["a", "b", "c", "d", None]), j, rng.choice([None, rng.randint(-250, 450)])) for j in range(150)]
    a = spark.createDataFrame(points, "k string, j int, t long")
    b = spark.createDataFrame(spans, "k string, i int, lo long, hi long")
    want = sorted(((k, j, t, i, lo, hi) for k, j, t in points for c, i, lo, hi in spans
                   if k is not None and k == c and t is not None and (lo is None or lo <= t) and (hi is None or t < hi)), key=repr)
    # No bins were made where no key has many intervals.
    got = interval_join(a, b, ["k"], "t", "lo", "hi")
    assert rows(got) == want
    assert "__level" not in got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    for few in (0, 2, 30):  # all keys, two of three, one
        monkeypatch.setattr(interval, "FEW", few)
        for fanout in (2, 16):
            got = interval_join(a, b, ["k"], "t", "lo", "hi", fanout=fanout)
            assert rows(got) == want
            assert "__level" in got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
