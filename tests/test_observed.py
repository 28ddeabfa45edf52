"""Facts from the pass that stores the rows: equal to those of a scan, in the writing stage, on no rows too."""

from pyspark.sql import functions as F

from panelmerge.operators import clean, stats
from panelmerge.plans import observed


def data(spark):
    rows = [(f"e{i % 7}", 1950 + i % 90, None if i % 5 == 0 else float(i)) for i in range(500)] + [(None, 1990, 1.0), ("a", None, 2.0)]
    return spark.createDataFrame(rows, "iso3 string, year int, v double").repartition(5)


def steps():
    return [("code", F.col("iso3").isNotNull()), ("value", F.col("v").isNotNull()), ("period", clean.period_predicate("year", 1960, 2000))]


def test_stored_steps_equal_the_lineage(spark, tmp_path):
    df = data(spark)
    kept, counts = observed.store_steps(df, steps(), str(tmp_path / "a"))
    want = clean.clean_lineage(df, steps()).orderBy("ordinal").collect()
    got = observed.lineage_frame(spark, {"s": counts}).orderBy("ordinal").collect()
    assert [tuple(r)[1:] for r in got] == [tuple(r) for r in want]
    assert kept.count() == want[-1]["rows"] > 0
    # Written over: counted anew. No rows: zeros.
    assert observed.store_steps(df.limit(0), steps(), str(tmp_path / "a"))[1] == [(n, 0) for n in ("input", "code", "value", "period")]
    none = spark.createDataFrame([], df.schema)
    kept, counts = observed.store_steps(none, steps(), str(tmp_path / "b"))
    assert kept.count() == 0 and {n for _, n in counts} == {0}


def test_facts_equal_the_reports(spark, tmp_path):
    panel = data(spark).na.drop(subset=["iso3", "year"]).groupBy("iso3", "year").agg(F.avg("v").alias("v"), F.max("v").alias("odd `name`"))
    stored, facts = observed.store_facts(panel, ["v", "odd `name`"], str(tmp_path / "p"), {"v": (10, 400)})
    got = {r["column"]: r for r in facts.collect()}
    n = panel.count()
    fill = {r["column"]: r for r in stats.column_fill(panel.withColumnRenamed("odd `name`", "odd"), ["iso3", "year", "v"]).collect()}
    assert stored.count() == n == got["v"].rows and set(got) == set(panel.columns)
    assert got["v"].fill_pct == 100.0 * panel.filter("v IS NOT NULL").count() / n and len(fill) == 3
    assert got["v"].out_of_bounds == panel.filter("v < 10 OR v > 400").count() > 0
    assert got["v"].min == panel.agg(F.min("v")).first()[0] and got["iso3"].min is None
    assert got["odd `name`"].out_of_bounds == 0 and got["iso3"].out_of_bounds is None
    none = observed.store_facts(panel.filter("false"), ["v"], str(tmp_path / "n"))[1].filter("column = 'v'").first()
    assert none.rows == 0 and none.fill_pct is None
