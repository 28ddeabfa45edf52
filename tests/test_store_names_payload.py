"""Clustered store, name proposals, VARIANT payloads, sub-totals, reports of one scan."""

import json
import random
import uuid

from pyspark.sql import functions as F

from panelmerge.operators import entities, stats
from panelmerge.plans import reports
from panelmerge.sources import payload
from panelmerge.sources.sinks import key_sizes, store_panel, stored_panel


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(spark, path, report):
    return plan(report(spark.read.parquet(path))).count("FileScan parquet")


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_stored_panel_needs_no_exchange_and_replaces_its_periods(spark, tmp_path):
    table = f"panel_{uuid.uuid4().hex}"
    first = spark.createDataFrame([(c, y, float(i)) for i, (c, y) in enumerate((c, y) for c in "ABCD" for y in (2000, 2001))], "iso3 string, year int, v double")
    store_panel(first, table, ["iso3", "year"], "year", buckets=4, path=str(tmp_path / "store"))
    sizes = key_sizes(stored_panel(spark, table), ["iso3", "year"], "year")
    assert "Exchange" not in plan(sizes) and sizes.count() == 8
    # Both sides of a join by entity are laid out alike.
    joined = stored_panel(spark, table).hint("merge").join(stored_panel(spark, table).withColumnRenamed("v", "w"), "iso3")
    assert "Exchange" not in plan(joined) and "SortMergeJoin" in plan(joined)
    store_panel(spark.createDataFrame([("A", 2001, 9.0), ("E", 2002, 5.0)], "iso3 string, year int, v double"), table, ["iso3", "year"], "year", buckets=4)
    got = sorted((r.iso3, r.year, r.v) for r in stored_panel(spark, table).collect())
    assert got == [("A", 2000, 0.0), ("A", 2001, 9.0), ("B", 2000, 2.0), ("C", 2000, 4.0), ("D", 2000, 6.0), ("E", 2002, 5.0)]
    spark.sql(f"DROP TABLE {table}")


def test_proposals_equal_brute_force(spark):
    rng = random.Random(4)
    names = ["", "a", "b", "ab", "ba", "abc", "aaaa", "Côte", *("".join(rng.choice("abcé ") for _ in range(rng.randint(1, 14))) for _ in range(60))]
    known = [(n, f"K{i}") for i, n in enumerate(dict.fromkeys(names[::2]))]
    unknown = [*names[1::2], "Cote", names[1], None]
    a, b = spark.createDataFrame([(n,) for n in unknown], "name string"), spark.createDataFrame([*known, (None, "N")], "name string, code string")
    for d in (1, 2):
        got = sorted(map(tuple, entities.propose_names(a, b, distance=d).collect()))
        want = sorted({(n, c, code, distance(n, c)) for n in unknown if n is not None for c, code in known if distance(n, c) <= d})
        assert got == want and want
    text = plan(entities.propose_names(a, b))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert entities.propose_names(a.limit(0), b).count() == 0


def test_records_with_changed_fields_survive(spark, tmp_path):
    page = [{"page": 1}, [{"countryiso3code": "AAA", "country": {"value": "Alpha", "id": "A"}, "date": "1950", "value": "41.5", "unit": None, "new": [1, 2]},
                          {"countryiso3code": " ", "country": "none", "date": 1951, "value": 3}, {"value": "x"}, 7]]
    df = spark.createDataFrame([(json.dumps(page), "f1"), ("[1", "f2"), ("[1]", "f3"), (None, "f4"), ('[{}, {"a": 1}]', "f5")], "value string, file string")
    got = payload.explode_records(df)
    assert [(r.file, r.pos) for r in got.orderBy("file", "pos").collect()] == [("f1", i) for i in range(4)]
    rows = {r.year: r for r in payload.flatten_records(df).collect()}
    assert rows[1950].value == 41.5 and json.loads(rows[1950].extra) == {"unit": None, "new": [1, 2]}
    assert (rows[1951].iso3, rows[1951].country_name, rows[1951].value, rows[1951].extra) == (None, None, 3.0, None)
    (tmp_path / "lines.jsonl").write_text("\n".join(json.dumps(x) for x in page[1]) + "\n\n")
    lines = payload.explode_records(payload.read_record_lines(spark, str(tmp_path / "lines.jsonl")), path=None)
    assert lines.count() == 4
    assert "ARRAY" in payload.inferred_schema(got.filter("pos = 0")).first()[0]


def test_subtotals(spark):
    df = spark.createDataFrame([("a", 2000, 1.0), ("a", 2000, None), ("b", 2001, 3.0), (None, 2001, 5.0)], "iso3 string, year int, v double")
    got = {(r.level, r.year): (r.rows, r.entities, r.v_filled, r.v_sum) for r in stats.subtotals(df, [["year"], []], "iso3", ["v"]).collect()}
    assert got == {("year", 2000): (2, 1, 1, 1.0), ("year", 2001): (2, 1, 2, 8.0), ("", None): (4, 2, 3, 9.0)}
    by_entity = {(r.level, r.iso3): r.entities for r in stats.subtotals(df, [["iso3"], []], "iso3", []).collect()}
    assert by_entity == {("iso3", "a"): 1, ("iso3", "b"): 1, ("iso3", None): 0, ("", None): 2}


def test_reports_scan_a_table_once(spark, tmp_path):
    path = str(tmp_path / "panel")
    rows = [("a", 2000, 1.0), ("a", 2000, 1.0), ("a", 2000, 2.0), ("b", None, None), (None, 2001, 7.0)]
    spark.createDataFrame(rows, "iso3 string, year int, v double").write.parquet(path)
    df = spark.read.parquet(path)
    audit = lambda x: reports.audit_keys(x, "iso3", "year")
    final = lambda x: reports.final_profile(x, "iso3", "year", None, ["v"], (0, 5))
    source = lambda x: reports.source_profile(spark, [{"label": "s", "code": "iso3", "metric": "v", "period": "year", "load": lambda: x}], (0, 5))
    assert [scans(spark, path, r) for r in (audit, final, source)] == [1, 1, 1]
    a, f, s = audit(df).first(), final(df).first(), source(df).first()
    assert (a.rows, a.entity_nulls, a.period_nulls, a.entities, a.duplicate_keys, a.duplicate_rows, a.duplicate_pct) == (5, 1, 1, 2, 2, 1, 20.0)
    assert (f.rows, f.entities, f.duplicate_keys, f.out_of_bounds, f.avg_metric_fill_pct, f.code_fill_pct) == (5, 2, 2, 1, 80.0, 80.0)
    assert (s.rows, s.out_of_bounds, s.metric_fill_pct, s.duplicate_rows, s.entities, s.metric_max) == (5, 1, 80.0, 1, 2, 7.0)
    empty = df.filter(F.lit(False))
    assert (audit(empty).first().rows, final(empty).first().rows, source(empty).first().rows, source(empty).first().metric_fill_pct) == (0, 0, 0, 0.0)
