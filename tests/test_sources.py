"""Readers, sinks and the six spec-driven cleaners on hand-made fixtures."""

import json
import os
from dataclasses import replace

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from conftest import write
from panelmerge.configs import life_expectancy as LE
from panelmerge.operators import clean
from panelmerge.plans.pipeline import clean_source, run_pipeline
from panelmerge.sources import detect_encodings, read_csv_any_encoding, write_panel
from panelmerge.sources.payload import flatten_payload, read_payloads
from panelmerge.operators.entities import build_name_map

OWID = """Entity,Code,Year,Life expectancy
Alpha,AAA,1949,40.0
Alpha,AAA,1950,41.5
Alpha,AAA,2024,70.0
Alpha,AAA,2025,71.0
Beta,BBB,1990,60.0
Beta,BBC,1991,61.0
Gamma,GGG,2000,NaN
World,OWID_WRL,2000,66.0
Nowhere,,2000,50.0
Oldland,OLD,1900,30.0
Republic of Cote,CIV,2000,55.0
"""


def owid_spec(tmp_path):
    return replace(LE.REFERENCE, path=write(tmp_path / "owid.csv", OWID))


def name_map(spark, tmp_path):
    ref = read_csv_any_encoding(spark, owid_spec(tmp_path).path).withColumn("__row", F.monotonically_increasing_id())
    return build_name_map(ref, "Entity", "Code", "__row", "OWID_")


def _key(t):
    return tuple((v is not None, v if v is not None else 0) if not isinstance(v, str) else (True, 0, v) for v in t)


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=_key)


def test_owid_cleaner(spark, tmp_path):
    out = clean_source(spark, owid_spec(tmp_path))
    got = rows(out, "iso3", "year", "country_name", "life_exp_owid")
    # null code, OWID_ aggregate, pre-1950 / post-2024 rows removed; NaN -> NULL, row kept
    assert got == [("AAA", 1950, "Alpha", 41.5), ("AAA", 2024, "Alpha", 70.0), ("BBB", 1990, "Beta", 60.0),
                   ("BBC", 1991, "Beta", 61.0), ("CIV", 2000, "Republic of Cote", 55.0), ("GGG", 2000, "Gamma", None)]


def test_name_map_first_code_and_no_aggregates(spark, tmp_path):
    m = dict(rows(name_map(spark, tmp_path), "name", "code"))
    assert m["Beta"] == "BBB"            # first code for a name with two codes
    assert "World" not in m and "Nowhere" not in m
    assert m["Oldland"] == "OLD"          # not period filtered


WB_CSV = """iso3,country_name,year,life_exp_wb
AAA,Alpha,1950,41.0
,Nowhere,2000,50.0
ARB,Arab World,2000,68.0
BBB,Beta,2030,80.0
BBB,Beta,1990,59.5
"""


def test_worldbank_cleaner_csv(spark, tmp_path):
    spec = replace(LE.SOURCES[1], path=write(tmp_path / "wb.csv", WB_CSV))
    got = rows(clean_source(spark, spec), "iso3", "year", "life_exp_wb")
    assert got == [("AAA", 1950, 41.0), ("ARB", 2000, 68.0), ("BBB", 1990, 59.5)]


def test_payload_flatten(spark, tmp_path):
    payload = [{"page": 1, "pages": 1},
               [{"countryiso3code": "AAA", "country": {"value": "Alpha"}, "date": "1950", "value": 41.0},
                {"countryiso3code": "", "country": {"value": "Nowhere"}, "date": "2000", "value": 50.0},
                {"countryiso3code": "BBB", "country": {"value": "Beta"}, "date": "1991", "value": None}]]
    p = write(tmp_path / "wb.json", json.dumps(payload))
    out = flatten_payload(read_payloads(spark, p))
    got = sorted(rows(out, "iso3", "country_name", "year", "value"), key=lambda t: t[1])
    assert got == [("AAA", "Alpha", 1950, 41.0), (None, "Nowhere", 2000, 50.0)]


KAGGLE = ("Country,Year,Life expectancy \n"
          "Côte d'Ivoire,2000,50.0\n"
          " Viet Nam\t,2001,70.0\n"
          "Venezuella (Bolivarian Republic of),2002,72.0\n"
          "Atlantis,2003,60.0\n"
          "Alpha,1999,\n"
          "Alpha,1999,65.0\n")


def test_kaggle_cleaner_latin1(spark, tmp_path):
    path = write(tmp_path / "kaggle.csv", KAGGLE, encoding="latin-1")
    enc = detect_encodings(spark, path).first()["encoding"]
    assert enc == "ISO-8859-1"
    rules = dict(LE.CORRECTIONS)
    # make the corrected names resolvable in the fixture's name map
    owid = OWID + "Cote d'Ivoire,CIV,2000,55.0\nVietnam,VNM,2000,70.0\nVenezuela,VEN,2000,72.0\n"
    ref = read_csv_any_encoding(spark, write(tmp_path / "owid2.csv", owid)).withColumn("__row", F.monotonically_increasing_id())
    nm = build_name_map(ref, "Entity", "Code", "__row", "OWID_")
    spec = replace(LE.SOURCES[2], path=path)
    got = rows(clean_source(spark, spec, nm, rules), "iso3", "year", "life_exp_kaggle")
    # padded header found, Latin-1 decoded, tab-padded name stripped, typo corrected,
    # unmapped name dropped, null metric kept, repeated key kept (not de-duplicated)
    assert sorted(got, key=str) == sorted([("AAA", 1999, None), ("AAA", 1999, 65.0), ("CIV", 2000, 50.0),
                                           ("VEN", 2002, 72.0), ("VNM", 2001, 70.0)], key=str)


UNICEF = ("﻿REF_AREA,Geographic area,SEX,TIME_PERIOD,OBS_VALUE\n"
          "AAA,Alpha,_T,2000,60\n"
          "AAA,Alpha,_T,2000,62\n"
          "AAA,Alpha,M,2000,58\n"
          "BBB,Beta,_T,2001,n/a\n"
          "BBB,Beta,F,2001,70\n")


def test_unicef_cleaner_bom_and_mean(spark, tmp_path):
    spec = replace(LE.SOURCES[3], path=write(tmp_path / "unicef.csv", UNICEF))
    got = rows(clean_source(spark, spec), "iso3", "year", "life_exp_unicef")
    assert got == [("AAA", 2000, 61.0)]


WHO_TOTAL = ("GEO_NAME_SHORT,DIM_GEO_CODE_TYPE,DIM_SEX,DIM_TIME,AMOUNT_N\n"
             "Alpha,COUNTRY,TOTAL,2000,55.0\n"
             "Alpha,COUNTRY,BTSX,2000,54.0\n"
             "Alpha,COUNTRY,TOTAL,2000,53.0\n"
             "Alpha,REGION,TOTAL,2001,50.0\n"
             "Beta,COUNTRY,TOTAL,2001,bad\n"
             "Atlantis,COUNTRY,TOTAL,2001,40.0\n")


def test_who_cleaner_cascade_and_keep_first(spark, tmp_path):
    nm = name_map(spark, tmp_path)
    spec = replace(LE.SOURCES[4], path=write(tmp_path / "who.csv", WHO_TOTAL))
    got = rows(clean_source(spark, spec, nm, LE.CORRECTIONS), "iso3", "year", "hale_who")
    assert got == [("AAA", 2000, 55.0)]      # TOTAL wins, first row kept, region / unmapped / bad dropped
    btsx = WHO_TOTAL.replace(",TOTAL,", ",MALE,").replace(",BTSX,", ",BTSX,")
    spec2 = replace(spec, path=write(tmp_path / "who2.csv", btsx))
    assert rows(clean_source(spark, spec2, nm, LE.CORRECTIONS), "hale_who") == [(54.0,)]
    neither = WHO_TOTAL.replace(",TOTAL,", ",MALE,").replace(",BTSX,", ",FEMALE,")
    spec3 = replace(spec, path=write(tmp_path / "who3.csv", neither))
    assert rows(clean_source(spark, spec3, nm, LE.CORRECTIONS), "hale_who") == [(55.0,)]


CDC = ("United States life expectancy,,\n"
       "Year,Years,note\n"
       "1890,40.0,\n"
       "1980,73.7,\n"
       "1980,99.0,\n"
       "2019,78.8,\n"
       "Footnote: provisional,,\n")


def test_cdc_positional(spark, tmp_path):
    spec = replace(LE.SOURCES[5], path=write(tmp_path / "cdc.csv", CDC))
    got = rows(clean_source(spark, spec), "iso3", "year", "life_exp_us_cdc")
    assert got == [("USA", 1980, 73.7), ("USA", 2019, 78.8)]


def test_missing_and_empty_sources(spark, tmp_path):
    """Only an optional source may be missing; a header alone is a source without rows."""
    missing = replace(LE.SOURCES[1], path=str(tmp_path / "absent.csv"))
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        clean_source(spark, missing)
    assert clean_source(spark, replace(missing, optional=True)) is None
    cdc = LE.SOURCES[5]
    assert cdc.optional and clean_source(spark, replace(cdc, path=str(tmp_path / "absent.csv"))) is None
    empty = replace(LE.SOURCES[1], path=write(tmp_path / "empty.csv", "iso3,country_name,year,life_exp_wb\n"))
    assert clean_source(spark, empty).count() == 0
    with pytest.raises(ValueError, match="Missing expected columns"):
        clean_source(spark, replace(empty, path=write(tmp_path / "other.csv", "iso3,year\nAAA,2000\n")))


def test_quoted_line_breaks_and_quotes(spark, tmp_path):
    path = write(tmp_path / "q.csv", 'Entity,Code\n"Foo\nBar",AAA\n"A ""b"" c",BBB\n')
    assert [tuple(r) for r in read_csv_any_encoding(spark, path).collect()] == [("Foo\nBar", "AAA"), ('A "b" c', "BBB")]


def test_headers_in_another_order(spark, tmp_path):
    d = tmp_path / "orders"
    d.mkdir()
    write(d / "a.csv", "Entity,Code\nAlpha,AAA\n")
    write(d / "b.csv", "Code,Entity\nBBB,Beta\n")
    write(d / "c.csv", "Code,Entity,More\nCCC,C\u00f4te,x\n", encoding="latin-1")
    got = sorted((r.Entity, r.Code, r.More) for r in read_csv_any_encoding(spark, str(d)).collect())
    assert got == [("Alpha", "AAA", None), ("Beta", "BBB", None), ("C\u00f4te", "CCC", "x")]


def test_first_is_first_in_file_order(spark, tmp_path):
    d = tmp_path / "files"
    d.mkdir()
    write(d / "a.csv", "Entity,Code\nX,AAA\n")
    write(d / "b.csv", "Entity,Code\n" + "X,BBB\n" * 5000)  # the larger file is packed first
    ref = read_csv_any_encoding(spark, str(d), order_col="__row")
    assert [tuple(r) for r in build_name_map(ref, "Entity", "Code", "__row").collect()] == [("X", "AAA")]


def test_positional_skip(spark, tmp_path):
    sheet = "2000,22.2,\n2001,33.3,\n2000,77.0,\n2001,78.0,\n"
    spec = replace(LE.SOURCES[5], path=write(tmp_path / "s.csv", sheet))
    assert rows(clean_source(spark, spec), "year", "life_exp_us_cdc") == [(2000, 77.0), (2001, 78.0)]
    short = replace(spec, path=write(tmp_path / "t.csv", "2000,22.2,\n"))
    assert clean_source(spark, short).count() == 0


def test_na_tokens(spark, tmp_path):
    text = "name,value\nNA,1\nN/A,NA\nnull,nan\nnan,\n,N/A\nok,2.5\n"
    df = read_csv_any_encoding(spark, write(tmp_path / "na.csv", text))
    df = clean.coerce_numeric(df, "value")
    got = [(r["name"], r["value"]) for r in df.collect()]
    assert got == [(None, 1.0), (None, None), (None, None), (None, None), (None, None), ("ok", 2.5)]


def test_require_columns_and_strip_headers(spark):
    df = spark.createDataFrame([(1, 2)], "` a ` int, b int")
    df = clean.strip_headers(df)
    assert df.columns == ["a", "b"]
    clean.require_columns(df, ["a", "b"])
    with pytest.raises(ValueError, match=r"\['c', 'd'\]"):
        clean.require_columns(df, ["a", "d", "c"])


def test_sinks_roundtrip_keep_nulls(spark, tmp_path):
    df = spark.createDataFrame([("BBB", 2001, None), ("AAA", 2000, 1.5)], "iso3 string, year int, v double")
    for fmt in ("csv", "parquet", "json"):
        out = str(tmp_path / f"panel_{fmt}")
        write_panel(df, out, fmt, keys=["iso3", "year"])
        if fmt == "json":
            lines = [l for f in sorted(os.listdir(out)) if f.startswith("part-")
                     for l in open(os.path.join(out, f)).read().splitlines()]
            assert lines[0].startswith('{"iso3":"AAA"') and '"v":null' in lines[1]
        back = getattr(spark.read.option("header", True), fmt)(out)
        assert back.count() == 2


def test_pipeline_end_to_end(spark, tmp_path, monkeypatch):
    raw = tmp_path / "raw"
    raw.mkdir()
    write(raw / "owid_historical_life_expectancy.csv", OWID)
    write(raw / "worldbank_life_expectancy.csv", WB_CSV)
    write(raw / "kaggle_health_factors.csv", KAGGLE, encoding="latin-1")
    write(raw / "unicef_life_expectancy.csv", UNICEF)
    write(raw / "who_healthy_life_expectancy.csv", WHO_TOTAL)
    write(raw / "cdc_us_demographics.csv", CDC)

    class Cfg:
        pass
    cfg = Cfg()
    for k in ("CORRECTIONS", "OVERRIDES", "AGGREGATE_PREFIX", "PERIOD_RANGE", "METRICS"):
        setattr(cfg, k, getattr(LE, k))
    cfg.REFERENCE = replace(LE.REFERENCE, path=str(raw / "owid_historical_life_expectancy.csv"))
    cfg.SOURCES = [replace(s, path=str(raw / os.path.basename(s.path))) for s in LE.SOURCES]
    for on_dup in ("multiply", "error"):
        cfg.ON_DUPLICATE = on_dup if on_dup == "multiply" else "mean"
        panel = run_pipeline(spark, cfg)
        assert panel.columns == ["iso3", "country_name", "year"] + LE.METRICS
        got = {(r.iso3, r.year): r for r in panel.collect()}
        # ARB has no canonical name: dropped; USA has none either in this fixture
        assert ("ARB", 2000) not in got and all(k[0] != "USA" for k in got)
        assert got[("AAA", 2000)].life_exp_unicef == 61.0 and got[("AAA", 2000)].hale_who == 55.0
        assert got[("AAA", 1950)].life_exp_owid == 41.5 and got[("AAA", 1950)].life_exp_wb == 41.0
        assert got[("AAA", 1950)].country_name == "Alpha"


def test_pipeline_leaves_out_what_is_not_there(spark, tmp_path):
    """A missing optional source and a source without rows are no columns; one merge exchange."""
    raw = tmp_path / "raw"
    raw.mkdir()
    write(raw / "owid_historical_life_expectancy.csv", OWID)
    write(raw / "worldbank_life_expectancy.csv", "iso3,country_name,year,life_exp_wb\n")
    write(raw / "kaggle_health_factors.csv", KAGGLE, encoding="latin-1")
    write(raw / "unicef_life_expectancy.csv", UNICEF)
    write(raw / "who_healthy_life_expectancy.csv", WHO_TOTAL)
    panel = run_pipeline(spark, LE.with_raw_dir(str(raw)))
    assert not {"life_exp_wb", "life_exp_us_cdc"} & set(panel.columns)
    plan = panel._jdf.queryExecution().optimizedPlan().toString()
    assert LE.ON_DUPLICATE == "mean" and "FullOuter" not in plan
    (raw / "unicef_life_expectancy.csv").unlink()
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        run_pipeline(spark, LE.with_raw_dir(str(raw)))


def test_worldbank_from_payload_spec(spark, tmp_path):
    payload = [{"page": 1}, [
        {"countryiso3code": "AAA", "country": {"value": "Alpha"}, "date": "1950", "value": 41.0},
        {"countryiso3code": "", "country": {"value": "Nowhere"}, "date": "2000", "value": 50.0},
        {"countryiso3code": "BBB", "country": {"value": "Beta"}, "date": "2030", "value": 80.0}]]
    spec = replace(LE.SOURCES[1], path=write(tmp_path / "wb.json", json.dumps(payload)), fmt="json-payload",
                   raw_code="iso3", raw_period="year", raw_metric="life_exp_wb")
    assert rows(clean_source(spark, spec), "iso3", "year", "life_exp_wb") == [("AAA", 1950, 41.0)]


def test_corrections_idempotent_when_no_canonical_is_a_variant(spark):
    from panelmerge.operators.entities import apply_corrections
    rules = {k: v for k, v in LE.CORRECTIONS.items() if v not in LE.CORRECTIONS}
    df = spark.createDataFrame([(k,) for k in list(LE.CORRECTIONS) + ["Chad"]], "n string")
    once = apply_corrections(df, "n", rules)
    twice = apply_corrections(once, "n", rules)
    assert sorted(r.n for r in once.collect()) == sorted(r.n for r in twice.collect())


def test_profile_files_reports_columns_keys_and_errors(spark, tmp_path):
    from panelmerge.plans.reports import profile_files
    owid = write(tmp_path / "owid.csv", OWID)
    kag = write(tmp_path / "kaggle.csv", KAGGLE, encoding="latin-1")
    cols, keys = profile_files(spark, [owid, kag, str(tmp_path / "absent.csv")])
    got = {(r.file, r.column): r for r in cols.collect()}
    assert got[("owid.csv", "Entity")].sample == "Alpha" and got[("owid.csv", "Code")].non_null_pct < 100
    assert got[("kaggle.csv", "Country")].sample == "Côte d'Ivoire"
    assert got[("absent.csv", None)].load_error == "File not found"
    roles = {(r.table_name, r.column_name, r.role) for r in keys.collect()}
    assert ("owid.csv", "Entity", "entity") in roles and ("owid.csv", "Year", "period") in roles
    assert ("kaggle.csv", "Country", "entity") in roles
    assert got[("owid.csv", "Year")].dtype == "bigint" and got[("owid.csv", "Life expectancy")].dtype == "double"
    assert got[("owid.csv", "Entity")].dtype == "string"


def test_mixed_encodings_in_one_folder(spark, tmp_path):
    d = tmp_path / "mixed"
    d.mkdir()
    write(d / "a.csv", "Country,Year\nCôte d'Ivoire,2000\n", encoding="utf-8")
    write(d / "b.csv", "Country,Year\nCôte d'Ivoire,2001\n", encoding="latin-1")
    got = sorted((r.Country, r.Year) for r in read_csv_any_encoding(spark, str(d)).collect())
    assert got == [("Côte d'Ivoire", "2000"), ("Côte d'Ivoire", "2001")]


def test_source_lineage_counts_each_step(spark, tmp_path):
    from panelmerge.plans.pipeline import source_lineage
    out = source_lineage(spark, owid_spec(tmp_path))
    got = [(r.step, r.rows, r.removed) for r in out.orderBy("ordinal").collect()]
    assert got == [("input", 11, 0), ("code_present", 10, 1), ("not_aggregate", 9, 1), ("in_period", 6, 3)]
    assert got[-1][1] == clean_source(spark, owid_spec(tmp_path)).count()
