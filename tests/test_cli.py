"""The command line on the fixture sources: transform, every report, profile, export."""

import os

from conftest import write
from test_sources import CDC, KAGGLE, OWID, UNICEF, WB_CSV, WHO_TOTAL

from panelmerge import cli


def test_cli_end_to_end(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    write(raw / "owid_historical_life_expectancy.csv", OWID)
    write(raw / "worldbank_life_expectancy.csv", WB_CSV)
    write(raw / "kaggle_health_factors.csv", KAGGLE, encoding="latin-1")
    write(raw / "unicef_life_expectancy.csv", UNICEF)
    write(raw / "who_healthy_life_expectancy.csv", WHO_TOTAL)
    write(raw / "cdc_us_demographics.csv", CDC)
    panel = str(tmp_path / "panel")
    cli.main(["transform", "--raw", str(raw), "--out", panel, "--format", "csv"])
    stored = cli.read_panel(spark, panel)
    assert stored.columns[:3] == ["iso3", "country_name", "year"] and stored.count() > 0
    out = str(tmp_path / "reports")
    for name in cli.REPORTS:
        args = ["report", name, "--panel", panel, "--out", os.path.join(out, name)]
        cli.main(args + (["--raw", str(raw)] if name in ("value", "lineage") else []))
    grade = spark.read.option("header", True).csv(os.path.join(out, "dq", "grade")).first()
    assert grade.grade in {"A", "B", "C", "D"}
    value = spark.read.option("header", True).csv(os.path.join(out, "value", "raw_profiles"))
    assert value.count() == 6
    lin = spark.read.option("header", True).csv(os.path.join(out, "lineage", "OWID"))
    assert lin.count() == 4
    cli.main(["profile", "--raw", str(raw), "--out", os.path.join(out, "profile")])
    cli.main(["export", "--panel", panel, "--out", str(tmp_path / "panel.parquet"), "--format", "parquet"])
    assert spark.read.parquet(str(tmp_path / "panel.parquet")).count() == stored.count()
