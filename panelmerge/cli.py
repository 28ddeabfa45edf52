"""Command line for the life-expectancy configuration.

    python -m panelmerge.cli transform --raw data/raw --out data/processed/panel --format csv
    python -m panelmerge.cli report dq --panel data/processed/panel --out reports/
    python -m panelmerge.cli profile --raw data/raw --out reports/
    python -m panelmerge.cli export --panel data/processed/panel --out panel.parquet --format parquet

Every report is a DataFrame; with ``--out`` each one is written as CSV
(one folder per report), otherwise it is shown (small report tables only).
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelmerge.configs import life_expectancy as LE
from panelmerge.operators import clean, rank, stats
from panelmerge.plans import charts, reports
from panelmerge.plans.pipeline import run_pipeline
from panelmerge.session import get_session
from panelmerge.sources.readers import files_under
from panelmerge.sources.sinks import write_panel

KEYS = ["iso3", "year"]
REPORTS = ("audit", "dq", "conflicts", "anomalies", "value", "eda", "summary", "lineage")


def read_panel(spark: SparkSession, path: str) -> DataFrame:
    """A stored panel (parquet folder, or CSV with header as written by ``transform``)."""
    if not files_under(spark, path, "*.parquet").isEmpty():
        return spark.read.parquet(path)
    schema = "iso3 string, country_name string, year int, " + ", ".join(f"{m} double" for m in LE.METRICS)
    return spark.read.option("header", True).schema(schema).csv(path)


def report_tables(name: str, panel: DataFrame, spark: SparkSession, raw_dir: str | None = None) -> dict:
    p = clean.period_filter(panel, "year", *LE.PERIOD_RANGE)
    metrics = [m for m in LE.METRICS if m in p.columns]
    lower, upper = LE.RULE
    if name == "audit":
        return {"columns": reports.audit_columns(panel), "coverage": stats.source_coverage(panel, metrics),
                "keys": reports.audit_keys(panel, *KEYS)}
    if name == "dq":
        card = reports.dq_scorecard(p, KEYS, metrics, bounds=LE.BOUNDS, period_range=LE.PERIOD_RANGE,
                                    pairs=LE.PAIRS, rule=LE.RULE)
        return {"completeness": stats.column_fill(p, ["iso3", "country_name", "year"] + metrics),
                "uniqueness": stats.key_facts(p, KEYS), "grid": stats.grid_density(p, *KEYS),
                "validity": stats.bounds_check(p, metrics, *LE.BOUNDS, period="year",
                                               period_lo=LE.PERIOD_RANGE[0], period_hi=LE.PERIOD_RANGE[1]),
                "accuracy": stats.pair_agreement(p, LE.PAIRS),
                "worst_pairs": _worst(p, LE.PAIRS[0]),
                "consistency": reports.rule_consistency(p, lower, upper),
                "gap_stats": stats.gap_stats(p, upper, lower),
                "top_mean_gap": reports.top_mean_gap(p, "iso3", upper, lower, k=10),
                "scorecard": card, "grade": reports.dq_grade(card)}
    if name == "conflicts":
        return {"le_conflicts": reports.le_conflicts(panel, LE.LE_SOURCES, LE.TOLERANCE),
                "top_conflicts": reports.top_conflicts(panel, KEYS, LE.LE_SOURCES, LE.TOLERANCE, extra=["country_name"]),
                "hale_consistency": reports.rule_consistency(panel, lower, upper),
                "hale_violations": reports.rule_violations(panel, KEYS, lower, upper, extra=["country_name"])}
    if name == "anomalies":
        return {"violations": reports.gap_violations(p, KEYS, upper, lower, extra=["country_name"]),
                "violation_summary": reports.violation_summary(p, "iso3", "year", upper, lower),
                "divergence": stats.divergence_stats(p, "life_exp_wb", "life_exp_unicef"),
                "top_divergence": _worst(p, ("life_exp_wb", "life_exp_unicef", ""), k=10),
                "extreme_by_entity": stats.extreme_by_entity(p, "life_exp_wb", "life_exp_unicef", "iso3", 10.0),
                "extreme_lows": stats.below_any(p, {"life_exp_wb": 13, "life_exp_owid": 13},
                                                ["iso3", "country_name", "year"]).orderBy(*KEYS)}
    if name == "eda":
        return {"health_gap": charts.health_gap_ranking(panel, ["iso3"], "year", upper, lower, 2019, k=15,
                                                        extra=["country_name", "year"]),
                "conflict_matrix": charts.conflict_matrix(panel, ["iso3"], "year", "life_exp_wb", "life_exp_owid",
                                                          extra="life_exp_kaggle", label="country_name"),
                "coverage_ranking": charts.coverage_ranking(panel, metrics, LE.LABELS),
                "presence_by_year": charts.presence_by_period(p, "year", metrics),
                "rank_ticks": rank.rank_ticks(p, "year"),
                "decades": stats.decade_distribution(p, "year", "life_exp_wb")}
    if name == "value":
        if not raw_dir:
            raise SystemExit("report value needs --raw (the raw sources are profiled)")
        raw = reports.source_profile(spark, _raw_sources(spark, raw_dir), LE.BOUNDS)
        final = reports.final_profile(p, "iso3", "year", "country_name", metrics, LE.BOUNDS)
        ba = reports.before_after(raw, final)
        return {"raw_profiles": raw, "final_profile": final, "before_after": ba,
                "scorecard": reports.value_scorecard(ba)}
    if name == "lineage":
        if not raw_dir:
            raise SystemExit("report lineage needs --raw")
        from panelmerge.operators.entities import build_name_map
        from panelmerge.plans.pipeline import load_source, source_lineage
        cfg = LE.with_raw_dir(raw_dir)
        nm = build_name_map(load_source(spark, cfg.REFERENCE), cfg.REFERENCE.raw_name, cfg.REFERENCE.raw_code, "__row", cfg.AGGREGATE_PREFIX)
        found = {s.label.replace(" ", "_").replace("(", "").replace(")", ""):
                 source_lineage(spark, s, nm, cfg.CORRECTIONS, cfg.PERIOD_RANGE) for s in cfg.SOURCES}
        return {label: df for label, df in found.items() if df is not None}
    if name == "summary":
        return {"extent": stats.panel_extent(panel, *KEYS), "coverage": stats.column_fill(panel, metrics)}
    raise SystemExit(f"unknown report {name}; choose from {REPORTS}")


def _worst(p: DataFrame, pair, k: int = 5) -> DataFrame:
    a, b, _ = pair
    d = p.na.drop(subset=[a, b]).withColumn("abs_diff", F.abs(F.col(a) - F.col(b)))
    return rank.top_k(d.select(*KEYS, "country_name", a, b, "abs_diff"), "abs_diff", k, KEYS)


def _raw_sources(spark: SparkSession, raw_dir: str) -> list[dict]:
    from panelmerge.sources.positional import read_positional
    from panelmerge.sources.readers import read_csv_any_encoding
    cfg = LE.with_raw_dir(raw_dir)
    out = []
    for s in cfg.SOURCES:
        load = (lambda s=s: read_positional(spark, s.path).drop("__row")) if s.fmt == "positional" else \
            (lambda s=s: read_csv_any_encoding(spark, s.path, s.encoding))
        out.append({"label": s.label, "load": load, "metric": s.raw_metric, "code": s.raw_code,
                    "name": s.raw_name, "period": s.raw_period})
    return out


def _emit(tables: dict, out: str | None) -> None:
    for key, df in tables.items():
        if out:
            df.write.mode("overwrite").option("header", True).csv(os.path.join(out, key))
        else:
            print(f"== {key}")
            print("\t".join(df.columns))
            for row in df.toLocalIterator():   # all rows, one partition at a time
                print("\t".join("" if v is None else str(v) for v in row))


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="panelmerge")
    sub = ap.add_subparsers(dest="cmd", required=True)
    t = sub.add_parser("transform")
    t.add_argument("--raw", required=True)
    t.add_argument("--out", required=True)
    t.add_argument("--format", default="csv", choices=["csv", "parquet", "json"])
    r = sub.add_parser("report")
    r.add_argument("name", choices=REPORTS)
    r.add_argument("--panel", required=True)
    r.add_argument("--raw")
    r.add_argument("--out")
    pr = sub.add_parser("profile")
    pr.add_argument("--raw", required=True)
    pr.add_argument("--out")
    e = sub.add_parser("export")
    e.add_argument("--panel", required=True)
    e.add_argument("--out", required=True)
    e.add_argument("--format", default="parquet", choices=["csv", "parquet", "json"])
    args = ap.parse_args(argv)

    spark = get_session()
    if args.cmd == "transform":
        panel = run_pipeline(spark, LE.with_raw_dir(args.raw))
        write_panel(panel, args.out, args.format, keys=KEYS)
    elif args.cmd == "report":
        _emit(report_tables(args.name, read_panel(spark, args.panel), spark, args.raw), args.out)
    elif args.cmd == "profile":
        paths = sorted(r["path"] for r in files_under(spark, args.raw, "*.csv").collect())   # one row per file
        cols, keys = reports.profile_files(spark, paths)
        _emit({"columns": cols, "merge_keys": keys}, args.out)
    elif args.cmd == "export":
        write_panel(read_panel(spark, args.panel), args.out, args.format, keys=KEYS)


if __name__ == "__main__":
    main()
