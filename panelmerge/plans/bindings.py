"""Bindings of every operator to the driver's test tables.

Panels built from the tables:

* EV  - events: per event type, the mean value per (user_id, day of month);
        five sources merged on (user_id, day). Stands for the six-source panel.
* RV  - orders.o_totalprice (total) merged with the net lineitem revenue per
        order (net); the rule net <= total plays "healthy <= total".
* RVY - RV with the order year and the customer's nation.
* LI  - lineitem on the non-unique key (l_orderkey, l_linenumber).
* NM  - part names as entity names, brands as codes (``Brand#1*`` plays the
        aggregate prefix), literal correction and override rules.
* LB  - documents left-joined with labels.

Every function takes ``(spark, sf_dir)`` and returns a DataFrame whose
double columns are rounded to 6 places (the oracle rounds the same way).
"""

from __future__ import annotations

import uuid
from dataclasses import replace
from types import SimpleNamespace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from panelmerge.configs import life_expectancy as LE
from panelmerge.functions.sqltext import q as _q
from panelmerge.operators import clean, entities, merge, rank, release, stats
from panelmerge.operators.asof import asof_join, carry_last
from panelmerge.operators.interval import interval_join
from panelmerge.operators.sketches import refresh_sketches, stored_sketches, united_report
from panelmerge.plans import charts, pipeline, reports
from panelmerge.plans.observed import store_facts
from panelmerge.session import ensure_checkpoint_dir
from panelmerge.sources.payload import explode_records, flatten_payload, flatten_records, inferred_schema
from panelmerge.sources.positional import clean_positional
from panelmerge.sources.sinks import key_sizes, store_panel, stored_panel, write_panel
from panelmerge.sources.split_csv import read_csv_split
from panelmerge.spec import SourceSpec
from panelmerge.streaming import read_source_stream
from panelmerge.streaming.revisions import START, append_final, final_revisions

# The EV panel configuration.
EV_TYPES = ("click", "view", "purchase", "signup", "error")
EV_METRICS = tuple(f"m_{t}" for t in EV_TYPES)
EV_KEYS = ("user_id", "day")
EV_LABELS = {"m_click": "Clicks", "m_view": "Views", "m_purchase": "Purchases",
             "m_signup": "Signups", "m_error": "Errors"}
EV_BOUNDS = (1.0, 300.0)
EV_PERIOD_RANGE = (1, 28)
EV_PAIRS = (("m_click", "m_view", "click vs view"),
            ("m_click", "m_purchase", "click vs purchase"),
            ("m_click", "m_signup", "click vs signup"))
EV_CONFLICT_SOURCES = ("m_click", "m_view", "m_purchase", "m_signup")
EV_TOLERANCE = 50.0
EV_RULE = ("m_error", "m_click")          # m_error <= m_click where both present
EV_LOW = 1.0
EV_EXTREME = 100.0
EV_MIN_ENTITIES = 100

# NM rules (variant -> canonical; code -> label).
NM_CORRECTIONS = {
    "red widget": "red gizmo",
    "blue bolt": "blue gear",
    "hot gear": "warm gear",
    "violet cog": "old rod",
}
NM_AGGREGATE_PREFIX = "Brand#1"
NM_OVERRIDES = {"Brand#2": "Brand Two", "Brand#7": "Brand Seven", "Brand#99": "Brand Ninety-Nine"}
NM_SIZE_RANGE = (10, 40)
NM_SILENT = ("Brand#2", "Brand#3")

# The period range of the cleaners on part (1950 + size).
CLEAN_PERIOD = (1955, 1990)

# Payload fixture (regions whose records get an empty code / a null value).
PAYLOAD_EMPTY_CODE_REGION = 4
PAYLOAD_NULL_VALUE_REGION = 3

# RV / RVY parameters.
RV_WANT_YEAR = 1998
RV_MISSING_YEAR = 2019
RV_PERIOD_RANGE = (1996, 2000)

# What the second release corrects and withdraws.
RELEASE_USER, RELEASE_DAY = 7, 28


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Round every double column (both engines round the same way)."""
    cols = [f"round({_q(f.name)}, {places}) AS {_q(f.name)}" if isinstance(f.dataType, DoubleType) else _q(f.name)
            for f in df.schema.fields]
    return df.selectExpr(*cols)



# ------------------------------------------------------------------ EV panel

def ev_long(spark, sf_dir) -> DataFrame:
    e = _t(spark, sf_dir, "events")
    return e.select("user_id", F.dayofmonth("ts").alias("day"), "event_type", "value")


def ev_panel(spark, sf_dir) -> DataFrame:
    """One scan, one shuffle: conditional means per (user_id, day)."""
    return merge.long_to_panel(ev_long(spark, sf_dir), list(EV_KEYS), "event_type", "value",
                               {t: f"m_{t}" for t in EV_TYPES}, how="mean")


def ev_sources(spark, sf_dir, dedup: bool = False, with_name: bool = False) -> list[DataFrame]:
    """The five per-type sources (raw rows, or key-unique group means)."""
    lng = ev_long(spark, sf_dir)
    out = []
    for t in EV_TYPES:
        s = lng.filter(F.col("event_type") == t).select(*EV_KEYS, F.col("value").alias(f"m_{t}"))
        if dedup:
            s = clean.dedup_mean(s, list(EV_KEYS), f"m_{t}")
        if with_name:
            s = s.withColumn("name", F.concat(F.lit(t + ":"), F.col("user_id").cast("string")))
        out.append(s)
    return out


def q_panel_merge_union(spark, sf_dir):
    srcs = ev_sources(spark, sf_dir)
    return merge.merge_panel(srcs, list(EV_KEYS), strategy="union", on_duplicate="mean")


def q_panel_merge_join(spark, sf_dir):
    srcs = ev_sources(spark, sf_dir, dedup=True)
    return merge.merge_panel(srcs, list(EV_KEYS), strategy="join")


def q_merge_collision(spark, sf_dir):
    """One groupBy takes the means and the first name: the sources aren't reduced one by one before."""
    srcs = ev_sources(spark, sf_dir, with_name=True)
    p = merge.merge_panel(srcs, list(EV_KEYS), name_col="name", strategy="union", on_duplicate="mean")
    return p.select(*EV_KEYS, "name")


def q_source_coverage(spark, sf_dir):
    return stats.source_coverage(ev_panel(spark, sf_dir), EV_METRICS)


def q_column_fill(spark, sf_dir):
    return stats.column_fill(ev_panel(spark, sf_dir), list(EV_KEYS) + list(EV_METRICS))


def q_overall_fill(spark, sf_dir):
    return stats.overall_fill(ev_panel(spark, sf_dir), EV_METRICS)


def q_panel_extent(spark, sf_dir):
    return stats.panel_extent(ev_panel(spark, sf_dir), *EV_KEYS)


def q_grid_density(spark, sf_dir):
    return stats.grid_density(ev_panel(spark, sf_dir), *EV_KEYS)


def q_bounds_check(spark, sf_dir):
    return stats.bounds_check(ev_panel(spark, sf_dir), EV_METRICS, *EV_BOUNDS,
                              period="day", period_lo=EV_PERIOD_RANGE[0], period_hi=EV_PERIOD_RANGE[1])


def q_pair_agreement(spark, sf_dir):
    return stats.pair_agreement(ev_panel(spark, sf_dir), EV_PAIRS)


def q_le_conflicts(spark, sf_dir):
    return reports.le_conflicts(ev_panel(spark, sf_dir), EV_CONFLICT_SOURCES, EV_TOLERANCE)


def q_top_conflicts(spark, sf_dir):
    return reports.top_conflicts(ev_panel(spark, sf_dir), list(EV_KEYS), EV_CONFLICT_SOURCES, EV_TOLERANCE, k=5)


def _ev_scorecard(spark, sf_dir):
    return reports.dq_scorecard(ev_panel(spark, sf_dir), list(EV_KEYS), EV_METRICS, bounds=EV_BOUNDS,
                                period_range=EV_PERIOD_RANGE, pairs=EV_PAIRS, rule=EV_RULE)


def q_dq_scorecard(spark, sf_dir):
    return _ev_scorecard(spark, sf_dir)


def q_dq_grade(spark, sf_dir):
    return reports.dq_grade(_ev_scorecard(spark, sf_dir))


def q_audit_columns(spark, sf_dir):
    return reports.audit_columns(ev_panel(spark, sf_dir))


def q_audit_keys(spark, sf_dir):
    return reports.audit_keys(ev_panel(spark, sf_dir), *EV_KEYS)


def q_final_profile(spark, sf_dir):
    return reports.final_profile(ev_panel(spark, sf_dir), "user_id", "day", None, EV_METRICS, EV_BOUNDS)


def q_coverage_ranking(spark, sf_dir):
    return charts.coverage_ranking(ev_panel(spark, sf_dir), EV_METRICS, EV_LABELS)


def q_presence_matrix(spark, sf_dir):
    return charts.presence_matrix(ev_panel(spark, sf_dir), list(EV_KEYS), "day", EV_METRICS)


def q_presence_by_period(spark, sf_dir):
    return charts.presence_by_period(ev_panel(spark, sf_dir), "day", EV_METRICS)


def q_rank_ticks(spark, sf_dir):
    return rank.rank_ticks(ev_panel(spark, sf_dir), "day", k=6)


def q_extreme_lows(spark, sf_dir):
    p = ev_panel(spark, sf_dir)
    return stats.below_any(p, {"m_click": EV_LOW, "m_view": EV_LOW}, EV_KEYS).orderBy(*EV_KEYS)


def q_divergence_stats(spark, sf_dir):
    return stats.divergence_stats(ev_panel(spark, sf_dir), "m_click", "m_purchase", under=1.0)


def q_extreme_by_entity(spark, sf_dir):
    return stats.extreme_by_entity(ev_panel(spark, sf_dir), "m_click", "m_purchase", "user_id", EV_EXTREME)


def q_top_divergence(spark, sf_dir):
    p = ev_panel(spark, sf_dir).withColumn("abs_diff", F.abs(F.col("m_click") - F.col("m_view")))
    return rank.top_k(p.select(*EV_KEYS, "m_click", "m_view", "abs_diff"), "abs_diff", 5, list(EV_KEYS))


def q_conflict_matrix(spark, sf_dir):
    return charts.conflict_matrix(ev_panel(spark, sf_dir), ["user_id"], "day", "m_click", "m_view",
                                  extra="m_purchase", k=20, min_extra=10)


def ev_canonical_ref(spark, sf_dir) -> DataFrame:
    c = _t(spark, sf_dir, "customer")
    return c.filter(F.col("c_mktsegment") != "HOUSEHOLD").select(
        F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"))


def q_panel_assembly(spark, sf_dir):
    """Clean (period filter) -> merge -> canonical labels -> drop unlabelled.

    The five sources are slices of one table, so they are cleaned and merged
    in one scan (``long_to_panel``); the assembled panel is already
    partitioned by its keys, so assembly adds no shuffle.
    """
    from panelmerge.plans.pipeline import assemble_panel
    lng = clean.period_filter(ev_long(spark, sf_dir), "day", *EV_PERIOD_RANGE)
    merged = merge.long_to_panel(lng, list(EV_KEYS), "event_type", "value", {t: f"m_{t}" for t in EV_TYPES})
    ref = ev_canonical_ref(spark, sf_dir)
    cmap = entities.canonical_map(ref, "user_id", "name", "user_id")
    return assemble_panel([merged], list(EV_KEYS), "name", cmap, overrides={}, on_duplicate="error")


def _ev_raw_profiles(spark, sf_dir):
    """The five event-type sources are slices of one table: one grouped profile."""
    e = _t(spark, sf_dir, "events").select("event_type", "event_id", "user_id",
                                           F.dayofmonth("ts").alias("day"), "value")
    return reports.source_profile_grouped(e, "event_type", EV_TYPES, EV_BOUNDS, code="user_id",
                                          metric="value", period="day")


def _ev_before_after(spark, sf_dir):
    raw = _ev_raw_profiles(spark, sf_dir)
    fin = reports.final_profile(ev_panel(spark, sf_dir), "user_id", "day", None, EV_METRICS, EV_BOUNDS)
    return reports.before_after(raw, fin)


def q_before_after(spark, sf_dir):
    return _ev_before_after(spark, sf_dir)


def q_value_scorecard(spark, sf_dir):
    return reports.value_scorecard(_ev_before_after(spark, sf_dir), min_entities=EV_MIN_ENTITIES)


# ------------------------------------------------------------------ RV / RVY

def rv_panel(spark, sf_dir, with_nation: bool = False) -> DataFrame:
    o = _t(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.year("o_orderdate").alias("year"), F.col("o_totalprice").alias("total"))
    # line items enter at their own grain; the merge sums them per order in the
    # same partial aggregation and shuffle that merges them with the orders
    lines = _t(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"))
    p = merge.merge_panel([o, lines], ["o_orderkey"], strategy="union", metric_aggs={"net": "sum"})
    if with_nation:
        c = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nation"))
        p = p.join(c, "o_custkey", "left")
    return p


def q_hale_consistency(spark, sf_dir):
    return reports.rule_consistency(rv_panel(spark, sf_dir), "net", "total")


def q_hale_violations(spark, sf_dir):
    return reports.rule_violations(rv_panel(spark, sf_dir), ["o_orderkey"], "net", "total", k=5)


def q_gap_stats(spark, sf_dir):
    return stats.gap_stats(rv_panel(spark, sf_dir), "total", "net")


def q_health_gap_rows(spark, sf_dir):
    return stats.gap_rows(rv_panel(spark, sf_dir), "total", "net", ["o_orderkey"])


def q_gap_violations(spark, sf_dir):
    return reports.gap_violations(rv_panel(spark, sf_dir), ["o_orderkey"], "total", "net")


def q_violation_summary(spark, sf_dir):
    return reports.violation_summary(rv_panel(spark, sf_dir), "o_custkey", "year", "total", "net")


def q_health_gap_ranking(spark, sf_dir):
    return charts.health_gap_ranking(rv_panel(spark, sf_dir), ["o_orderkey"], "year", "total", "net",
                                     RV_WANT_YEAR, k=15, extra=["year"])


def q_period_fallback(spark, sf_dir):
    p = rv_panel(spark, sf_dir)
    return rank.select_period(p, "year", RV_MISSING_YEAR, ["total", "net"]).select(
        "o_orderkey", "year", "total", "net")


def q_top_mean_gap(spark, sf_dir):
    return reports.top_mean_gap(rv_panel(spark, sf_dir, True), "nation", "total", "net", k=10)


def q_decade_distribution(spark, sf_dir):
    return stats.decade_distribution(rv_panel(spark, sf_dir), "year", "net")


def q_decade_outliers(spark, sf_dir):
    return stats.decade_outliers(rv_panel(spark, sf_dir), ["o_orderkey"], "year", "net")


# ------------------------------------------------------------------ LI

LI_KEYS = ["l_orderkey", "l_linenumber"]
LI_ORDER = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
            "l_returnflag", "l_linestatus", "l_shipdate"]


def q_key_uniqueness(spark, sf_dir):
    return stats.key_uniqueness(_t(spark, sf_dir, "lineitem"), LI_KEYS)


def q_duplicate_rows(spark, sf_dir):
    return stats.duplicate_rows(_t(spark, sf_dir, "lineitem").select(*LI_KEYS))


def q_dedup_mean(spark, sf_dir):
    return clean.dedup_mean(_t(spark, sf_dir, "lineitem"), LI_KEYS, "l_quantity")


def q_dedup_first(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem").withColumn("__o", F.struct(*LI_ORDER))
    out = clean.dedup_first_agg(li, LI_KEYS, "__o", ["l_partkey", "l_quantity", "l_extendedprice"])
    return out


# ------------------------------------------------------------------ NM

def nm_part(spark, sf_dir):
    return _t(spark, sf_dir, "part")


def nm_name_map(spark, sf_dir):
    return entities.build_name_map(nm_part(spark, sf_dir), "p_name", "p_brand", "p_partkey", NM_AGGREGATE_PREFIX)


def q_name_map(spark, sf_dir):
    return nm_name_map(spark, sf_dir)


def q_exclude_prefix(spark, sf_dir):
    return clean.prefix_lineage(nm_part(spark, sf_dir), "p_brand", NM_AGGREGATE_PREFIX)


def nm_corrected(spark, sf_dir):
    p = nm_part(spark, sf_dir).select("p_partkey", F.col("p_name").alias("name_raw"))
    return entities.apply_corrections(p, "name_raw", NM_CORRECTIONS, out="name")


def q_name_corrections(spark, sf_dir):
    return nm_corrected(spark, sf_dir)


def q_correction_rule_check(spark, sf_dir):
    return entities.rule_check(spark, NM_CORRECTIONS, nm_name_map(spark, sf_dir))


def q_correction_stats(spark, sf_dir):
    return entities.correction_stats(nm_part(spark, sf_dir), "p_name", NM_CORRECTIONS)


def nm_resolved(spark, sf_dir):
    return entities.resolve(nm_corrected(spark, sf_dir), "name", nm_name_map(spark, sf_dir), "code")


def q_resolve_names(spark, sf_dir):
    return nm_resolved(spark, sf_dir).select("p_partkey", "name", "code")


def q_unresolved_names(spark, sf_dir):
    """Brands 2 and 3 give no names here, so that many names are unresolved."""
    some = nm_part(spark, sf_dir).filter(~F.col("p_brand").isin(*NM_SILENT))
    names = entities.build_name_map(some.filter(F.col("p_size") <= 3), "p_name", "p_brand", "p_partkey", NM_AGGREGATE_PREFIX)
    found = entities.resolve(nm_corrected(spark, sf_dir), "name", names, "code")
    return entities.unresolved(found, "name", "code", "p_partkey")


def nm_cmap(spark, sf_dir):
    ref = clean.period_filter(nm_part(spark, sf_dir), "p_size", *NM_SIZE_RANGE)
    ref = clean.exclude_prefix(ref, "p_brand", NM_AGGREGATE_PREFIX)
    return entities.canonical_map(ref, "p_brand", "p_name", "p_partkey")


def nm_coded(spark, sf_dir):
    return nm_part(spark, sf_dir).select("p_partkey", F.col("p_brand").alias("code"), F.lit(None).cast("string").alias("name"))


def q_canonical_labels(spark, sf_dir):
    return entities.canonical_name(nm_coded(spark, sf_dir), "code", "name", nm_cmap(spark, sf_dir))


def q_drop_aggregates(spark, sf_dir):
    coded = nm_coded(spark, sf_dir)
    cmap = nm_cmap(spark, sf_dir)
    kept = entities.canonical_name(coded, "code", "name", cmap, drop_unlabelled=True)
    n_in = coded.agg(F.count(F.lit(1)).alias("rows_in"))
    n_out = kept.agg(F.count(F.lit(1)).alias("rows_out"))
    return n_in.crossJoin(entities.unlabelled_count(coded, "code", cmap)).crossJoin(n_out)


def nm_labelled(spark, sf_dir):
    return entities.canonical_name(nm_coded(spark, sf_dir), "code", "name", nm_cmap(spark, sf_dir),
                                   drop_unlabelled=True)


def q_label_overrides(spark, sf_dir):
    return entities.override_report(spark, nm_labelled(spark, sf_dir), "code", NM_OVERRIDES)


def q_override_check(spark, sf_dir):
    out = entities.override_labels(nm_labelled(spark, sf_dir), "code", "name", NM_OVERRIDES)
    return entities.verify_overrides(out, "code", "name", NM_OVERRIDES)


# ------------------------------------------------------------------ LB

def q_drop_null_keys(spark, sf_dir):
    d = _t(spark, sf_dir, "documents").select("doc_id", "lang")
    lab = _t(spark, sf_dir, "labels")
    return clean.drop_null(d.join(lab, "doc_id", "left"), ["quality"])


def q_coerce_numeric(spark, sf_dir):
    """Numbers as text files write them, and texts that only look like numbers."""
    k = F.get_json_object("props", "$.k")
    shape = F.col("event_id") % 12
    text = F.when(shape == 1, F.concat(k, F.lit("d"))).when(shape == 2, F.concat(k, F.lit("f"))).when(shape == 3, F.concat(F.lit("0x"), k)) \
        .when(shape == 4, F.lit("  ")).when(shape == 5, F.lit("NaN")).when(shape == 6, F.concat(F.lit(" -"), k, F.lit(".5 "))) \
        .when(shape == 7, F.concat(k, F.lit("e-2"))).when(shape == 8, F.concat(k, F.lit(",0"))).otherwise(k)
    return clean.coerce_numeric(_t(spark, sf_dir, "events").select("event_id", text.alias("k")), "k")


# ------------------------------------------------------------------ single tables

def _orders(spark, sf_dir):
    return _t(spark, sf_dir, "orders")


def q_scan_pruned(spark, sf_dir):
    return _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")


def q_sample_head(spark, sf_dir):
    o = _orders(spark, sf_dir).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return clean.first_rows(o, 1000, ["o_orderkey"])


def q_rename_project(spark, sf_dir):
    o = _orders(spark, sf_dir).withColumn("o_year", F.year("o_orderdate"))
    r = clean.rename(o, {"o_custkey": "entity", "o_year": "period", "o_totalprice": "value", "o_orderkey": "row_id"})
    return clean.canonical_order(r, ["entity", "period", "value", "row_id", "not_there"])


def q_period_filter(spark, sf_dir):
    o = _orders(spark, sf_dir).select("o_orderkey", F.year("o_orderdate").alias("year"))
    return clean.period_filter(o, "year", *RV_PERIOD_RANGE)


def q_filter_eq(spark, sf_dir):
    o = _orders(spark, sf_dir).select("o_orderkey", "o_orderstatus")
    return clean.filter_if_present(clean.filter_if_present(o, "o_orderstatus", "F"), "no_such_column", "x")


def q_cascade_filter(spark, sf_dir):
    o = _orders(spark, sf_dir).select("o_orderkey", "o_orderstatus")
    return clean.filter_first_present(o, "o_orderstatus", ("X", "P", "F"))


def q_clean_lineage(spark, sf_dir):
    o = _orders(spark, sf_dir)
    return clean.clean_lineage(o, [
        ("drop_null", F.col("o_custkey").isNotNull()),
        ("exclude_prefix", ~F.col("o_orderpriority").startswith("5-")),
        ("period_filter", F.year("o_orderdate").between(*RV_PERIOD_RANGE)),
    ])


def q_column_profile(spark, sf_dir):
    return reports.column_profile(_t(spark, sf_dir, "customer"), ["c_custkey"])


MERGE_KEY_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                    "documents", "labels")


def q_merge_keys(spark, sf_dir):
    return reports.merge_keys(spark, {t: _t(spark, sf_dir, t) for t in MERGE_KEY_TABLES}, with_stats=True)


def q_source_profile(spark, sf_dir):
    o = lambda: _orders(spark, sf_dir).select(
        "o_orderkey", "o_custkey", F.year("o_orderdate").alias("o_year"), "o_totalprice", "o_orderstatus")
    srcs = [
        {"label": "orders", "code": "o_custkey", "metric": "o_totalprice", "period": "o_year", "load": o},
        {"label": "lineitem keys", "metric": "l_quantity",
         "load": lambda: _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")},
        {"label": "customer", "code": "c_nationkey", "name": "c_name", "metric": "c_acctbal",
         "load": lambda: _t(spark, sf_dir, "customer")},
        {"label": "missing", "code": "x", "load": lambda: _t(spark, sf_dir, "no_such_table")},
    ]
    return reports.source_profile(spark, srcs, (0.0, 100000.0))


def q_positional_clean(spark, sf_dir):
    o = _orders(spark, sf_dir).select(
        F.col("o_orderkey").alias("__row"),
        F.year("o_orderdate").cast("string").alias("_c0"), F.col("o_totalprice").cast("string").alias("_c1"))
    return clean_positional(o, period_pos=0, value_pos=1, const_code="ALL", metric="value",
                            order_col="__row", period_range=(1950, 2024))


def nm_payloads(spark, sf_dir) -> DataFrame:
    """Nation rows packed into one paged JSON payload per region."""
    n = _t(spark, sf_dir, "nation")
    # one region's records carry an empty code, another region's a null value
    code = F.when(F.col("n_regionkey") == PAYLOAD_EMPTY_CODE_REGION, F.lit("")).otherwise(
        F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")))
    value = F.when(F.col("n_regionkey") == PAYLOAD_NULL_VALUE_REGION, F.lit(None).cast("double")).otherwise(
        F.col("n_nationkey") * 1.5 + 40)
    rec = F.struct(code.alias("countryiso3code"), F.struct(F.col("n_name").alias("value")).alias("country"),
                   (F.col("n_regionkey") + 2000).cast("string").alias("date"), value.alias("value"))
    per = n.groupBy("n_regionkey").agg(F.to_json(F.collect_list(rec)).alias("__recs"))
    meta = F.to_json(F.struct(F.lit(1).alias("page"), F.col("n_regionkey").alias("region")))
    return per.select(F.concat(F.lit("["), meta, F.lit(","), F.col("__recs"), F.lit("]")).alias("value"))


def q_payload_flatten(spark, sf_dir):
    return flatten_payload(nm_payloads(spark, sf_dir))


def nm_changed_payloads(spark, sf_dir) -> DataFrame:
    """A page per order priority: records with a field that the schema doesn't know, values as text in one
    page and no value at all in another, and a line that isn't JSON."""
    o = _orders(spark, sf_dir)
    record = F.struct(
        F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("countryiso3code"), F.struct(F.col("o_orderstatus").alias("value")).alias("country"),
        F.year("o_orderdate").cast("string").alias("date"), F.col("o_custkey").alias("value"), F.col("o_orderstatus").alias("status"))
    as_text = F.to_json(record.withField("value", F.col("o_custkey").cast("string")))
    text = F.when(F.col("o_orderstatus") == "F", as_text).when(F.col("o_orderstatus") == "P", F.to_json(record.dropFields("value", "status"))).otherwise(F.to_json(record))
    pages = o.groupBy("o_custkey").agg(F.concat(F.lit('[{"page":1},['), F.array_join(F.collect_list(text), ","), F.lit("]]")).alias("value")).select("value")
    return pages.union(spark.createDataFrame([("not json",)], "value string"))


def q_payload_variant(spark, sf_dir):
    """Records with unknown, missing and retyped fields survive."""
    return flatten_records(nm_changed_payloads(spark, sf_dir))


def q_payload_schema(spark, sf_dir):
    """How many fields the least common schema of all records has, by pages and by lines."""
    pages = explode_records(nm_changed_payloads(spark, sf_dir))
    fields = lambda df: inferred_schema(df).select(F.size(F.split("schema", ": ")).alias("marks"))
    lines = explode_records(pages.select(F.to_json("record").alias("value")), path=None)
    return pages.agg(F.count("*").alias("records")).crossJoin(F.broadcast(fields(pages))).crossJoin(F.broadcast(fields(lines).withColumnRenamed("marks", "line_marks")))


# ------------------------------------------------------------------ files written and read back

def _scratch(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _documents_as_csv(spark, sf_dir, encoding: str, text) -> str:
    """documents as CSV: texts with quotes, commas and line breaks."""
    path = _scratch(spark, "csv")
    docs = _t(spark, sf_dir, "documents").select("doc_id", "lang", text.alias("text"), "source")
    docs.write.option("header", True).option("escape", '"').option("encoding", encoding).option("ignoreLeadingWhiteSpace", False) \
        .option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


def q_csv_scan(spark, sf_dir):
    """Every text, line breaks included, from CSV files that split."""
    got = read_csv_split(spark, _documents_as_csv(spark, sf_dir, "UTF-8", F.col("text")))
    return got.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "source", F.md5(F.col("text").cast("binary")).alias("text_md5"))


def q_csv_latin1_scan(spark, sf_dir):
    """Files that aren't UTF-8 are read as Latin-1, file by file."""
    text = F.regexp_replace("text", r"[^\x0A\x20-\x7E\u00A1-\u00FF]", "")
    got = read_csv_split(spark, _documents_as_csv(spark, sf_dir, "ISO-8859-1", text))
    return got.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "source", F.md5(F.col("text").cast("binary")).alias("text_md5"))


def q_missing_source(spark, sf_dir):
    """An optional source that is missing is left out of the merge, one that is there isn't."""
    path = _scratch(spark, "source")
    write_panel(rv_panel(spark, sf_dir).select("o_orderkey", "total"), path, "parquet")
    specs = [SourceSpec("there", path, "total", fmt="parquet"), SourceSpec("gone", path + "-gone", "total", fmt="parquet", optional=True)]
    found = [(s.label, pipeline.load_source(spark, s)) for s in specs]
    return found[0][1].select("o_orderkey", "total", F.lit(",".join(label for label, df in found if df is not None)).alias("sources"))


def _sink(spark, sf_dir, fmt: str) -> DataFrame:
    panel, path = ev_panel(spark, sf_dir), _scratch(spark, "sink")
    write_panel(panel, path, fmt, keys=list(EV_KEYS))
    reader = spark.read.schema(panel.schema)
    return (reader.option("header", True).csv(path) if fmt == "csv" else reader.format(fmt).load(path)).select(*panel.columns)


def q_sink_csv(spark, sf_dir):
    return _sink(spark, sf_dir, "csv")


def q_sink_parquet(spark, sf_dir):
    return _sink(spark, sf_dir, "parquet")


def q_sink_json(spark, sf_dir):
    return _sink(spark, sf_dir, "json")


def q_clustered_store(spark, sf_dir):
    """Line items by order and ship year, stored by year and order; a second release replaces the years from 1997 on."""
    table = f"panel_{uuid.uuid4().hex}"
    lines = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", F.year("l_shipdate").alias("year"))
    store_panel(lines, table, ["l_orderkey", "year"], "year", buckets=8, path=_scratch(spark, "store"))
    store_panel(lines.filter("year >= 1997").withColumn("l_quantity", F.col("l_quantity") * 2), table, ["l_orderkey", "year"], "year", buckets=8)
    stored = stored_panel(spark, table)
    return key_sizes(stored, ["l_orderkey", "year"], "year").join(
        stored.groupBy("l_orderkey", "year").agg(F.sum("l_quantity").alias("quantity")), ["l_orderkey", "year"])


def q_release_merge(spark, sf_dir):
    """The five event sources as a first release; in a second one user's clicks are corrected and a day's errors withdrawn."""
    folder, sources = _scratch(spark, "releases"), dict(zip(EV_TYPES, ev_sources(spark, sf_dir)))
    release.apply_release(spark, folder, sources, EV_KEYS, buckets=4, fanout=2, on_duplicate="mean")
    corrected = F.when(F.col("user_id") == RELEASE_USER, F.col("m_click") + 1).otherwise(F.col("m_click"))
    second = {"click": sources["click"].withColumn("m_click", corrected), "error": sources["error"].filter(F.col("day") != RELEASE_DAY)}
    release.apply_release(spark, folder, second, EV_KEYS, buckets=4, fanout=2, on_duplicate="mean")
    return release.current_panel(spark, folder)


def q_asof_join(spark, sf_dir):
    """Each purchase with the user's latest view at or before it."""
    e = _t(spark, sf_dir, "events")
    bought = e.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    viewed = e.filter("event_type = 'view'").select("user_id", F.col("ts").alias("view_ts"), F.col("value").alias("view_value"))
    out = asof_join(bought, viewed, ["user_id"], "ts", "view_ts", matched="view_ts")
    return out.select("event_id", "user_id", F.unix_micros(F.col("view_ts").cast("timestamp")).cast("string").alias("view_micros"), "view_value")


def q_carry_last(spark, sf_dir):
    """The event panel with the gaps of each metric filled by the user's last value."""
    return carry_last(ev_panel(spark, sf_dir), ["user_id"], "day", EV_METRICS)


def q_interval_join(spark, sf_dir):
    """Line items shipped while other orders of the customer were open: an order is for (key mod 400) days, some without end."""
    o = _orders(spark, sf_dir)
    opened = F.to_date("o_orderdate")
    end = F.when(F.col("o_orderkey") % 97 != 0, F.date_add(opened, (F.col("o_orderkey") % 400).cast("int")))
    spans = o.select("o_custkey", F.col("o_orderkey").alias("open_orderkey"), opened.alias("since"), end.alias("until"))
    lines = _t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", F.to_date("l_shipdate").alias("shipped"))
    points = lines.join(o.select("o_orderkey", "o_custkey"), "o_orderkey")
    return interval_join(points, spans, ["o_custkey"], "shipped", "since", "until").groupBy("open_orderkey").agg(
        F.count("*").alias("lines"), F.sum(F.col("o_orderkey") * 10 + F.col("l_linenumber")).cast("long").alias("marks"))


def q_stream_revisions(spark, sf_dir):
    """events as a stream: a user's last value of each type and day, of the days that the watermark has passed."""
    landed, events = _scratch(spark, "landed"), _t(spark, sf_dir, "events")
    at = F.col("ts").cast("timestamp")
    events.select("user_id", "event_type", at.alias("at"), at.alias("revised"), "value").write.parquet(landed)  # a stream reads a folder
    stream = read_source_stream(spark, landed, "user_id long, event_type string, at timestamp, revised timestamp, value double")
    final = final_revisions(stream, ["user_id", "event_type"], "at", "revised", ["value"], "1 day", "7 days")
    out = _scratch(spark, "revisions")
    append_final(final, out, f"{out}-checkpoint").awaitTermination()
    return spark.read.schema(final.schema).parquet(out).select(
        F.date_format(START, "yyyy-MM-dd").alias("day"), "user_id", "event_type", F.unix_micros("revised").alias("revised"), "value")


def q_sketch_report(spark, sf_dir):
    """Event values by type from sketches a day; days after the 20th come with a refresh. The estimates are held against
    exact counts: distinct users within 4 %, the ranks of the quartiles within 2 %."""
    path, events = _scratch(spark, "sketches"), ev_long(spark, sf_dir)
    for days in ("day <= 21", "day > 20"):
        refresh_sketches(events.filter(days), path, "day", "user_id", ["value"], dims=["event_type"])
    report = united_report(stored_sketches(spark, path), ["value"], ["event_type"])
    ranks = [F.count_if(F.col("value") < F.col(q)).alias(f"{q}_lo") for q in ("q25", "q50", "q75")] + \
            [F.count_if(F.col("value") <= F.col(q)).alias(f"{q}_hi") for q in ("q25", "q50", "q75")]
    exact = events.join(report.select("event_type", "q25", "q50", "q75"), "event_type").groupBy("event_type").agg(
        F.countDistinct("user_id").alias("users"), *ranks)
    close = " AND ".join(f"({q}_lo / filled - 0.02 <= {s} AND {s} <= {q}_hi / filled + 0.02)" for q, s in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75)))
    return report.join(exact, "event_type").select(
        "event_type", "rows", "filled", "mean", "min", "max",
        F.expr("abs(entities - users) <= 0.04 * users").alias("users_close"), F.expr(close).alias("ranks_close"))


def q_name_proposals(spark, sf_dir):
    """Each part name with a character lost, against the known names."""
    p = nm_part(spark, sf_dir)
    at = F.col("p_partkey") % F.length("p_name")
    lost = p.select(F.concat(F.substring("p_name", F.lit(1), at), F.substring("p_name", at + 2, F.length("p_name"))).alias("name"))
    return entities.propose_names(lost, nm_name_map(spark, sf_dir))


def q_panel_subtotals(spark, sf_dir):
    """Years, nations, both, and all orders, from one scan."""
    out = stats.subtotals(rv_panel(spark, sf_dir, with_nation=True), [["year", "nation"], ["year"], ["nation"], []], "o_custkey", ["total", "net"])
    dims = {c: F.coalesce(F.col(c).cast("string"), F.lit("all")) for c in ("year", "nation")}
    # Sums of amounts of four decimals; a mean could lie halfway between two rounded values.
    return out.withColumns(dims).withColumns({c: F.round(c, 4) for c in ("total_sum", "net_sum")}).drop("total_mean", "net_mean")


# ------------------------------------------------------------------ the six cleaners (I1-I7)

def _raw_part(spark, sf_dir, value) -> DataFrame:
    """part as a publisher's file: text cells, the year as 1950 + size, file order by key."""
    return nm_part(spark, sf_dir).select(
        F.col("p_partkey").alias("__row"), F.col("p_name").alias(" Entity "), F.col("p_brand").alias("Code"),
        (F.col("p_size") + 1950).cast("string").alias("Year"), value.cast("string").alias("Life expectancy"))


def _spec(label: str, **changes):
    """The shipped spec of a source, with the test data's value codes."""
    spec = next(s for s in LE.SOURCES if s.label == label)
    return replace(spec, **({"exclude_code_prefix": NM_AGGREGATE_PREFIX} if spec.exclude_code_prefix else {}), **changes)


def _clean(frame, spec, names=None, period=CLEAN_PERIOD):
    return pipeline.clean_frame(frame, spec, names, NM_CORRECTIONS, period)


def _raw_owid(spark, sf_dir):
    return _raw_part(spark, sf_dir, F.col("p_retailprice"))


def q_clean_owid(spark, sf_dir):
    return _clean(_raw_owid(spark, sf_dir), _spec("OWID"))


def q_clean_world_bank(spark, sf_dir):
    """Values that aren't there stay as NULL rows; ".." is no number."""
    o = _orders(spark, sf_dir)
    value = F.when(F.col("o_orderkey") % 10 == 0, F.lit("..")).otherwise(F.col("o_totalprice").cast("string"))
    raw = o.select(F.col("o_custkey").cast("string").alias("iso3"), F.year("o_orderdate").cast("string").alias("year"), value.alias("life_exp_wb"))
    return _clean(raw, _spec("World Bank"), period=(1900, 2100))


def _raw_kaggle(spark, sf_dir):
    value = F.when(F.col("p_partkey") % 7 != 0, F.col("p_retailprice"))
    return _raw_part(spark, sf_dir, value).drop("Code").withColumnRenamed(" Entity ", "Country")


def q_clean_kaggle(spark, sf_dir):
    return _clean(_raw_kaggle(spark, sf_dir), _spec("Kaggle"), nm_name_map(spark, sf_dir))


def q_clean_unicef(spark, sf_dir):
    """Totals only (return flag N plays the total), repeated keys averaged, no NULL values."""
    raw = _t(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_returnflag") == "N", "_T").otherwise(F.col("l_returnflag")).alias("SEX"),
        F.col("l_suppkey").cast("string").alias("REF_AREA"), F.year("l_shipdate").cast("string").alias("TIME_PERIOD"),
        F.when(F.col("l_linenumber") == 4, F.lit("n/a")).otherwise(F.col("l_quantity").cast("string")).alias("OBS_VALUE"))
    return _clean(raw, _spec("UNICEF"), period=(1900, 2100))


def q_clean_who(spark, sf_dir):
    """Countries only, the first category that occurs, first row per key in file order."""
    raw = nm_part(spark, sf_dir).select(
        F.col("p_partkey").alias("__row"), F.col("p_name").alias("GEO_NAME_SHORT"), (F.col("p_size") + 1950).cast("string").alias("DIM_TIME"),
        F.when(F.col("p_partkey") % 10 == 4, F.lit("")).otherwise(F.col("p_retailprice").cast("string")).alias("AMOUNT_N"),
        F.when(F.col("p_partkey") % 3 == 0, "REGION").otherwise("COUNTRY").alias("DIM_GEO_CODE_TYPE"),
        F.when(F.col("p_partkey") % 2 == 0, "BTSX").otherwise("BOTHSEXES").alias("DIM_SEX"))
    return _clean(raw, _spec("WHO (HALE)"), nm_name_map(spark, sf_dir))


def q_clean_cdc(spark, sf_dir):
    raw = _orders(spark, sf_dir).select(
        F.col("o_orderkey").alias("__row"), F.year("o_orderdate").cast("string").alias("_c0"), F.col("o_totalprice").cast("string").alias("_c1"))
    return _clean(raw, _spec("CDC (US)"), period=(1900, 2100))


def _pipeline_sources(spark, sf_dir):
    """Three sources on part, the first being the reference, and their configuration."""
    wb = nm_part(spark, sf_dir).select(
        F.concat(F.lit("Brand#"), F.col("p_size").cast("string")).alias("iso3"), (F.col("p_size") + 1955).cast("string").alias("year"),
        F.col("p_retailprice").cast("string").alias("life_exp_wb"))
    config = SimpleNamespace(CORRECTIONS=NM_CORRECTIONS, OVERRIDES=NM_OVERRIDES, AGGREGATE_PREFIX=NM_AGGREGATE_PREFIX,
                             PERIOD_RANGE=CLEAN_PERIOD, METRICS=LE.METRICS, ON_DUPLICATE=LE.ON_DUPLICATE)
    owid = _raw_owid(spark, sf_dir).withColumnRenamed(" Entity ", "Entity")
    return [(owid, _spec("OWID")), (wb, _spec("World Bank")), (_raw_kaggle(spark, sf_dir), _spec("Kaggle"))], config


def q_panel_pipeline(spark, sf_dir):
    """The whole chain after reading: three sources, corrections, drops and overrides."""
    sources, config = _pipeline_sources(spark, sf_dir)
    return pipeline.panel_from_frames(*sources[0], sources, config)


def _stored_pipeline(spark, sf_dir):
    sources, config = _pipeline_sources(spark, sf_dir)
    frames = {spec.label: (df if "__row" in df.columns else df.withColumn("__row", F.monotonically_increasing_id()), spec) for df, spec in sources}
    return pipeline.panel_from_stored(frames, sources[0][1], list(frames), config)


def q_stored_pipeline(spark, sf_dir):
    """The same chain, each source stored once."""
    return _stored_pipeline(spark, sf_dir)[0]


def q_observed_lineage(spark, sf_dir):
    """Rows through the cleaning steps of the three sources, counted by the pass that stores them."""
    return _stored_pipeline(spark, sf_dir)[1]


def q_observed_facts(spark, sf_dir):
    """Fill, range and bounds of the event panel, counted by the pass that stores it."""
    return store_facts(ev_panel(spark, sf_dir), EV_METRICS, _scratch(spark, "panel"), EV_BOUNDS)[1].withColumn("out_of_bounds", F.col("out_of_bounds").cast("string"))


def q_type_report(spark, sf_dir):
    return stats.type_report(ev_panel(spark, sf_dir), ["m_click", "m_view", "user_id", "absent"])


def q_sorted_extract(spark, sf_dir):
    """Headers with blanks, required columns, canonical order and the total order of a sink."""
    raw = _t(spark, sf_dir, "customer").withColumnsRenamed({"c_custkey": " entity", "c_nationkey": "nation ", "c_acctbal": "value"})
    rows = clean.require_columns(clean.strip_headers(raw), ["entity", "nation", "value"])
    return rank.sort_panel(clean.canonical_order(rows, ["nation", "entity", "value", "not_there"]), ["nation", "entity"])
