"""Independent DuckDB SQL for every binding in ``bindings`` (the correctness
oracle). Written against the raw tables, never against our own outputs.
Double columns are rounded to 6 places, counts are BIGINT, periods INTEGER."""

from __future__ import annotations

from panelmerge.plans import bindings as B


def _r(sql: str, *doubles: str) -> str:
    """Round the listed double columns of ``sql`` to 6 places."""
    if not doubles:
        return sql
    rep = ", ".join(f'round(CAST("{c}" AS DOUBLE), 6) AS "{c}"' for c in doubles)
    return f"SELECT * REPLACE ({rep}) FROM ({sql}) AS q"


def _in(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


EV_KEYS_SQL = "user_id, day"
MET = list(B.EV_METRICS)
EV = ("ev AS (SELECT user_id, CAST(day(ts) AS INTEGER) AS day, "
      + ", ".join(f"avg(CASE WHEN event_type = '{t}' THEN value END) AS m_{t}" for t in B.EV_TYPES)
      + f" FROM events WHERE event_type IN ({_in(B.EV_TYPES)}) GROUP BY 1, 2)")
NSRC = " + ".join(f"CAST({m} IS NOT NULL AS INTEGER)" for m in MET)
LO, HI = B.EV_BOUNDS
PLO, PHI = B.EV_PERIOD_RANGE


def _spread(cols) -> str:
    return f"(greatest({', '.join(cols)}) - least({', '.join(cols)}))"


def _nsrc(cols) -> str:
    return " + ".join(f"CAST({m} IS NOT NULL AS INTEGER)" for m in cols)


def _long_union(table: str, rows) -> str:
    return " UNION ALL ".join(rows)


Q: dict[str, str] = {}

# ------------------------------------------------------------------ EV
Q["panel_merge_union"] = _r(f"WITH {EV} SELECT * FROM ev", *MET)
Q["panel_merge_join"] = Q["panel_merge_union"]
Q["merge_collision"] = (
    "SELECT user_id, CAST(day(ts) AS INTEGER) AS day, CASE "
    + " ".join(f"WHEN count(*) FILTER (WHERE event_type = '{t}') > 0 THEN '{t}:' || CAST(user_id AS VARCHAR)"
               for t in B.EV_TYPES)
    + f" END AS name FROM events WHERE event_type IN ({_in(B.EV_TYPES)}) GROUP BY 1, 2")
Q["source_coverage"] = _r(
    f"WITH {EV}, c AS (SELECT CAST({NSRC} AS INTEGER) AS n FROM ev) "
    "SELECT n AS n_sources, count(*) AS rows, count(*) * 100.0 / (SELECT count(*) FROM c) AS pct, "
    "(SELECT avg(n) FROM c) AS avg_sources FROM c GROUP BY n", "pct", "avg_sources")

_fill_cols = ["user_id", "day"] + MET
Q["column_fill"] = _r(
    f"WITH {EV}, t AS (SELECT count(*) AS total, "
    + ", ".join(f"count({c}) AS c{i}" for i, c in enumerate(_fill_cols)) + " FROM ev) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {i} AS ordinal, c{i} AS present, total - c{i} AS missing, total, "
        f"CAST(c{i} AS DOUBLE) * 100.0 / total AS fill_pct, "
        f"CASE WHEN c{i} * 100.0 / total > 90 THEN 'ok' WHEN c{i} * 100.0 / total > 50 THEN 'warn' ELSE 'red' END AS flag "
        f"FROM t" for i, c in enumerate(_fill_cols)),
    "fill_pct")
_filled = " + ".join(f"count({m})" for m in MET)
Q["overall_fill"] = _r(
    f"WITH {EV} SELECT CAST({_filled} AS BIGINT) AS filled_cells, CAST(count(*) * {len(MET)} AS BIGINT) AS metric_cells, "
    f"CAST({_filled} AS DOUBLE) * 100.0 / (count(*) * {len(MET)}) AS overall_fill_pct, "
    f"({' + '.join(f'CAST(count({m}) AS DOUBLE) * 100.0 / count(*)' for m in MET)}) / {len(MET)} AS avg_column_fill_pct FROM ev",
    "overall_fill_pct", "avg_column_fill_pct")
Q["panel_extent"] = (f"WITH {EV} SELECT count(*) AS rows, count(DISTINCT user_id) AS entities, "
                     "count(DISTINCT day) AS periods, min(day) AS min_period, max(day) AS max_period FROM ev")
Q["grid_density"] = _r(
    f"WITH {EV}, e AS (SELECT count(*) AS rows, count(DISTINCT user_id) AS entities, count(DISTINCT day) AS periods FROM ev) "
    "SELECT rows, entities, periods, entities * periods AS grid_cells, rows * 100.0 / (entities * periods) AS density_pct FROM e",
    "density_pct")
_b_rows = [f"SELECT '{m}' AS \"column\", {i} AS ordinal, count(*) FILTER (WHERE {m} < {LO}) AS below, "
           f"count(*) FILTER (WHERE {m} > {HI}) AS above FROM ev" for i, m in enumerate(MET)]
_b_rows.append(f"SELECT 'day', {len(MET)}, count(*) FILTER (WHERE day IS NULL OR day < {PLO}), "
               f"count(*) FILTER (WHERE day > {PHI}) FROM ev")
Q["bounds_check"] = (f"WITH {EV}, b AS ({' UNION ALL '.join(_b_rows)}) "
                     "SELECT \"column\", ordinal, below, above, below + above AS out_of_bounds FROM b")


def _pair_sql(pairs, src="ev") -> str:
    rows = []
    for i, (a, b, label) in enumerate(pairs):
        rows.append(f"SELECT '{label}' AS pair, {i} AS ordinal, count(*) AS n, avg(abs({a} - {b})) AS mean_abs, "
                    f"max(abs({a} - {b})) AS max_abs, corr({a}, {b}) AS corr FROM {src} "
                    f"WHERE {a} IS NOT NULL AND {b} IS NOT NULL")
    return " UNION ALL ".join(rows)


Q["pair_agreement"] = _r(f"WITH {EV}, p AS ({_pair_sql(B.EV_PAIRS)}) SELECT *, CASE WHEN mean_abs < 3.5 THEN 'pass' "
                         "WHEN mean_abs < 5.0 THEN 'warn' ELSE 'fail' END AS status FROM p WHERE n > 0",
                         "mean_abs", "max_abs", "corr")
_cs = list(B.EV_CONFLICT_SOURCES)
TOL = B.EV_TOLERANCE
Q["le_conflicts"] = (
    f"WITH {EV}, s AS (SELECT {_nsrc(_cs)} AS n, {_spread(_cs)} AS spread FROM ev) "
    "SELECT count(*) AS total_rows, count(*) FILTER (WHERE n >= 2) AS testable_rows, "
    f"count(*) FILTER (WHERE n >= 2 AND NOT spread > {TOL}) AS within_tolerance, "
    f"count(*) FILTER (WHERE n >= 2 AND spread > {TOL}) AS severe_conflicts FROM s")
Q["top_conflicts"] = _r(
    f"WITH {EV} SELECT user_id, day, {', '.join(_cs)}, {_spread(_cs)} AS spread FROM ev "
    f"WHERE {_nsrc(_cs)} >= 2 AND {_spread(_cs)} > {TOL} ORDER BY spread DESC, user_id, day LIMIT 5",
    *_cs, "spread")

_lower, _upper = B.EV_RULE
_avg_fill = f"({' + '.join(f'CAST(count({m}) AS DOUBLE) * 100.0 / count(*)' for m in MET)}) / {len(MET)}"
_oob = " + ".join(f"count(*) FILTER (WHERE {m} < {LO} OR {m} > {HI})" for m in MET)
DQ = (
    f"WITH {EV}, "
    f"base AS (SELECT count(*) AS rows, {_avg_fill} AS avg_fill, "
    f"{_oob} + count(*) FILTER (WHERE day IS NULL OR day < {PLO} OR day > {PHI}) AS oob, "
    f"count(*) FILTER (WHERE {_lower} IS NOT NULL AND {_upper} IS NOT NULL) AS overlap, "
    f"count(*) FILTER (WHERE {_lower} > {_upper}) AS viol FROM ev), "
    "ks AS (SELECT count(*) AS s FROM ev GROUP BY user_id, day), "
    + "rs AS (SELECT count(*) AS s FROM ev GROUP BY user_id, day, " + ", ".join(MET) + "), " +
    "u AS (SELECT (SELECT max(s) FROM ks) AS max_per_key, (SELECT COALESCE(sum(s - 1), 0) FROM rs) AS dups), "
    f"pa AS ({_pair_sql(B.EV_PAIRS)}), "
    "a AS (SELECT max(mean_abs) AS worst, CAST(COALESCE(sum(n), 0) AS BIGINT) AS checked, "
    f"count(*) FILTER (WHERE mean_abs >= {3.5}) AS bad FROM pa WHERE n > 0), "
    "card AS ("
    "SELECT 'completeness' AS dimension, 1 AS ordinal, avg_fill > 30.0 AS passed, avg_fill AS value, rows AS checked_rows FROM base "
    "UNION ALL SELECT 'uniqueness', 2, COALESCE(max_per_key, 1) = 1 AND dups = 0, CAST(max_per_key AS DOUBLE), rows FROM base, u "
    "UNION ALL SELECT 'validity', 3, oob = 0, CAST(oob AS DOUBLE), rows FROM base "
    "UNION ALL SELECT 'accuracy', 4, bad = 0, worst, checked FROM a "
    "UNION ALL SELECT 'consistency', 5, viol = 0, CAST(viol AS DOUBLE), overlap FROM base)")
Q["dq_scorecard"] = _r(f"{DQ} SELECT *, true AS type_ok FROM card", "value")
Q["dq_grade"] = _r(
    f"{DQ}, g AS (SELECT count(*) FILTER (WHERE passed) AS passed, count(*) AS total FROM card) "
    "SELECT passed, total, passed * 100.0 / total AS score_pct, "
    "CASE WHEN passed * 100.0 / total >= 100 THEN 'A' WHEN passed * 100.0 / total >= 80 THEN 'B' "
    "WHEN passed * 100.0 / total >= 60 THEN 'C' ELSE 'D' END AS grade FROM g", "score_pct")
Q["audit_columns"] = _r(
    f"WITH {EV}, t AS (SELECT count(*) AS total, "
    + ", ".join(f"count({c}) AS c{i}" for i, c in enumerate(_fill_cols)) + " FROM ev), "
    "m AS (" + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {i} AS ordinal, total - c{i} AS missing, total FROM t"
        for i, c in enumerate(_fill_cols)) + ") "
    "SELECT \"column\", ordinal, missing, total, CAST(missing AS DOUBLE) * 100.0 / total AS missing_pct, "
    "CASE WHEN missing = 0 THEN 'none' WHEN missing * 100.0 / total < 50 THEN 'warn' ELSE 'red' END AS flag FROM m",
    "missing_pct")
Q["audit_keys"] = _r(
    f"WITH {EV}, "
    "ks AS (SELECT count(*) AS s FROM ev GROUP BY user_id, day), rs AS (SELECT count(*) AS s FROM ev GROUP BY user_id, day, "
    + ", ".join(MET) + ") "
    "SELECT count(*) AS rows, count(*) FILTER (WHERE user_id IS NULL) AS entity_nulls, "
    "count(*) FILTER (WHERE day IS NULL) AS period_nulls, count(DISTINCT user_id) AS entities, "
    "min(day) AS min_period, max(day) AS max_period, "
    "(SELECT CAST(COALESCE(sum(s - 1), 0) AS BIGINT) FROM ks) AS duplicate_keys, "
    "(SELECT CAST(COALESCE(sum(s - 1), 0) AS BIGINT) FROM rs) AS duplicate_rows, "
    "(SELECT COALESCE(sum(s - 1), 0) * 100.0 / sum(s) FROM rs) AS duplicate_pct, "
    f"{len(_fill_cols)} AS columns FROM ev", "duplicate_pct")
FINAL = (
    "SELECT count(*) AS rows, {ncols} AS columns, count(DISTINCT user_id) AS entities, min(day) AS min_period, "
    "max(day) AS max_period, count(user_id) * 100.0 / count(*) AS code_fill_pct, 0.0 AS name_fill_pct, "
    "(SELECT CAST(COALESCE(sum(s - 1), 0) AS BIGINT) FROM ks) AS duplicate_keys, "
    f"{_avg_fill} AS avg_metric_fill_pct, CAST({_oob} AS BIGINT) AS out_of_bounds FROM ev"
).format(ncols=len(_fill_cols))
Q["final_profile"] = _r(
    f"WITH {EV}, ks AS (SELECT count(*) AS s FROM ev GROUP BY user_id, day) {FINAL}",
    "code_fill_pct", "name_fill_pct", "avg_metric_fill_pct")
Q["coverage_ranking"] = _r(
    f"WITH {EV} " + " UNION ALL ".join(
        f"SELECT '{B.EV_LABELS[m]}' AS source, '{m}' AS \"column\", count({m}) * 100.0 / count(*) AS coverage_pct FROM ev"
        for m in MET), "coverage_pct")
Q["presence_matrix"] = (f"WITH {EV} SELECT user_id, day, "
                        + ", ".join(f"CAST({m} IS NOT NULL AS INTEGER) AS has_{m}" for m in MET) + " FROM ev")
Q["presence_by_period"] = _r(
    f"WITH {EV}, p AS (SELECT day, count(*) AS rows, "
    + ", ".join(f"count({m}) AS c{i}" for i, m in enumerate(MET)) + " FROM ev GROUP BY day) "
    + " UNION ALL ".join(f"SELECT day, '{m}' AS \"column\", rows, c{i} AS present, c{i} * 100.0 / rows AS share_pct FROM p"
                         for i, m in enumerate(MET)), "share_pct")
Q["rank_ticks"] = (
    f"WITH {EV}, per AS (SELECT day, count(*) AS c FROM ev GROUP BY day), "
    "rng AS (SELECT day, sum(c) OVER (ORDER BY day) - c AS s, sum(c) OVER (ORDER BY day) AS e FROM per), "
    "n AS (SELECT count(*) AS n FROM ev), "
    "t AS (SELECT CAST(i AS INTEGER) AS tick, CAST(CASE WHEN i = 5 THEN n - 1 "
    "ELSE floor(CAST(i AS DOUBLE) * (CAST(n - 1 AS DOUBLE) / 5.0::DOUBLE)) END AS BIGINT) AS position "
    "FROM n, range(6) r(i)) "
    "SELECT tick, position, day FROM t JOIN rng ON position >= s AND position < e")
Q["extreme_lows"] = _r(
    f"WITH {EV} SELECT user_id, day, m_click, m_view FROM ev WHERE m_click < {B.EV_LOW} OR m_view < {B.EV_LOW}",
    "m_click", "m_view")
Q["divergence_stats"] = _r(
    f"WITH {EV}, d AS (SELECT abs(m_click - m_purchase) AS d FROM ev WHERE m_click IS NOT NULL AND m_purchase IS NOT NULL) "
    "SELECT count(*) AS n, avg(d) AS mean_abs, median(d) AS median_abs, max(d) AS max_abs, "
    "avg(CASE WHEN d < 1.0 THEN 1.0 ELSE 0.0 END) * 100 AS pct_under FROM d",
    "mean_abs", "median_abs", "max_abs", "pct_under")
Q["extreme_by_entity"] = _r(
    f"WITH {EV}, d AS (SELECT user_id, abs(m_click - m_purchase) AS d FROM ev "
    f"WHERE m_click IS NOT NULL AND m_purchase IS NOT NULL) "
    f"SELECT user_id, count(*) AS rows, avg(d) AS mean_abs FROM d WHERE d > {B.EV_EXTREME} GROUP BY user_id",
    "mean_abs")
Q["top_divergence"] = _r(
    f"WITH {EV} SELECT user_id, day, m_click, m_view, abs(m_click - m_view) AS abs_diff FROM ev "
    "WHERE abs(m_click - m_view) IS NOT NULL ORDER BY abs_diff DESC, user_id, day LIMIT 5",
    "m_click", "m_view", "abs_diff")
Q["conflict_matrix"] = _r(
    f"WITH {EV}, c AS (SELECT * FROM ev WHERE m_click IS NOT NULL AND m_view IS NOT NULL), "
    "l AS (SELECT * FROM c WHERE day = (SELECT max(day) FROM c)), "
    "a AS (SELECT count(m_purchase) AS avail FROM l) "
    "SELECT user_id, m_click, m_view, CASE WHEN avail >= 10 THEN m_purchase END AS m_purchase, "
    "abs(m_click - m_view) AS divergence FROM l, a ORDER BY divergence DESC, user_id LIMIT 20",
    "m_click", "m_view", "m_purchase", "divergence")
EV_PIPE = ("evp AS (SELECT user_id, CAST(day(ts) AS INTEGER) AS day, "
           + ", ".join(f"avg(CASE WHEN event_type = '{t}' THEN value END) AS m_{t}" for t in B.EV_TYPES)
           + f" FROM events WHERE event_type IN ({_in(B.EV_TYPES)}) AND day(ts) BETWEEN {PLO} AND {PHI} GROUP BY 1, 2)")
Q["panel_assembly"] = _r(
    f"WITH {EV_PIPE} SELECT user_id, c_name AS name, day, {', '.join(MET)} FROM evp "
    "JOIN customer ON c_custkey = user_id AND c_mktsegment <> 'HOUSEHOLD'", *MET)

_types_order = ", ".join(f"('{t}', {i})" for i, t in enumerate(B.EV_TYPES))
BA = (
    f"WITH {EV}, ks AS (SELECT count(*) AS s FROM ev GROUP BY user_id, day), "
    f"tord(t, ord) AS (VALUES {_types_order}), "
    "raw AS (SELECT event_type AS label, count(*) AS rows, "
    f"count(*) FILTER (WHERE value < {LO} OR value > {HI}) AS oob, count(DISTINCT user_id) AS entities, "
    "count(*) - count(DISTINCT (event_id, user_id, day(ts), value)) AS dups "
    f"FROM events WHERE event_type IN ({_in(B.EV_TYPES)}) GROUP BY event_type), "
    "rawo AS (SELECT raw.*, ord FROM raw JOIN tord ON label = t), "
    "r AS (SELECT count(*) AS schemas, CAST(4 * count(*) AS BIGINT) AS raw_total_columns, "
    "CAST(sum(rows) AS BIGINT) AS raw_rows, count(*) AS sources_with_code, CAST(0 AS BIGINT) AS sources_without_code, "
    "CAST(sum(dups) AS BIGINT) AS raw_duplicates, CAST(sum(oob) AS BIGINT) AS raw_out_of_bounds, "
    "arg_max(label, (rows, -ord)) AS best_source, arg_max(rows, (rows, -ord)) AS best_source_rows, "
    "arg_max(entities, (rows, -ord)) AS best_source_entities FROM rawo), "
    f"f AS ({FINAL}), "
    "ba AS (SELECT schemas, raw_total_columns, raw_rows, f.rows AS final_rows, f.columns AS final_columns, "
    "CASE WHEN raw_rows > 0 THEN (1 - f.rows * 1.0 / raw_rows) * 100 ELSE 0.0 END AS record_compression_pct, "
    "sources_with_code, sources_without_code, raw_duplicates, f.duplicate_keys AS final_duplicate_keys, "
    "raw_out_of_bounds, f.out_of_bounds AS final_out_of_bounds, best_source, best_source_rows, best_source_entities, "
    "CASE WHEN best_source_rows > 0 THEN (f.rows - best_source_rows) * 100.0 / best_source_rows ELSE 0.0 END AS row_gain_pct, "
    "f.entities - best_source_entities AS entity_gain, f.entities AS final_entities, f.code_fill_pct, "
    "f.min_period, f.max_period FROM r, f)")
Q["before_after"] = _r(f"{BA} SELECT * FROM ba", "record_compression_pct", "row_gain_pct", "code_fill_pct")
Q["value_scorecard"] = _r(
    f"{BA}, lines AS ("
    "SELECT 'schema_consolidation' AS dimension, 1 AS ordinal, COALESCE(schemas > 1 AND final_columns > 0, false) AS passed FROM ba "
    "UNION ALL SELECT 'entity_resolution', 2, COALESCE(code_fill_pct = 100.0, false) FROM ba "
    "UNION ALL SELECT 'duplicate_elimination', 3, COALESCE(final_duplicate_keys = 0, false) FROM ba "
    "UNION ALL SELECT 'record_integration', 4, COALESCE(final_rows > 0 AND final_rows <= raw_rows, false) FROM ba "
    f"UNION ALL SELECT 'coverage_amplification', 5, COALESCE(final_entities > {B.EV_MIN_ENTITIES}, false) FROM ba "
    "UNION ALL SELECT 'validity_enforcement', 6, COALESCE(final_out_of_bounds = 0, false) FROM ba), "
    "s AS (SELECT count(*) FILTER (WHERE passed) * 100.0 / count(*) AS score_pct FROM lines) "
    "SELECT dimension, ordinal, passed, score_pct, CASE WHEN score_pct >= 90 THEN 'A' WHEN score_pct >= 75 THEN 'B' "
    "WHEN score_pct >= 60 THEN 'C' ELSE 'D' END AS grade FROM lines, s", "score_pct")

# ------------------------------------------------------------------ RV / RVY
RV = ("rv AS (SELECT COALESCE(o.o_orderkey, n.l_orderkey) AS o_orderkey, o.o_custkey, "
      "CAST(year(o.o_orderdate) AS INTEGER) AS year, o.o_totalprice AS total, n.net FROM orders o FULL OUTER JOIN "
      "(SELECT l_orderkey, sum(l_extendedprice * (1 - l_discount)) AS net FROM lineitem GROUP BY 1) n "
      "ON o.o_orderkey = n.l_orderkey)")
RVN = RV + ", rvn AS (SELECT rv.*, c_nationkey AS nation FROM rv LEFT JOIN customer ON c_custkey = o_custkey)"
Q["hale_consistency"] = (
    f"WITH {RV} SELECT count(*) FILTER (WHERE net IS NOT NULL AND total IS NOT NULL) AS overlapping_rows, "
    "count(*) FILTER (WHERE net IS NOT NULL AND total IS NOT NULL AND NOT net > total) AS consistent_rows, "
    "count(*) FILTER (WHERE net > total) AS violations FROM rv")
Q["hale_violations"] = _r(
    f"WITH {RV} SELECT o_orderkey, net, total, net - total AS excess FROM rv WHERE net > total "
    "ORDER BY o_orderkey LIMIT 5", "net", "total", "excess")
Q["gap_stats"] = _r(
    f"WITH {RV}, g AS (SELECT total - net AS g FROM rv WHERE total IS NOT NULL AND net IS NOT NULL) "
    "SELECT count(*) AS n, avg(g) AS mean, median(g) AS median, stddev_samp(g) AS std, min(g) AS min, max(g) AS max FROM g",
    "mean", "median", "std", "min", "max")
Q["health_gap_rows"] = _r(
    f"WITH {RV} SELECT o_orderkey, total - net AS gap FROM rv WHERE total IS NOT NULL AND net IS NOT NULL", "gap")
Q["gap_violations"] = _r(
    f"WITH {RV} SELECT o_orderkey, total, net, total - net AS gap FROM rv "
    "WHERE total IS NOT NULL AND net IS NOT NULL AND total - net < 0", "total", "net", "gap")
Q["violation_summary"] = _r(
    f"WITH {RV}, v AS (SELECT o_custkey, year, total - net AS gap FROM rv "
    "WHERE total IS NOT NULL AND net IS NOT NULL AND total - net < 0) "
    "SELECT count(*) AS violations, count(DISTINCT o_custkey) AS entities, min(year) AS min_period, "
    "max(year) AS max_period, avg(gap) AS mean_gap FROM v", "mean_gap")
Q["health_gap_ranking"] = _r(
    f"WITH {RVN}, c AS (SELECT * FROM rvn WHERE total IS NOT NULL AND net IS NOT NULL), "
    f"y AS (SELECT COALESCE(max(year) FILTER (WHERE year = {B.RV_WANT_YEAR}), max(year)) AS y FROM c), "
    "t AS (SELECT o_orderkey, year, total, net FROM c, y WHERE year = y.y ORDER BY total DESC, o_orderkey LIMIT 15) "
    "SELECT o_orderkey, year, total, net, total - net AS gap FROM t", "total", "net", "gap")
Q["period_fallback"] = _r(
    f"WITH {RVN}, c AS (SELECT * FROM rvn WHERE total IS NOT NULL AND net IS NOT NULL), "
    f"y AS (SELECT COALESCE(max(year) FILTER (WHERE year = {B.RV_MISSING_YEAR}), max(year)) AS y FROM c) "
    "SELECT o_orderkey, year, total, net FROM c, y WHERE year = y.y", "total", "net")
Q["top_mean_gap"] = _r(
    f"WITH {RVN} SELECT nation, avg(total - net) AS mean_gap, count(*) AS rows FROM rvn "
    "WHERE total IS NOT NULL AND net IS NOT NULL GROUP BY nation ORDER BY mean_gap DESC, nation LIMIT 10", "mean_gap")
DEC = (f"WITH {RVN}, v AS (SELECT o_orderkey, CAST(floor(year / 10) * 10 AS INTEGER) AS decade, net FROM rvn "
       "WHERE net IS NOT NULL), "
       "q AS (SELECT decade, quantile_cont(net, 0.25) AS q1, quantile_cont(net, 0.5) AS median, "
       "quantile_cont(net, 0.75) AS q3 FROM v GROUP BY decade), "
       "j AS (SELECT v.*, q1, median, q3, q1 - 1.5 * (q3 - q1) AS flo, q3 + 1.5 * (q3 - q1) AS fhi FROM v JOIN q USING (decade))")
Q["decade_distribution"] = _r(
    f"{DEC} SELECT decade, count(*) AS n, q1, median, q3, min(net) FILTER (WHERE net BETWEEN flo AND fhi) AS whisker_lo, "
    "max(net) FILTER (WHERE net BETWEEN flo AND fhi) AS whisker_hi, "
    "count(*) FILTER (WHERE NOT net BETWEEN flo AND fhi) AS outliers, (SELECT avg(net) FROM v) AS overall_mean "
    "FROM j GROUP BY decade, q1, median, q3", "q1", "median", "q3", "whisker_lo", "whisker_hi", "overall_mean")
Q["decade_outliers"] = _r(f"{DEC} SELECT o_orderkey, decade, net FROM j WHERE net < flo OR net > fhi", "net")

# ------------------------------------------------------------------ LI
LIK = "l_orderkey, l_linenumber"
Q["key_uniqueness"] = (
    f"WITH s AS (SELECT count(*) AS s FROM lineitem GROUP BY {LIK}) "
    "SELECT count(*) AS distinct_keys, CAST(COALESCE(sum(s), 0) AS BIGINT) AS rows, max(s) AS max_rows_per_key, "
    "count(*) FILTER (WHERE s > 1) AS repeated_keys, CAST(COALESCE(sum(s - 1), 0) AS BIGINT) AS duplicate_keys FROM s")
Q["duplicate_rows"] = _r(
    f"WITH s AS (SELECT count(*) AS s FROM lineitem GROUP BY {LIK}) "
    "SELECT CAST(sum(s) AS BIGINT) AS rows, CAST(sum(s - 1) AS BIGINT) AS duplicate_rows, "
    "sum(s - 1) * 100.0 / sum(s) AS duplicate_pct FROM s", "duplicate_pct")
Q["dedup_mean"] = _r(f"SELECT {LIK}, avg(l_quantity) AS l_quantity FROM lineitem GROUP BY {LIK}", "l_quantity")
Q["dedup_first"] = _r(
    f"SELECT {LIK}, l_partkey, l_quantity, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY {LIK} "
    f"ORDER BY {', '.join(B.LI_ORDER)}) AS rn FROM lineitem) WHERE rn = 1", "l_quantity", "l_extendedprice")

# ------------------------------------------------------------------ NM
PFX = B.NM_AGGREGATE_PREFIX
NMAP = (f"nmap AS (SELECT p_name AS name, arg_min(p_brand, p_partkey) AS code FROM part "
        f"WHERE p_brand IS NOT NULL AND NOT starts_with(p_brand, '{PFX}') AND p_name IS NOT NULL GROUP BY p_name)")
CORR = ("CASE trim(p_name) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in B.NM_CORRECTIONS.items())
        + " ELSE trim(p_name) END")
RES = f"res AS (SELECT p_partkey, {CORR} AS name FROM part), rn AS (SELECT p_partkey, res.name, code FROM res LEFT JOIN nmap ON res.name = nmap.name)"
SLO, SHI = B.NM_SIZE_RANGE
CMAP = (f"cmap AS (SELECT p_brand AS code, arg_min(p_name, p_partkey) AS cname FROM part WHERE p_size BETWEEN {SLO} AND {SHI} "
        f"AND p_brand IS NOT NULL AND NOT starts_with(p_brand, '{PFX}') GROUP BY p_brand)")
LAB = f"{CMAP}, lab AS (SELECT p_partkey, p_brand AS code, cname AS name FROM part JOIN cmap ON p_brand = cmap.code)"
Q["name_map"] = f"WITH {NMAP} SELECT name, code FROM nmap"
Q["exclude_prefix"] = (
    f"WITH c AS (SELECT count(*) AS c0, count(*) FILTER (WHERE p_brand IS NULL OR NOT starts_with(p_brand, '{PFX}')) AS c1 FROM part) "
    "SELECT 'input' AS step, 0 AS ordinal, c0 AS rows, CAST(0 AS BIGINT) AS removed FROM c "
    "UNION ALL SELECT 'exclude_prefix', 1, c1, c0 - c1 FROM c")
Q["name_corrections"] = f"SELECT p_partkey, p_name AS name_raw, {CORR} AS name FROM part"
Q["correction_stats"] = (f"SELECT count(*) FILTER (WHERE trim(p_name) IN ({_in(B.NM_CORRECTIONS)})) AS rows_corrected, "
                         "count(*) AS rows_total FROM part")
_rules = ", ".join(f"('{k}', '{v}')" for k, v in B.NM_CORRECTIONS.items())
Q["correction_rule_check"] = (f"WITH {NMAP}, r(variant, canonical) AS (VALUES {_rules}) "
                              "SELECT variant, canonical FROM r WHERE canonical NOT IN (SELECT name FROM nmap)")
Q["resolve_names"] = f"WITH {NMAP}, {RES} SELECT * FROM rn"
_few = (f"nmap AS (SELECT p_name AS name, arg_min(p_brand, p_partkey) AS code FROM part WHERE NOT starts_with(p_brand, '{PFX}') "
        f"AND p_brand NOT IN ({_in(B.NM_SILENT)}) AND p_size <= 3 AND p_name IS NOT NULL GROUP BY p_name)")
Q["unresolved_names"] = (
    f"WITH {_few}, {RES}, m AS (SELECT * FROM rn WHERE code IS NULL) "
    "SELECT name, min(p_partkey) AS first_seen, count(*) AS rows, (SELECT count(*) FROM m) AS unresolved_rows "
    "FROM m GROUP BY name")
Q["canonical_labels"] = (f"WITH {CMAP} SELECT p_partkey, p_brand AS code, cname AS name FROM part "
                         "LEFT JOIN cmap ON p_brand = cmap.code")
Q["drop_aggregates"] = (
    f"WITH {LAB} SELECT (SELECT count(*) FROM part) AS rows_in, "
    "(SELECT count(*) FROM part WHERE p_brand IS NULL OR p_brand NOT IN (SELECT code FROM cmap)) AS rows_dropped, "
    "(SELECT count(*) FROM lab) AS rows_out")
_ov = ", ".join(f"('{k}', '{v}')" for k, v in B.NM_OVERRIDES.items())
Q["label_overrides"] = (
    f"WITH {LAB}, r(code, label) AS (VALUES {_ov}), c AS (SELECT code, count(*) AS n FROM lab GROUP BY code) "
    "SELECT r.code, r.label, CAST(COALESCE(c.n, 0) AS BIGINT) AS rows_touched, "
    "CASE WHEN COALESCE(c.n, 0) > 0 THEN 'applied' ELSE 'not found' END AS status FROM r LEFT JOIN c ON r.code = c.code")
Q["override_check"] = (
    f"WITH {LAB}, r(code, label) AS (VALUES {_ov}), "
    "o AS (SELECT lab.code, COALESCE(r.label, lab.name) AS name FROM lab LEFT JOIN r ON lab.code = r.code) "
    "SELECT code, array_to_string(list_sort(list_distinct(list(name))), '|') AS labels FROM o "
    f"WHERE code IN ({_in(B.NM_OVERRIDES)}) GROUP BY code")

# ------------------------------------------------------------------ LB
Q["drop_null_keys"] = ("SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l "
                       "ON d.doc_id = l.doc_id WHERE l.quality IS NOT NULL")
Q["coerce_numeric"] = _r(
    "WITH e AS (SELECT event_id, json_extract_string(props, '$.k') AS k FROM events), t AS (SELECT event_id, CASE event_id % 12 "
    "WHEN 1 THEN k || 'd' WHEN 2 THEN k || 'f' WHEN 3 THEN '0x' || k WHEN 4 THEN '  ' WHEN 5 THEN 'NaN' WHEN 6 THEN ' -' || k || '.5 ' "
    "WHEN 7 THEN k || 'e-2' WHEN 8 THEN k || ',0' ELSE k END AS k FROM e) "
    "SELECT event_id, CASE WHEN regexp_full_match(trim(k), '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?') "
    "THEN TRY_CAST(trim(k) AS DOUBLE) END AS k FROM t", "k")

# ------------------------------------------------------------------ single tables
Q["scan_pruned"] = "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem"
Q["sample_head"] = ("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders "
                    "ORDER BY o_orderkey LIMIT 1000")
Q["rename_project"] = ("SELECT o_custkey AS entity, CAST(year(o_orderdate) AS INTEGER) AS period, "
                       "o_totalprice AS value, o_orderkey AS row_id FROM orders")
_ylo, _yhi = B.RV_PERIOD_RANGE
Q["period_filter"] = (f"SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders "
                      f"WHERE year(o_orderdate) BETWEEN {_ylo} AND {_yhi}")
Q["filter_eq"] = "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'"
Q["cascade_filter"] = (
    "WITH r AS (SELECT o_orderkey, o_orderstatus, CASE o_orderstatus WHEN 'X' THEN 0 WHEN 'P' THEN 1 WHEN 'F' THEN 2 END AS k "
    "FROM orders), b AS (SELECT min(k) AS b FROM r) "
    "SELECT o_orderkey, o_orderstatus FROM r, b WHERE b.b IS NULL OR k = b.b")
Q["clean_lineage"] = (
    "WITH c AS (SELECT count(*) AS c0, count(*) FILTER (WHERE o_custkey IS NOT NULL) AS c1, "
    "count(*) FILTER (WHERE o_custkey IS NOT NULL AND NOT starts_with(o_orderpriority, '5-')) AS c2, "
    "count(*) FILTER (WHERE o_custkey IS NOT NULL AND NOT starts_with(o_orderpriority, '5-') "
    f"AND year(o_orderdate) BETWEEN {_ylo} AND {_yhi}) AS c3 FROM orders) "
    "SELECT 'input' AS step, 0 AS ordinal, c0 AS rows, CAST(0 AS BIGINT) AS removed FROM c "
    "UNION ALL SELECT 'drop_null', 1, c1, c0 - c1 FROM c UNION ALL SELECT 'exclude_prefix', 2, c2, c1 - c2 FROM c "
    "UNION ALL SELECT 'period_filter', 3, c3, c2 - c3 FROM c")
_cust = [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "double"),
         ("c_mktsegment", "string")]
Q["column_profile"] = _r(
    "WITH s AS (SELECT * FROM customer) " + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {i} AS ordinal, '{t}' AS dtype, count({c}) * 100.0 / count(*) AS non_null_pct, "
        f"COALESCE((SELECT CASE WHEN length(CAST({c} AS VARCHAR)) > 28 THEN substr(CAST({c} AS VARCHAR), 1, 25) || '...' "
        f"ELSE CAST({c} AS VARCHAR) END FROM s WHERE {c} IS NOT NULL ORDER BY c_custkey LIMIT 1), 'N/A') AS sample FROM s"
        for i, (c, t) in enumerate(_cust)), "non_null_pct")


def _kw(col: str, kws) -> str:
    return "(" + " OR ".join(f"lower({col}) LIKE '%{k}%'" for k in kws) + ")"


from panelmerge.plans.reports import ENTITY_KEYWORDS, PERIOD_KEYWORDS  # noqa: E402

# candidate columns are found from the catalog; their measurements come from the data
_MK_STATS = (("orders", "o_orderdate"), ("lineitem", "l_shipdate"))
Q["merge_keys"] = (
    f"WITH c AS (SELECT table_name, column_name FROM information_schema.columns WHERE table_name IN ({_in(B.MERGE_KEY_TABLES)})), "
    "iso AS (SELECT table_name, bool_or(lower(column_name) LIKE '%iso%') AS has_iso FROM c GROUP BY table_name), "
    f"k AS (SELECT table_name, column_name, 'entity' AS role, has_iso FROM c JOIN iso USING (table_name) WHERE {_kw('column_name', ENTITY_KEYWORDS)} "
    f"UNION ALL SELECT table_name, column_name, 'period', has_iso FROM c JOIN iso USING (table_name) WHERE {_kw('column_name', PERIOD_KEYWORDS)}), "
    "s AS (" + " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, count({c}) AS present, count(DISTINCT {c}) AS distinct_values FROM {t}"
        for t, c in _MK_STATS) + ") "
    "SELECT iso.table_name, k.column_name, role, iso.has_iso, COALESCE(present, 0) AS present, COALESCE(distinct_values, 0) AS distinct_values FROM iso LEFT JOIN k ON iso.table_name = k.table_name "
    "LEFT JOIN s ON k.table_name = s.table_name AND k.column_name = s.column_name")

SP_LO, SP_HI = 0.0, 100000.0
Q["source_profile"] = _r(
    "WITH o AS (SELECT o_orderkey, o_custkey, year(o_orderdate) AS o_year, o_totalprice, o_orderstatus FROM orders), "
    "od AS (SELECT count(*) AS s FROM o GROUP BY o_orderkey, o_custkey, o_year, o_totalprice, o_orderstatus), "
    "l AS (SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem), ld AS (SELECT count(*) AS s FROM l GROUP BY l_orderkey, l_linenumber, l_quantity), "
    "cd AS (SELECT count(*) AS s FROM customer GROUP BY c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment) "
    "SELECT 'orders' AS label, 0 AS ordinal, count(*) AS rows, 5 AS columns, true AS has_code, "
    "count(o_custkey) * 100.0 / count(*) AS code_fill_pct, count(o_totalprice) * 100.0 / count(*) AS metric_fill_pct, "
    "CAST(min(o_totalprice) AS DOUBLE) AS metric_min, CAST(max(o_totalprice) AS DOUBLE) AS metric_max, "
    f"count(*) FILTER (WHERE o_totalprice < {SP_LO} OR o_totalprice > {SP_HI}) AS out_of_bounds, "
    "count(o_year) * 100.0 / count(*) AS period_fill_pct, CAST(min(o_year) AS DOUBLE) AS period_min, "
    "CAST(max(o_year) AS DOUBLE) AS period_max, (SELECT CAST(sum(s - 1) AS BIGINT) FROM od) AS duplicate_rows, "
    "(SELECT sum(s - 1) * 100.0 / sum(s) FROM od) AS duplicate_pct, count(DISTINCT o_custkey) AS entities, '' AS load_error FROM o "
    "UNION ALL SELECT 'lineitem keys', 1, count(*), 3, false, 0.0, count(l_quantity) * 100.0 / count(*), "
    f"min(l_quantity), max(l_quantity), count(*) FILTER (WHERE l_quantity < {SP_LO} OR l_quantity > {SP_HI}), 0.0, NULL, NULL, "
    "(SELECT CAST(sum(s - 1) AS BIGINT) FROM ld), (SELECT sum(s - 1) * 100.0 / sum(s) FROM ld), 0, '' FROM l "
    "UNION ALL SELECT 'customer', 2, count(*), 5, true, count(c_nationkey) * 100.0 / count(*), "
    f"count(c_acctbal) * 100.0 / count(*), min(c_acctbal), max(c_acctbal), count(*) FILTER (WHERE c_acctbal < {SP_LO} OR c_acctbal > {SP_HI}), "
    "0.0, NULL, NULL, (SELECT CAST(sum(s - 1) AS BIGINT) FROM cd), (SELECT sum(s - 1) * 100.0 / sum(s) FROM cd), "
    "count(DISTINCT c_name), '' FROM customer "
    "UNION ALL SELECT 'missing', 3, 0, 0, false, 0.0, 0.0, NULL, NULL, 0, 0.0, NULL, NULL, 0, 0.0, 0, 'File not found'",
    "code_fill_pct", "metric_fill_pct", "metric_min", "metric_max", "period_fill_pct", "period_min", "period_max",
    "duplicate_pct")
Q["positional_clean"] = _r(
    "SELECT 'ALL' AS iso3, CAST(year(o_orderdate) AS INTEGER) AS year, arg_min(o_totalprice, o_orderkey) AS value "
    "FROM orders WHERE year(o_orderdate) BETWEEN 1950 AND 2024 GROUP BY 2", "value")
Q["payload_flatten"] = _r(
    f"SELECT CASE WHEN n_regionkey = {B.PAYLOAD_EMPTY_CODE_REGION} THEN NULL "
    "ELSE 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') END AS iso3, "
    "n_name AS country_name, CAST(2000 + n_regionkey AS INTEGER) AS year, n_nationkey * 1.5 + 40 AS value "
    f"FROM nation WHERE n_regionkey <> {B.PAYLOAD_NULL_VALUE_REGION}", "value")

Q["payload_variant"] = _r(
    "SELECT 'O' || o_orderkey AS iso3, o_orderstatus AS country_name, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(o_custkey AS DOUBLE) AS value, "
    "'{\"status\":\"' || o_orderstatus || '\"}' AS extra FROM orders WHERE o_orderstatus <> 'P'", "value")
Q["payload_schema"] = "SELECT count(*) AS records, CAST(7 AS INTEGER) AS marks, CAST(7 AS INTEGER) AS line_marks FROM orders"

# ------------------------------------------------------------------ files written and read back
# An empty field of a CSV file is null.
Q["csv_scan"] = "SELECT doc_id, lang, source, md5(text) AS text_md5 FROM documents"
Q["csv_latin1_scan"] = ("SELECT doc_id, lang, source, md5(nullif(regexp_replace(text, '[^\\x0A\\x20-\\x7E\\x{00A1}-\\x{00FF}]', '', 'g'), '')) AS text_md5 "
                        "FROM documents")
Q["missing_source"] = _r("SELECT o_orderkey, o_totalprice AS total, 'there' AS sources FROM orders "
                         "UNION ALL SELECT DISTINCT l_orderkey, NULL, 'there' FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)", "total")
Q["sink_csv"] = Q["sink_parquet"] = Q["sink_json"] = Q["panel_merge_union"]
Q["clustered_store"] = _r(
    "SELECT l_orderkey, CAST(year(l_shipdate) AS INTEGER) AS year, count(*) AS rows, "
    "sum(CASE WHEN year(l_shipdate) >= 1997 THEN 2 ELSE 1 END * l_quantity) AS quantity FROM lineitem GROUP BY 1, 2", "quantity")
Q["panel_subtotals"] = _r(
    "WITH n AS (SELECT l_orderkey, sum(l_extendedprice * (1 - l_discount)) AS net FROM lineitem GROUP BY 1), "
    "p AS (SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, o_totalprice AS total, net, c_nationkey AS nation "
    "FROM orders FULL JOIN n ON o_orderkey = l_orderkey LEFT JOIN customer ON o_custkey = c_custkey) "
    "SELECT CASE WHEN grouping(year) = 0 AND grouping(nation) = 0 THEN 'year,nation' WHEN grouping(year) = 0 THEN 'year' "
    "WHEN grouping(nation) = 0 THEN 'nation' ELSE '' END AS level, coalesce(CAST(year AS VARCHAR), 'all') AS year, "
    "coalesce(CAST(nation AS VARCHAR), 'all') AS nation, count(*) AS rows, count(DISTINCT o_custkey) AS entities, "
    "count(total) AS total_filled, round(sum(total), 4) AS total_sum, count(net) AS net_filled, round(sum(net), 4) AS net_sum "
    "FROM p GROUP BY GROUPING SETS ((year, nation), (year), (nation), ())", "total_sum", "net_sum")
_second = (f"SELECT user_id, CAST(day(ts) AS INTEGER) AS day, event_type, value + CAST(event_type = 'click' AND user_id = {B.RELEASE_USER} AS INTEGER) AS value "
           f"FROM events WHERE event_type IN ({_in(B.EV_TYPES)}) AND NOT (event_type = 'error' AND day(ts) = {B.RELEASE_DAY})")
Q["release_merge"] = _r(
    "SELECT user_id, day, " + ", ".join(f"avg(CASE WHEN event_type = '{t}' THEN value END) AS m_{t}" for t in B.EV_TYPES)
    + f" FROM ({_second}) x WHERE user_id IS NOT NULL AND day IS NOT NULL GROUP BY 1, 2", *MET)
Q["asof_join"] = _r(
    "WITH v AS (SELECT user_id, ts, max(value) AS value FROM events WHERE event_type = 'view' GROUP BY 1, 2) "
    "SELECT e.event_id, e.user_id, CAST(epoch_us(v.ts) AS VARCHAR) AS view_micros, v.value AS view_value FROM (SELECT * FROM events WHERE event_type = 'purchase') e "
    "ASOF LEFT JOIN v ON e.user_id = v.user_id AND e.ts >= v.ts", "view_value")
Q["carry_last"] = _r(
    f"WITH {EV} SELECT user_id, day, " + ", ".join(
        f"last_value({m} IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY day ROWS UNBOUNDED PRECEDING) AS {m}" for m in MET) + " FROM ev", *MET)
Q["stream_revisions"] = _r(
    "WITH d AS (SELECT date_trunc('day', ts) AS d, * FROM events), passed AS (SELECT max(ts) - INTERVAL 7 DAY AS w FROM events) "
    "SELECT strftime(d, '%Y-%m-%d') AS day, user_id, event_type, epoch_us(max(ts)) AS revised, max(struct_pack(ts := ts, value := value)).value AS value "
    "FROM d WHERE user_id IS NOT NULL AND event_type IS NOT NULL AND d + INTERVAL 1 DAY <= (SELECT w FROM passed) GROUP BY d, user_id, event_type", "value")
Q["sketch_report"] = _r(
    "SELECT event_type, count(*) AS rows, count(value) AS filled, avg(value) AS mean, min(value) AS min, max(value) AS max, "
    "true AS users_close, true AS ranks_close FROM events GROUP BY event_type", "mean", "min", "max")
Q["interval_join"] = (
    "WITH s AS (SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS since, CASE WHEN o_orderkey % 97 <> 0 "
    "THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 400 AS INTEGER) END AS until FROM orders), "
    "p AS (SELECT o_orderkey, l_linenumber, o_custkey, CAST(l_shipdate AS DATE) AS shipped FROM lineitem JOIN orders ON l_orderkey = o_orderkey) "
    "SELECT s.o_orderkey AS open_orderkey, count(*) AS lines, CAST(sum(p.o_orderkey * 10 + l_linenumber) AS BIGINT) AS marks "
    "FROM p JOIN s ON p.o_custkey = s.o_custkey AND since <= shipped AND (until IS NULL OR shipped < until) GROUP BY 1")
Q["name_proposals"] = (
    "WITH lost AS (SELECT DISTINCT substr(p_name, 1, p_partkey % length(p_name)) || substr(p_name, p_partkey % length(p_name) + 2) AS name FROM part), "
    f"f AS (SELECT p_name, min(p_partkey) AS k FROM part WHERE NOT starts_with(p_brand, '{PFX}') GROUP BY p_name), "
    "known AS (SELECT f.p_name AS candidate, p_brand AS code FROM f JOIN part ON p_partkey = k) "
    "SELECT name, candidate, code, CAST(levenshtein(name, candidate) AS INTEGER) AS distance FROM lost, known WHERE levenshtein(name, candidate) <= 2")

# ------------------------------------------------------------------ the six cleaners and their pipeline
CLO, CHI = B.CLEAN_PERIOD
_yr = f"BETWEEN {CLO} AND {CHI}"
Q["clean_owid"] = _r(
    f"SELECT p_brand AS iso3, CAST(p_size + 1950 AS INTEGER) AS year, trim(p_name) AS country_name, p_retailprice AS life_exp_owid FROM part "
    f"WHERE NOT starts_with(p_brand, '{PFX}') AND p_size + 1950 {_yr}", "life_exp_owid")
Q["clean_world_bank"] = _r(
    "SELECT CAST(o_custkey AS VARCHAR) AS iso3, CAST(year(o_orderdate) AS INTEGER) AS year, "
    "CASE WHEN o_orderkey % 10 <> 0 THEN o_totalprice END AS life_exp_wb FROM orders", "life_exp_wb")
_kag = (f"kg AS (SELECT p_partkey, {CORR} AS name, CAST(p_size + 1950 AS INTEGER) AS year, "
        "CASE WHEN p_partkey % 7 <> 0 THEN p_retailprice END AS v FROM part)")
Q["clean_kaggle"] = _r(
    f"WITH {NMAP}, {_kag} SELECT code AS iso3, year, v AS life_exp_kaggle FROM kg JOIN nmap ON kg.name = nmap.name WHERE year {_yr}", "life_exp_kaggle")
Q["clean_unicef"] = _r(
    "SELECT CAST(l_suppkey AS VARCHAR) AS iso3, CAST(year(l_shipdate) AS INTEGER) AS year, avg(l_quantity) AS life_exp_unicef FROM lineitem "
    "WHERE l_returnflag = 'N' AND l_linenumber <> 4 GROUP BY ALL", "life_exp_unicef")
Q["clean_who"] = _r(
    f"WITH {NMAP}, w AS (SELECT p_partkey, code, CAST(p_size + 1950 AS INTEGER) AS year, p_retailprice AS v FROM "
    f"(SELECT p_partkey, {CORR} AS name, p_size, p_retailprice FROM part WHERE p_partkey % 3 <> 0 AND p_partkey % 2 = 0 AND p_partkey % 10 <> 4) x "
    "JOIN nmap ON x.name = nmap.name) "
    f"SELECT code AS iso3, year, arg_min(v, p_partkey) AS hale_who FROM w WHERE year {_yr} GROUP BY code, year", "hale_who")
Q["clean_cdc"] = _r(
    "SELECT 'USA' AS iso3, CAST(year(o_orderdate) AS INTEGER) AS year, arg_min(o_totalprice, o_orderkey) AS life_exp_us_cdc FROM orders GROUP BY ALL",
    "life_exp_us_cdc")
_over = "CASE iso3 " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in B.NM_OVERRIDES.items()) + " ELSE cname END"
Q["panel_pipeline"] = _r(
    f"WITH {NMAP}, {_kag}, a AS (SELECT p_brand AS iso3, CAST(p_size + 1950 AS INTEGER) AS year, trim(p_name) AS nm, p_retailprice AS v, p_partkey FROM part "
    f"WHERE NOT starts_with(p_brand, '{PFX}') AND p_size + 1950 {_yr}), "
    "c AS (SELECT iso3 AS code, arg_min(nm, p_partkey) AS cname FROM a GROUP BY iso3), "
    "s1 AS (SELECT iso3, year, avg(v) AS life_exp_owid FROM a GROUP BY ALL), "
    f"s2 AS (SELECT code AS iso3, year, avg(v) AS life_exp_kaggle FROM kg JOIN nmap ON kg.name = nmap.name WHERE year {_yr} GROUP BY ALL), "
    f"s3 AS (SELECT 'Brand#' || CAST(p_size AS VARCHAR) AS iso3, CAST(p_size + 1955 AS INTEGER) AS year, avg(p_retailprice) AS life_exp_wb FROM part WHERE p_size + 1955 {_yr} GROUP BY ALL) "
    f"SELECT iso3, {_over} AS country_name, year, life_exp_owid, life_exp_wb, life_exp_kaggle "
    "FROM s1 FULL JOIN s2 USING (iso3, year) FULL JOIN s3 USING (iso3, year) JOIN c ON iso3 = c.code",
    "life_exp_owid", "life_exp_wb", "life_exp_kaggle")
Q["stored_pipeline"] = Q["panel_pipeline"]


def _lineage(source: str, rows: str, steps) -> str:
    """Rows that pass each condition on top of those before it, and how many it takes away."""
    names = ["input"] + [n for n, _ in steps]
    conds = ["true"] + [" AND ".join(f"coalesce({c}, false)" for _, c in steps[:i + 1]) for i in range(len(steps))]
    return " UNION ALL ".join(
        f"SELECT '{source}' AS source, '{n}' AS step, CAST({i} AS INTEGER) AS ordinal, count(*) FILTER (WHERE {conds[i]}) AS rows, "
        f"count(*) FILTER (WHERE {conds[max(i - 1, 0)]}) - count(*) FILTER (WHERE {conds[i]}) AS removed FROM {rows}" for i, n in enumerate(names))


_known = f"(SELECT kg.*, code FROM kg LEFT JOIN nmap ON kg.name = nmap.name)"
Q["observed_lineage"] = f"WITH {NMAP}, {_kag} " + " UNION ALL ".join((
    _lineage("OWID", "part", [("code_present", "p_brand IS NOT NULL"), ("not_aggregate", f"NOT starts_with(p_brand, '{PFX}')"),
                              ("in_period", f"p_size + 1950 {_yr}")]),
    _lineage("World Bank", "part", [("code_present", "p_size IS NOT NULL"), ("in_period", f"p_size + 1955 {_yr}")]),
    _lineage("Kaggle", _known, [("code_present", "code IS NOT NULL"), ("in_period", f"year {_yr}")])))
Q["observed_facts"] = _r(f"WITH {EV} " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST({i} AS INTEGER) AS ordinal, count(*) AS rows, count({c}) AS filled, count({c}) * 100.0 / count(*) AS fill_pct, "
    + (f"min({c}) AS min, max({c}) AS max, CAST(count(*) FILTER (WHERE {c} < {LO} OR {c} > {HI}) AS VARCHAR) AS out_of_bounds" if c in MET
       else "NULL AS min, NULL AS max, NULL AS out_of_bounds") + " FROM ev" for i, c in enumerate(_fill_cols)), "fill_pct", "min", "max")
Q["type_report"] = (f"WITH {EV} SELECT 'm_click' AS \"column\", 'double' AS type, true AS is_numeric, count(m_click) AS present FROM ev "
                    "UNION ALL SELECT 'm_view', 'double', true, count(m_view) FROM ev UNION ALL SELECT 'user_id', 'bigint', true, count(user_id) FROM ev")
Q["sorted_extract"] = "SELECT c_nationkey AS nation, c_custkey AS entity, c_acctbal AS value FROM customer"


def oracle_sql() -> dict[str, str]:
    return dict(Q)
