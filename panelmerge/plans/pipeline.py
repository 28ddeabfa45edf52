"""Spec-driven cleaning of each source and assembly of the panel.

One generic cleaner driven by :class:`SourceSpec` replaces six hand-written
functions; the life-expectancy panel is one configuration of it
(``panelmerge.configs.life_expectancy``).
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelmerge.functions.nulls import to_number
from panelmerge.operators import clean, entities, merge
from panelmerge.plans.observed import cleaning_steps, lineage_frame, store_steps
from panelmerge.session import ensure_checkpoint_dir
from panelmerge.sources.payload import flatten_payload, read_payloads
from panelmerge.sources.positional import clean_positional, read_positional
from panelmerge.sources.readers import ROW, read_source
from panelmerge.spec import SourceSpec

CODE, NAME, PERIOD = "iso3", "country_name", "year"


def load_source(spark: SparkSession, spec: SourceSpec) -> DataFrame | None:
    """The raw rows of a source with their place in the file (``__row``).

    Spark resolves the path. A missing file is an error unless the source is
    ``optional``; then the result is None. Nothing else is tolerated.
    """
    try:
        if spec.fmt == "positional":
            return read_positional(spark, spec.path, skip=spec.positional[0])
        if spec.fmt == "json-payload":
            payload = flatten_payload(read_payloads(spark, spec.path)).withColumnRenamed("value", spec.raw_metric or "value")
            return payload.withColumn(ROW, F.monotonically_increasing_id())
        return read_source(spark, spec.path, spec.fmt, spec.encoding, order_col=ROW)
    except AnalysisException as e:
        if spec.optional and e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def clean_frame(df: DataFrame, spec: SourceSpec, name_map: DataFrame | None = None, rules: dict | None = None,
                period_range=(1950, 2024), keep_row: bool = False) -> DataFrame:
    """Raw rows -> ``[iso3, year, (country_name), metric]``. ``keep_row`` keeps ``__row``
    (for sources that aren't reduced to one row per key)."""
    if spec.fmt == "positional":
        _, ppos, vpos, code = spec.positional
        return clean_positional(df, period_pos=ppos, value_pos=vpos, const_code=code,
                                metric=spec.metric, period_range=period_range)
    df = _prepare(df, spec, name_map, rules)
    required = [CODE] + ([spec.metric] if spec.drop_null_metric else [])
    df = clean.drop_null(df, required)
    if spec.exclude_code_prefix:
        df = clean.exclude_prefix(df, CODE, spec.exclude_code_prefix)

    keep = [CODE, PERIOD] + ([NAME] if spec.keep_name else []) + [spec.metric]
    if spec.on_duplicate == "mean":
        df = clean.dedup_mean(df, [CODE, PERIOD], spec.metric)
    elif spec.on_duplicate == "first":
        df = clean.dedup_first_agg(clean.drop_null(df, [PERIOD]), [CODE, PERIOD], ROW,
                                   [c for c in keep if c not in (CODE, PERIOD)])
    df = clean.period_filter(df, PERIOD, *period_range)
    return df.select(*keep, *([ROW] if keep_row and spec.on_duplicate is None else []))


def clean_source(spark: SparkSession, spec: SourceSpec, name_map: DataFrame | None = None,
                 rules: dict | None = None, period_range=(1950, 2024)) -> DataFrame | None:
    """Read and clean one source; None if an optional source is missing."""
    raw = load_source(spark, spec)
    return None if raw is None else clean_frame(raw, spec, name_map, rules, period_range)


def _prepare(df: DataFrame, spec: SourceSpec, name_map: DataFrame | None, rules: dict | None) -> DataFrame:
    """Filter, rename, coerce and resolve: everything before the row drops."""
    df = clean.strip_headers(df)
    clean.require_columns(df, [c for c in (spec.raw_code, spec.raw_name, spec.raw_period, spec.raw_metric) if c])
    for col, val in spec.equals_filters:
        df = clean.filter_if_present(df, col, val)
    if spec.cascade:
        df = clean.filter_first_present(df, spec.cascade[0], spec.cascade[1])
    mapping = {k: v for k, v in ((spec.raw_code, CODE), (spec.raw_name, NAME),
                                 (spec.raw_period, PERIOD), (spec.raw_metric, spec.metric)) if k}
    df = clean.rename(df, mapping)
    df = df.withColumn(spec.metric, to_number(F.col(spec.metric)))
    df = df.withColumn(PERIOD, to_number(F.col(PERIOD)).cast("int"))
    if spec.correct_names:
        df = entities.apply_corrections(df, NAME, rules or {})
        df = entities.resolve(df.drop(CODE) if CODE in df.columns else df, NAME, name_map, CODE)
    return df


def source_lineage(spark: SparkSession, spec: SourceSpec, name_map: DataFrame | None = None,
                   rules: dict | None = None, period_range=(1950, 2024)) -> DataFrame | None:
    """Row counts through the cleaning steps of one source, one aggregation:
    input (after the equality and category filters), code present (mapped),
    value present (when required), not an aggregate code, inside the period.
    De-duplication is reported by the merge, not here. None for a positional sheet
    and for a missing optional source."""
    raw = load_source(spark, spec)
    if raw is None or spec.fmt == "positional":
        return None
    df = _prepare(raw, spec, name_map, rules)
    return clean.clean_lineage(df, cleaning_steps(spec, CODE, PERIOD, period_range))


def assemble_panel(sources, keys, name_col: str | None, canonical: DataFrame | None,
                   overrides: dict | None = None, on_duplicate: str = "error",
                   metric_order=None, strategy: str = "union") -> DataFrame:
    """Merge, relabel from the canonical map (dropping unlabelled codes),
    apply code overrides, canonical column order. Sorting is the sink's job."""
    panel = merge.merge_panel(sources, keys, name_col=name_col, strategy=strategy, on_duplicate=on_duplicate)
    entity = keys[0]
    if canonical is not None and name_col:
        panel = entities.canonical_name(panel, entity, name_col, canonical, drop_unlabelled=True)
    if overrides and name_col:
        panel = entities.override_labels(panel, entity, name_col, overrides)
    metrics = [c for c in panel.columns if c not in set(keys) | {name_col}]
    if metric_order:
        metrics = [m for m in metric_order if m in metrics] + [m for m in metrics if m not in metric_order]
    head = [entity] + ([name_col] if name_col else []) + list(keys[1:])
    return panel.select(*head, *metrics)


def run_pipeline(spark: SparkSession, config) -> DataFrame:
    """Whole chain for a configuration module/object exposing ``SOURCES``,
    ``REFERENCE`` (the source the name map comes from), ``CORRECTIONS``,
    ``OVERRIDES``, ``AGGREGATE_PREFIX``, ``PERIOD_RANGE``, ``METRICS`` and
    ``ON_DUPLICATE``. Missing optional sources and sources without a row left
    are not merged. See :func:`run_pipeline_observed`."""
    return run_pipeline_observed(spark, config)[0]


def run_pipeline_observed(spark: SparkSession, config) -> tuple[DataFrame, DataFrame]:
    """The panel and the cleaning lineage (source, step, ordinal, rows, removed).

    Every source is read once and its rows are stored, cleaned but not yet
    reduced to one row a key, in the shared folder; the lineage, and whether a
    source has a row at all, come from that pass. The reference is read a
    second time, its names and codes only, for the name map, which is stored
    as well."""
    ref = config.REFERENCE
    raw = {s.label: load_source(spark, s) for s in config.SOURCES}
    if ref.label not in raw:
        raw[ref.label] = load_source(spark, ref)
    specs = {s.label: s for s in config.SOURCES} | {ref.label: ref}
    frames = {label: (raw[label], spec) for label, spec in specs.items() if raw[label] is not None}
    return panel_from_stored(frames, ref, [s.label for s in config.SOURCES if s.label in frames], config)


def panel_from_stored(frames: dict, ref: SourceSpec, merged: list[str], config) -> tuple[DataFrame, DataFrame]:
    """The chain after reading, each source stored: ``frames`` are label -> (raw rows, spec), the reference's included."""
    reference = frames[ref.label][0]
    spark = reference.sparkSession
    folder = f"{ensure_checkpoint_dir(spark)}/sources-{uuid.uuid4().hex}"
    name_map = entities.build_name_map(reference, ref.raw_name, ref.raw_code, ROW, config.AGGREGATE_PREFIX)
    name_map.write.parquet(f"{folder}/names")
    name_map = spark.read.schema(name_map.schema).parquet(f"{folder}/names")
    kept, counts = {}, {}
    for i, (label, (df, spec)) in enumerate(frames.items()):
        if spec.fmt == "positional":
            df = clean_frame(df, spec, period_range=config.PERIOD_RANGE)
            steps = []
        else:
            df = _prepare(df, spec, name_map, config.CORRECTIONS)
            names = [NAME] if NAME in df.columns else []
            df = df.select(CODE, PERIOD, *names, spec.metric, ROW)
            steps = cleaning_steps(spec, CODE, PERIOD, config.PERIOD_RANGE)
        kept[label], counts[label] = store_steps(df, steps, f"{folder}/{i}")
    cleaned = [_reduced(kept[label], frames[label][1]) for label in merged if counts[label][-1][1]]
    canonical = entities.canonical_map(kept[ref.label], CODE, NAME, ROW)
    panel = assemble_panel(cleaned, [CODE, PERIOD], NAME, canonical, overrides=config.OVERRIDES,
                           on_duplicate=config.ON_DUPLICATE, metric_order=config.METRICS)
    return panel, lineage_frame(spark, counts)


def _reduced(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """Cleaned rows to the columns and, if the source says so, one row per key."""
    if spec.fmt == "positional":
        return df
    keep = [CODE, PERIOD] + ([NAME] if spec.keep_name else []) + [spec.metric]
    if spec.on_duplicate == "mean":
        df = clean.dedup_mean(df, [CODE, PERIOD], spec.metric)
    elif spec.on_duplicate == "first":
        df = clean.dedup_first_agg(df, [CODE, PERIOD], ROW, [c for c in keep if c not in (CODE, PERIOD)])
    return df.select(*keep)


def panel_from_frames(reference: DataFrame, ref_spec: SourceSpec, sources: list[tuple[DataFrame, SourceSpec]], config) -> DataFrame:
    """The chain after reading as one lazy plan: ``sources`` are (raw rows, spec); ``reference`` gives the names."""
    name_map = entities.build_name_map(reference, ref_spec.raw_name, ref_spec.raw_code, ROW, config.AGGREGATE_PREFIX)
    cleaned = [clean_frame(df, s, name_map, config.CORRECTIONS, config.PERIOD_RANGE) for df, s in sources]
    labels = clean_frame(reference, ref_spec, name_map, config.CORRECTIONS, config.PERIOD_RANGE, keep_row=True)
    canonical = entities.canonical_map(labels, CODE, NAME, ROW)
    return assemble_panel(cleaned, [CODE, PERIOD], NAME, canonical, overrides=config.OVERRIDES,
                          on_duplicate=config.ON_DUPLICATE, metric_order=config.METRICS)
