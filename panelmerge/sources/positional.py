"""Headerless positional sheets: value columns are addressed by position."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelmerge.functions.nulls import to_number
from panelmerge.operators.clean import dedup_first_agg, period_predicate
from panelmerge.sources.readers import ROW, file_order, splits
from panelmerge.sources.split_csv import read_csv_split


def read_positional(spark: SparkSession, path: str, encoding: str = "UTF-8", skip: int = 0) -> DataFrame:
    """A sheet exported as CSV, no header: columns ``_c0, _c1, ...`` plus the
    row's position in its file for keep-first semantics. ``skip``: leading rows to leave out."""
    df = read_csv_split(spark, path, encoding, header=False, order_col=ROW) if splits(encoding) else None
    if df is None:
        df = file_order(spark.read.option("header", False).option("encoding", encoding).option("multiLine", True).csv(path))
    if skip <= 0:
        return df
    # The place of the last skipped row: one row. A sheet of fewer rows has none left.
    last = df.select("__row").orderBy("__row").limit(skip).agg(F.max("__row").alias("__last"))
    return df.crossJoin(F.broadcast(last)).filter("__row > __last").drop("__last")


def clean_positional(df: DataFrame, *, period_pos: int = 0, value_pos: int = 1, const_code: str = "USA",
                     metric: str = "value", order_col: str = "__row", code_col: str = "iso3",
                     sane_range=(1900, 2100), period_range=(1950, 2024), period_col: str = "year") -> DataFrame:
    """Positional cleaning: coerce, drop incomplete rows (title, note and
    footnote rows fall out here), keep sane years, int year, constant code,
    keep the first row per year, period filter."""
    p = to_number(F.col(f"_c{period_pos}"))
    v = to_number(F.col(f"_c{value_pos}"))
    out = df.select(F.col(order_col).alias("__o"), p.alias("__p"), v.alias(metric)).na.drop()
    out = out.filter(F.col("__p").between(*sane_range))
    out = out.select("__o", F.col("__p").cast("int").alias(period_col), metric, F.lit(const_code).alias(code_col))
    out = dedup_first_agg(out, [code_col, period_col], "__o", [metric])
    return out.filter(period_predicate(period_col, *period_range)).select(code_col, period_col, metric)
