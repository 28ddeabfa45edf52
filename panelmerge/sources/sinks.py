"""Panel sinks. The total order by key is applied here, at the sink only:
``orderBy`` range-partitions, so part files are ordered among themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_panel(df: DataFrame, path: str, fmt: str = "parquet", keys=None, mode: str = "overwrite",
                partition_by=None) -> None:
    """Write the panel as csv (with header), parquet or JSON Lines.

    JSON keeps NULL fields (the JSON writer drops them by default).
    """
    out = df.orderBy(*keys) if keys else df
    w = out.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    elif fmt == "parquet":
        w.parquet(path)
    elif fmt == "json":
        w.option("ignoreNullFields", False).json(path)
    else:
        raise ValueError(f"unknown format {fmt}")


# ---- a store that is laid out by key

def store_panel(df: DataFrame, table: str, keys, period: str, buckets: int = 200, path: str | None = None) -> None:
    """Store the panel as a table in a folder per period, bucketed and sorted by the other keys.

    Aggregations by all keys, and joins by the bucketed ones, then need no exchange. If the table is there, only the
    periods that ``df`` holds are replaced."""
    spark = df.sparkSession
    within = [k for k in keys if k != period]
    if spark.catalog.tableExists(table):
        before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        try:
            df.select(*spark.table(table).columns).repartition(buckets, *within).write.insertInto(table, overwrite=True)
        finally:
            spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
        return
    # Dealt as the buckets are, so that a task writes one file per period and bucket.
    writer = df.repartition(buckets, *within).write.partitionBy(period).bucketBy(buckets, *within).sortBy(*within)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def stored_panel(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


def key_sizes(panel: DataFrame, keys, period: str) -> DataFrame:
    """Rows by key: on a stored panel no exchange, as the rows of a key share a bucket."""
    within = [k for k in keys if k != period]
    return panel.groupBy(*within, period).agg(F.count(F.lit(1)).alias("rows"))
