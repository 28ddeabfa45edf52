"""Streaming form of the panel merge.

``panel_stream`` is :func:`panelmerge.operators.merge.merge_panel` applied to
streaming sources: the aggregation state holds one entry per panel key, so
it is bounded by the panel size, not by the number of source rows seen.
Periods are revised by publishers at any time, so no watermark is set and
late rows always update their cell.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from panelmerge.operators.merge import merge_panel
from panelmerge.session import ensure_checkpoint_dir


def read_source_stream(spark: SparkSession, path: str, schema: str, fmt: str = "parquet",
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """A source directory as a stream of its files (schema is required)."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "csv":
        r = r.option("header", True)
    return r.load(path)


def panel_stream(streams, keys, *, name_col: str | None = None, on_duplicate: str = "mean") -> DataFrame:
    """Streaming panel: one row per key, one column per source metric."""
    if on_duplicate not in ("mean", "max", "error"):
        raise ValueError("streaming merge supports on_duplicate = mean | max | error")
    return merge_panel(list(streams), list(keys), name_col=name_col, strategy="union", on_duplicate=on_duplicate)


def start_panel_stream(df: DataFrame, *, query_name: str, sink: str = "memory", path: str | None = None,
                       checkpoint: str | None = None, output_mode: str = "complete",
                       trigger_once: bool = False) -> StreamingQuery:
    """Start the panel stream.

    ``sink="memory"`` (tests) or ``sink="parquet-snapshot"``: every
    micro-batch of the complete panel overwrites ``path`` through
    ``foreachBatch``. In ``update`` mode the changed rows of each batch are
    appended to ``path`` with their batch id (a change log). The checkpoint
    lives under the session's shared ``spark.checkpoint.dir`` unless given.
    """
    spark = df.sparkSession
    if checkpoint is None:
        checkpoint = os.path.join(ensure_checkpoint_dir(spark), "streams", query_name)
    w = df.writeStream.queryName(query_name).outputMode(output_mode).option("checkpointLocation", checkpoint)
    if trigger_once:
        w = w.trigger(availableNow=True)
    if sink == "memory":
        return w.format("memory").start()
    if sink != "parquet-snapshot" or not path:
        raise ValueError("sink must be 'memory' or 'parquet-snapshot' with a path")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        if output_mode == "complete":
            batch.write.mode("overwrite").parquet(path)
        else:
            from pyspark.sql import functions as F
            batch.withColumn("batch_id", F.lit(batch_id)).write.mode("append").parquet(path)

    return w.foreachBatch(write_batch).start()
