"""Revised values on a stream, with state bounded by a watermark.

A publisher sends a value for a key and a time, and may send it again, corrected. ``final_revisions`` holds the latest
revision of each key and window until the watermark has passed the window, emits it once and forgets it: the state is
the open windows, not the panel. ``append_final`` writes what is final to a folder per window, so nothing is rewritten.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

START = "window_start"


def final_revisions(stream: DataFrame, keys, time: str, revised: str, values, width: str = "1 day", delay: str = "7 days") -> DataFrame:
    """window_start, ``keys``, ``revised`` and ``values`` of the latest revision of each key in each window of ``time``.

    Append mode: a row comes when the watermark (the greatest time seen less ``delay``) has passed its window's end.
    Rows of windows passed before are dropped, as the window's result is out. Of revisions of one time the greatest
    values count (compared in order, null least); a null ``revised`` is older than any; rows with a null key or time are
    dropped. On a batch DataFrame every window is final."""
    keys, values = list(keys), list(values)
    rows = stream.na.drop(subset=[*keys, time]).withWatermark(time, delay)
    latest = F.max(F.struct(revised, *values)).alias("__latest")
    out = rows.groupBy(F.window(time, width).alias("__w"), *keys).agg(latest)
    return out.select(F.col("__w.start").alias(START), *keys, *(F.col("__latest").getField(c).alias(c) for c in (revised, *values)))


def append_final(final: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Write final rows as Parquet in a folder per day of the window; the sink's log makes each row appear once, reruns included."""
    day = final.withColumn("day", F.to_date(START))
    return day.writeStream.format("parquet").partitionBy("day").option("checkpointLocation", checkpoint).outputMode("append") \
        .trigger(**(trigger or {"availableNow": True})).start(path)
