"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

A document's key hashes to a point of the ring; it belongs to the shard of the
next virtual node clockwise. A shard takes at most its capacity; what overflows
goes on clockwise to the next shard with room. With capacities that add up to
the number of rows, counts differ by one at most.

All keys between two neighbouring virtual nodes see the shards in the same
order, so the overflow is decided on the counts of those arcs (shards x virtual
nodes numbers, whatever the corpus) and comes out as ranges of ranks on each
arc. Rows only need their rank on their arc, in hash order: a running count within
hash pieces, on top of the sums of the pieces before. A key of many texts is one
point of the ring and still many pieces.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored

VIRTUAL_NODES = 64
PIECE_ROWS = 2000  # rows of a piece, if the arcs are alike
RUN_ROWS = 10_000  # rows that repeat one another are numbered in runs


def ring(shards: int, virtual_nodes: int = VIRTUAL_NODES) -> tuple[np.ndarray, np.ndarray]:
    """Points of the virtual nodes in clockwise order (signed 64-bit) and their shards.
    A shard's points don't depend on how many other shards there are."""
    points = sorted(
        (int.from_bytes(hashlib.blake2b(f"shard {s} node {v}".encode(), digest_size=8).digest(), "big", signed=True), s)
        for s in range(shards) for v in range(virtual_nodes))
    return np.array([p for p, _ in points], np.int64), np.array([s for _, s in points], np.int64)


def arc_of(points: np.ndarray, position: np.ndarray) -> np.ndarray:
    """Number of the virtual node at or after each position, clockwise."""
    return np.searchsorted(points, position, side="left") % len(points)


def capacities(rows: int, shards: int, slack: float = 0.0) -> list[int]:
    """Most rows of each shard. slack 0: they add up to the rows, one apart at most;
    else (1 + slack) times the mean, rounded up."""
    if slack > 0:
        return [int(np.ceil((1 + slack) * rows / shards))] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def place(arc_rows: dict[int, int], owners: np.ndarray, caps: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Ranges (arc, from rank, to rank, shard, first slot) that cover every row of every arc.

    Turn by turn, what an arc still has asks the next shard on its way clockwise;
    a shard serves the arcs in ring order while it has room. After as many turns
    as there are shards each has been asked by all, so nothing is left."""
    shards, ways = len(caps), {}
    for arc in arc_rows:
        turned = np.roll(owners, -arc)
        ways[arc] = turned[np.sort(np.unique(turned, return_index=True)[1])]
    left, load, out = {a: 0 for a in arc_rows}, [0] * shards, []
    for turn in range(shards):
        for arc in sorted(arc_rows):
            shard = int(ways[arc][turn])
            took = min(arc_rows[arc] - left[arc], caps[shard] - load[shard])
            if took > 0:
                out.append((arc, left[arc], left[arc] + took, shard, load[shard]))
                left[arc] += took
                load[shard] += took
    return out


def assign_shards(docs: DataFrame, shards: int = 8, virtual_nodes: int = VIRTUAL_NODES, slack: float = 0.0) -> DataFrame:
    """A row per row of ``docs`` (doc_id and text; other columns are ignored): doc_id,
    size (UTF-8 bytes plus 1), text_crc32, home (the shard that owns the key), shard,
    slot (gapless from 0 in each shard).

    The key is doc_id; a null doc_id is a key like others. Null text: size 1, and the
    checksum of an empty text. Repeated rows share a key and are told apart by their
    rank only. An empty table gives an empty result. Reruns agree.
    """
    spark = docs.sparkSession
    points, owners = ring(shards, virtual_nodes)

    @F.pandas_udf("int")
    def arc(position: pd.Series) -> pd.Series:
        return pd.Series(arc_of(points, position.to_numpy(np.int64)))

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # Rows that agree in all that counts are one item with a number: one key with
    # a third of all rows is one row here.
    items = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.when(F.col("text").isNull(), 1).otherwise(F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
    ).groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("rows"))
    items = stored(items.withColumn("position", F.xxhash64("doc_id", F.lit("ring"))).withColumn("arc", arc("position")), "ring")
    total = items.agg(F.sum("rows")).first()[0] or 0

    # Even an arc of all rows has pieces of at most arcs x PIECE_ROWS rows.
    in_arc = max(32, total // (PIECE_ROWS * len(points)))
    items = items.withColumn("u", F.xxhash64("doc_id", "size", "text_crc32", F.lit("rank"))).withColumn("piece", F.pmod("u", F.lit(in_arc)))
    place_in = Window.partitionBy("arc", "piece").orderBy("u", "doc_id", "size", "text_crc32").rowsBetween(Window.unboundedPreceding, -1)
    pieces = stored(items.groupBy("arc", "piece").agg(F.sum("rows").alias("in_piece")), "ring-pieces")
    before = Window.partitionBy("arc").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.withColumn("before", F.coalesce(F.sum("in_piece").over(before), F.lit(0))).drop("in_piece")

    arc_rows = {r["arc"]: r["n"] for r in pieces.groupBy("arc").agg(F.sum("in_piece").alias("n")).collect()}  # shards x virtual nodes at most
    ranges = place(arc_rows, owners, capacities(total, shards, slack))
    plan = spark.createDataFrame([(*x, int(owners[x[0]])) for x in ranges], "arc int, lo long, hi long, shard int, base long, home int")

    ranked = (
        items.withColumn("within", F.coalesce(F.sum("rows").over(place_in), F.lit(0)))
        .join(offsets, ["arc", "piece"])
        .select("doc_id", "size", "text_crc32", "arc", (F.col("before") + F.col("within")).alias("start"), "rows")
        .withColumn("run", F.expr(f"explode(sequence(0L, (rows - 1) div {RUN_ROWS}))"))
        .withColumn("start", F.expr(f"start + run * {RUN_ROWS}")).withColumn("rows", F.expr(f"least(rows - run * {RUN_ROWS}, {RUN_ROWS})"))
        .repartition("arc", "start")
        .withColumn("rank", F.expr("explode(sequence(start, start + rows - 1))")))
    # At most shards x virtual nodes x shards ranges.
    placed = ranked.join(F.broadcast(plan.withColumnRenamed("arc", "on_arc")), F.expr("arc = on_arc AND rank >= lo AND rank < hi"))
    return placed.select("doc_id", "size", "text_crc32", "home", "shard", (F.col("base") + F.col("rank") - F.col("lo")).alias("slot"))
