"""A Merkle manifest of a dataset, with a proof for every row, by slot pivot.

Rows are leaves, in order, of one tree per source; the sources' roots are the leaves
of one tree more. A parent is the hash of up to ``FANOUT`` neighbours. Conditional
aggregates spread each parent's children into ``FANOUT`` columns: joined they are what
the parent hashes, and without the own column they are a child's siblings.

``LEVELS`` levels are climbed for one shuffle: nodes meet by block, and the aggregates of
each level run over a prefix of one sort order within the block. What is above a block is
climbed first and comes back down to it as one path, so no row is joined once a level.
A source with a third of all rows is as many blocks as any other rows are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored

FANOUT = 3
LEVELS = 4  # climbed for one shuffle; a block has FANOUT ** LEVELS nodes


def none() -> Column:
    return F.lit(bytearray())


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*values: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*map(field, values)), 256))


def as_text(digests: Column) -> Column:
    """Digests, one or several joined, as lowercase hex."""
    return F.lower(F.hex(digests))


def node_hash(digests: Column) -> Column:
    return F.unhex(F.sha2(as_text(digests), 256))


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``pos`` (from 0 in each group, in the order) and ``n`` (rows of the group).

    Rows are dealt by range and numbered in their range; only counts by group and range
    are summed up. ``rows`` has to be a stored table, so that its ranges stay the same."""
    ranged = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    ranged = ranged.withColumn("part", F.spark_partition_id()).withColumn("idx", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    ranged = stored(ranged, "manifest-order")
    counts = ranged.groupBy(group, "part").agg(F.count("*").alias("here"), F.min("idx").alias("first"))
    whole = Window.partitionBy(group)  # a row for each range that the group is in
    counts = counts.select(
        group, "part", "first", F.sum("here").over(whole).alias("n"),
        F.coalesce(F.sum("here").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return ranged.join(counts, [group, "part"]).withColumn("pos", F.col("before") + F.col("idx") - F.col("first")).drop("part", "idx", "first", "before")


def with_siblings(nodes: DataFrame) -> DataFrame:
    """``nodes`` (group, pos, n, h) with ``block``, ``own`` (the steps up to the block's top:
    what stands left and right of the node in its parent) and ``top`` (the block's hash).

    A group of one node has no parent: it is its own top."""
    nodes = nodes.withColumn("block", F.expr(f"pos div {FANOUT ** LEVELS}"))
    keys = {level: f"p{level}" for level in range(1, LEVELS)}
    for level, key in keys.items():
        nodes = nodes.withColumn(key, F.expr(f"pos div {FANOUT ** level}"))
    nodes = nodes.withColumn("top", F.col("h"))
    steps = []
    for level in range(LEVELS):
        # Nodes of one parent; every list of keys begins like the next longer one, so one sort serves all.
        run = Window.partitionBy("group", "block", *(keys[x] for x in range(LEVELS - 1, level, -1)))
        at = F.expr(f"pos div {FANOUT ** level} % {FANOUT}")
        grows = F.expr(f"n > {FANOUT ** level}")  # more than one node is left on this level
        slots = [f"s{j}" for j in range(FANOUT)]
        for j, slot in enumerate(slots):
            nodes = nodes.withColumn(slot, F.coalesce(F.max(F.when(at == j, F.col("top"))).over(run), none()))
        left, right, step = none(), none(), f"step{level}"
        for j in range(FANOUT):
            left = F.when(at == j, F.concat(none(), *slots[:j])).otherwise(left)
            right = F.when(at == j, F.concat(none(), *slots[j + 1:])).otherwise(right)
        nodes = nodes.withColumn(step, F.when(grows, F.struct(left.alias("left"), right.alias("right"))))
        nodes = nodes.withColumn("top", F.when(grows, node_hash(F.concat(*slots))).otherwise(F.col("top"))).drop(*slots)
        steps.append(step)
    return nodes.withColumn("own", F.array_compact(F.array(*steps))).drop(*steps, *keys.values())


def climb(nodes: DataFrame, most: int, finish: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``nodes`` (group, pos, n, h, ...; groups of ``most`` nodes at most) with ``path`` (steps
    from the node up), ``subroot`` (the group's root) and the columns that ``finish`` adds to
    the roots: it takes (group, h) and returns group, path and more."""
    if most <= 1:
        above = finish(nodes.select("group", "h"))
        return nodes.withColumn("subroot", F.col("h")).join(above, "group")
    size = FANOUT ** LEVELS
    placed = with_siblings(nodes)
    parents = placed.filter(f"pos % {size} = 0").select("group", F.col("block").alias("pos"), F.expr(f"(n + {size - 1}) div {size}").alias("n"), F.col("top").alias("h"))
    above = climb(stored(parents, "manifest-nodes"), -(-most // size), finish).drop("n", "h")
    above = above.withColumnRenamed("path", "on").withColumnRenamed("pos", "block")
    return placed.join(above, ["group", "block"]).withColumn("path", F.concat("own", "on")).drop("block", "own", "on", "top")


def sources_on_top(roots: DataFrame) -> DataFrame:
    """group, path and root: the tree over the sources' roots, in the order of the sources."""
    roots = stored(roots, "manifest-roots")
    top = numbered(roots.withColumnRenamed("group", "source_key").withColumn("group", F.lit("")), "group", ["source_key"])
    none_above = roots.sparkSession.createDataFrame([("", [])], "group string, path array<struct<left binary, right binary>>")
    tree = climb(top, roots.count(), lambda one: none_above)
    return stored(tree.select(F.col("source_key").alias("group"), "path", F.col("subroot").alias("root")), "manifest-sources")


def manifest(docs: DataFrame, tampered: Column | None = None, tampered_text: Column | None = None) -> DataFrame:
    """A row per row of ``docs`` (doc_id, source, lang, n_chars, text; other columns are
    ignored): doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``tampered``, ``tampered_text``: rows that are checked with another text. Their leaf is
    recomputed, all siblings are the original ones.

    Null values are ``-`` in a leaf; a null source is a source of its own, before all
    others, and null ids come first in theirs. Empty texts are ``0:``; very long ones are
    hashed whole. Rows of one id in a source are ordered by leaf; repeated rows are a
    leaf each, with proofs of their own, by any order. An empty table gives an empty result.
    """
    text = F.col("text").cast("string")
    values = [F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("lang").cast("string"), F.col("n_chars").cast("long")]
    leaf = leaf_hash(*values, text)
    other = F.when(F.coalesce(tampered, F.lit(False)), leaf_hash(*values, tampered_text)) if tampered is not None else F.lit(None).cast("binary")
    rows = stored(docs.select(
        values[0].alias("doc_id"), F.coalesce(F.concat(F.lit("s"), values[1]), F.lit("")).alias("group"), leaf.alias("h"), other.alias("other"),
        F.monotonically_increasing_id().alias("salt")), "manifest-leaves")
    # The salt spreads repeated rows over ranges; they are alike, so their order doesn't matter.
    nodes = stored(numbered(rows, "group", ["doc_id", "h", "salt"]).drop("salt"), "manifest-numbered")
    most = nodes.agg(F.max("n")).first()[0] or 0
    tree = climb(nodes, most, sources_on_top)
    folded = F.aggregate("path", F.coalesce("other", "h"), lambda h, step: node_hash(F.concat(step["left"], h, step["right"])))
    proof = F.sha2(F.array_join(F.transform("path", lambda step: as_text(F.concat(step["left"], step["right"]))), ""), 256)
    out = tree.select(
        "doc_id", as_text(F.col("h")).alias("leaf"), as_text(F.col("subroot")).alias("subroot"), as_text(F.col("root")).alias("root"),
        proof.alias("proof_sha256"), as_text(folded).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
