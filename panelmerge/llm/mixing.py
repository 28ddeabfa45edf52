"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Each source's documents are permuted by hash and taken pass by pass until the
source's target is met; the permuted order is cut into blocks of equally many
words. The block quotas of all sources are split among the output shards by a
tree: at a node, half of its blocks (as many as go to the left shards) are drawn
without replacement, so each source's share of a side follows the multivariate
hypergeometric distribution and the quotas of a source add up exactly. The
leaves' quotas are then filled with disjoint runs of the source's permuted
blocks, and a hash orders the documents within their shard.

DataFrame functions only. The tree works on a few hundred block tokens; running
sums over documents are cut into hash pieces, so no source sits in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import WORD, stored

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_PASSES = 2
SHARDS, BLOCKS_PER_SHARD = 8, 64
PIECE_ROWS = 50_000
LEAST_PIECES = 64
FILL_ROUNDS = 3


def source_targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST_PASSES) -> DataFrame:
    """Word targets of ``sources`` (source, source_size): ``weights`` repeat over the
    sources by code point, null last; they share ``share`` of all sizes, none above
    ``most`` times its size.

    Sharing the excess by weight again and again ends where every source gets the
    smaller of its cap and weight x level, for one common level. Sorted by cap /
    weight, the capped sources come first, so running sums give the level.
    Adds sid (place by code point, from 0), weight and target."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    out = sources.withColumn("sid", F.row_number().over(by_name) - 1)
    out = out.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.pmod("sid", F.lit(len(weights))).cast("int") + 1).cast("double"))
    out = out.withColumn("cap", F.col("source_size") * F.lit(float(most)))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "sid")
    all_rows = Window.partitionBy(F.lit(0))
    out = out.withColumn("total", F.sum("source_size").over(all_rows) * F.lit(float(share)))
    out = out.withColumn("used", F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    out = out.withColumn("open", F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
    out = out.withColumn("level", (F.col("total") - F.col("used")) / F.col("open"))
    # The level is that of the first source that stays within its cap; if none does, all are capped.
    fits = F.when(F.col("level") * F.col("weight") <= F.col("cap") * (1 + 1e-12), F.struct(F.col("cap") / F.col("weight"), F.col("sid"), F.col("level").alias("at")))
    out = out.withColumn("level", F.coalesce(F.min(fits).over(all_rows)["at"], F.max(F.col("cap") / F.col("weight")).over(all_rows)))
    return out.select("source", "source_size", "sid", "weight", F.least("cap", F.col("level") * F.col("weight")).alias("target"))


def split_tree(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """Split block quotas (sid, blocks) among shards: a row (sid, shard, quota).

    A block is a token (sid, i). At a node for the shards lo .. lo + width - 1 the
    tokens are ranked by hash, and the first ones, in proportion to the left
    shards, go left: a draw without replacement from the node's quotas."""
    tokens = quotas.filter("blocks > 0").select("sid", F.expr("explode(sequence(0L, blocks - 1))").alias("i"))
    tokens = tokens.withColumn("lo", F.lit(0)).withColumn("width", F.lit(shards))
    level = 0
    while (1 << level) < shards:
        node = Window.partitionBy("lo", "width")
        tokens = tokens.withColumn("n", F.count("*").over(node)).withColumn(
            "rank", F.row_number().over(node.orderBy(F.xxhash64(F.lit(seed), F.lit(level), "lo", "sid", "i"), "sid", "i")) - 1)
        half = F.expr("width div 2").cast("int")
        left = F.col("rank") * F.col("width") < F.col("n") * half
        tokens = tokens.withColumn("left", (F.col("width") > 1) & left).select(
            "sid", "i",
            F.when((F.col("width") == 1) | F.col("left"), F.col("lo")).otherwise(F.col("lo") + half).alias("lo"),
            F.when(F.col("width") == 1, F.lit(1)).when(F.col("left"), half).otherwise(F.col("width") - half).alias("width"))
        level += 1
    return tokens.groupBy("sid", F.col("lo").alias("shard")).agg(F.count("*").alias("quota"))


def deal_blocks(quotas: DataFrame, leaves: DataFrame, seed: int) -> DataFrame:
    """Which shard gets which block: (sid, block, shard). A source's blocks are
    permuted, and each leaf takes the next ``quota`` of them."""
    run = Window.partitionBy("sid").orderBy("shard")
    ranges = leaves.withColumn("hi", F.sum("quota").over(run.rowsBetween(Window.unboundedPreceding, 0))).withColumn("lo", F.col("hi") - F.col("quota"))
    blocks = quotas.filter("blocks > 0").select("sid", F.expr("explode(sequence(0L, blocks - 1))").alias("block"))
    permuted = blocks.withColumn("rank", F.row_number().over(Window.partitionBy("sid").orderBy(F.xxhash64(F.lit(seed), F.lit("block"), "sid", "block"), "block")) - 1)
    return permuted.join(ranges.drop("quota"), "sid").filter("rank >= lo AND rank < hi").select("sid", "block", "shard")


def plan_mix(docs: DataFrame, shards: int = SHARDS, seed: int = 1, weights=WEIGHTS, share: float = SHARE, most: int = MOST_PASSES) -> DataFrame:
    """The mix of ``docs`` (doc_id, text, source; other columns are ignored), a row per
    distinct (doc_id, source, text): doc_id, source, text_hash, rows (how many input
    rows agree in them), size (words), source_size, target, copies (0 to ``most``, of
    each of those rows), taken (copies x size), shard_1, shard_2, order_1, order_2
    (shard of each copy and its place by hash there; null where not taken).

    A source takes whole passes, then in the next pass the permuted documents that
    fit into what is left of its target, then up to FILL_ROUNDS times the document
    that fills the rest best. Null or empty texts have size 0 and are never taken.
    A null source is a source of its own; a null doc_id is an id like others.
    Repeated rows share their fate. An empty table gives an empty plan.
    """
    words = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    items = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.xxhash64(F.col("text").cast("string")).alias("text_hash"), words.alias("size"),
    ).groupBy("doc_id", "source", "text_hash", "size").agg(F.count("*").alias("rows"))
    items = stored(items.withColumn("weighs", F.col("size") * F.col("rows")).withColumn("u", F.xxhash64(F.lit(seed), "doc_id", "source", "text_hash")), "mix-items")

    sources = items.groupBy("source").agg(F.sum("weighs").alias("source_size"))
    targets = source_targets(sources, weights, share, most)
    targets = targets.withColumn("passes", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") * (1 + 1e-12))).otherwise(0).cast("long"))
    targets = targets.withColumn("rest", F.greatest(F.lit(0.0), F.col("target") - F.col("passes") * F.col("source_size")))
    targets = stored(targets, "mix-targets")
    named = items.join(targets.withColumnRenamed("source", "__source"), F.col("source").eqNullSafe(F.col("__source"))).drop("__source")

    # Where each document starts in its source's permuted order, in words.
    pieces = max(LEAST_PIECES, -(-items.count() // PIECE_ROWS))  # of the data alone: reruns agree
    named = named.withColumn("piece", F.pmod("u", F.lit(pieces)))
    sums = named.groupBy("sid", "piece").agg(F.sum("weighs").alias("in_piece"))
    offsets = sums.withColumn("before", F.coalesce(F.sum("in_piece").over(
        Window.partitionBy("sid").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select(F.col("sid").alias("__sid"), F.col("piece").alias("__piece"), "before")
    offsets = stored(offsets, "mix-offsets")
    within = Window.partitionBy("sid", "piece").orderBy("u", "doc_id", "text_hash").rowsBetween(Window.unboundedPreceding, -1)
    placed = named.withColumn("within", F.coalesce(F.sum("weighs").over(within), F.lit(0))).join(
        offsets, F.expr("sid = __sid AND piece = __piece")).withColumn("start", F.col("before") + F.col("within")).drop("__sid", "__piece", "before", "within")
    placed = stored(placed, "mix-order")

    # The last, partial pass: a prefix, then the largest that still fits.
    fits = (F.col("start") + F.col("weighs") <= F.col("rest")) & (F.col("weighs") > 0)
    extra = stored(placed.filter(fits).groupBy("sid").agg(F.sum("weighs").alias("got")), "mix-prefix")
    state = targets.select("sid", "rest").join(extra, "sid", "left").select("sid", (F.col("rest") - F.coalesce("got", F.lit(0))).alias("room"))
    chosen: DataFrame | None = None
    for turn in range(FILL_ROUNDS):
        state = stored(state, "mix-room")
        last = turn == FILL_ROUNDS - 1  # the last may go over, if that is nearer
        # An item of whole copies can't be told from its like: doc_id, text_hash and u name it.
        left = placed.filter(~fits & (F.col("weighs") > 0)).join(state, "sid").filter("weighs < 2 * room" if last else "weighs <= room")
        if chosen is not None:
            left = left.join(chosen.select("sid", "u", "doc_id", "text_hash").withColumnsRenamed({"sid": "s_", "u": "u_", "doc_id": "d_", "text_hash": "t_"}),
                             F.expr("sid = s_ AND u = u_ AND doc_id <=> d_ AND text_hash <=> t_"), "left_anti")
        off = F.abs(F.col("room") - F.col("weighs")).alias("off")
        best = left.groupBy("sid").agg(F.min(F.struct(off, "weighs", "u", "doc_id", "text_hash")).alias("b")).select("sid", "b.*").drop("off")
        best = stored(best, "mix-fill")
        state = state.join(best.select("sid", "weighs"), "sid", "left").select("sid", (F.col("room") - F.coalesce("weighs", F.lit(0))).alias("room"))
        chosen = best if chosen is None else chosen.unionByName(best)
    picked = chosen.select("sid", "u", "doc_id", "text_hash", F.lit(True).alias("filled")).withColumnsRenamed({"sid": "s_", "u": "u_", "doc_id": "d_", "text_hash": "t_"})
    taken = placed.join(picked, F.expr("sid = s_ AND u = u_ AND doc_id <=> d_ AND text_hash <=> t_"), "left").drop("s_", "u_", "d_", "t_")
    partial = fits | F.coalesce(F.col("filled"), F.lit(False))
    taken = taken.withColumn("copies", F.when(F.col("weighs") > 0, F.col("passes") + partial.cast("long")).otherwise(0).cast("long"))

    # Blocks of the permuted order, over all passes; a filled-in document goes to the last.
    taken = stored(taken, "mix-taken")
    total = F.sum("taken").over(Window.partitionBy(F.lit(0)))
    quotas = taken.groupBy("sid").agg(F.sum(F.col("copies") * F.col("weighs")).alias("taken")).withColumn(
        "block_words", F.greatest(F.lit(1), F.ceil(total / (shards * BLOCKS_PER_SHARD))).cast("long")).withColumn("blocks", F.expr("cast(ceil(taken / block_words) as long)"))
    quotas = stored(quotas.drop("taken"), "mix-quotas")
    dealt = stored(deal_blocks(quotas, split_tree(quotas, shards, seed), seed), "mix-blocks")

    out = taken.join(quotas, "sid")
    for copy in (1, 2):
        start = F.when(F.col("passes") >= copy, (copy - 1) * F.col("source_size") + F.col("start")).otherwise(
            F.col("passes") * F.col("source_size") + F.when(fits, F.col("start")).otherwise(F.col("rest").cast("long")))
        block = F.least(F.expr("blocks - 1"), F.floor(start / F.col("block_words")))
        out = out.withColumn(f"block_{copy}", F.when(F.col("copies") >= copy, block))
        own = dealt.select(F.col("sid").alias("s_"), F.col("block").alias("b_"), F.col("shard").alias(f"shard_{copy}"))
        out = out.join(own, F.expr(f"sid = s_ AND block_{copy} = b_"), "left").drop("s_", "b_")
        out = out.withColumn(f"order_{copy}", F.when(F.col("copies") >= copy, F.xxhash64(F.lit(seed), F.lit(copy), f"shard_{copy}", "u")))
    return out.select(
        "doc_id", "source", "text_hash", "rows", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"), "shard_1", "order_1", "shard_2", "order_2")


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` as the mix takes them: every row as often as ``plan_mix`` says, with all
    its columns. Rows that a document gives twice are equal."""
    plan = plan_mix(docs, **options).filter("copies > 0").select(
        F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("text_hash").alias("__hash"), F.col("copies").cast("int").alias("__copies"))
    keyed = docs.withColumn("__own", F.xxhash64(F.col("text").cast("string")))
    out = keyed.join(plan, keyed["doc_id"].cast("long").eqNullSafe(F.col("__id")) & keyed["source"].cast("string").eqNullSafe(F.col("__source")) & (F.col("__own") == F.col("__hash")))
    return out.withColumn("__copy", F.explode(F.expr("sequence(1, __copies)"))).select(*[F.col(f"`{c}`") for c in docs.columns])
