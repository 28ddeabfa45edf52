"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard.

A document is the set of its distinct word shingles. One permutation scatters the
shingles over ``UNIVERSE`` places; the second is read with a circular shift of k for
coordinate k of the signature, so a shingle's values for all coordinates are one
contiguous piece of one array, and the signature is the minimum of such pieces.
Sets of more than ``LARGE`` shingles would fill that universe; theirs is all 64-bit
integers, with two bijections as the permutations. Sets that can be linked to smaller and to
larger ones alike have bands in both, so a pair always meets in one of them.

Documents of equal sets are one class and go on as one node. Nodes that agree in a
band of the signature share a bucket. Links are verified on the full sets:

1. every node of a bucket against the bucket's first node (linear in the nodes);
   the links' components are found by contraction;
2. in buckets that still hold several components, every node outside the bucket's
   largest component against all nodes of other components, in blocks of a bounded
   number of sets, so that sets travel per block and not per pair, and no task
   holds a bucket.

After that any two nodes of a bucket are connected or known to be no link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import U64, mix64, raw, stored, word_runs

UNIVERSE = 1 << 20
LARGE = 1 << 15  # unrelated sets of this size share 1.6 % of their places
BANDS, ROWS = 25, 5  # a pair of Jaccard 0.8 shares no band with probability 5e-5, of 0.85 with 4e-7
SEED = 7
CACHE = 300_000
BLOCK = 256  # sets on one side of a block pair

_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def permutations(seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """The scattering permutation, and for each place the piece of the second
    permutation that starts there (a view, one column for each coordinate)."""
    if seed not in _TABLES:
        rng = np.random.default_rng(seed)
        scatter = rng.permutation(UNIVERSE).astype(np.uint32)
        second = rng.permutation(UNIVERSE).astype(np.uint32)
        ring = np.concatenate([second, second[: BANDS * ROWS]])
        _TABLES[seed] = scatter, np.lib.stride_tricks.sliding_window_view(ring, BANDS * ROWS)
    return _TABLES[seed]


def shingles(text: bytes | None, words_each: int, known: dict[bytes, int]) -> np.ndarray:
    """Distinct 64-bit hashes, ascending, of the shingles of the whole text, A-Z
    lower-cased; of fewer words, the whole sequence; of none, nothing."""
    def hashes() -> Iterator[int]:
        for run in word_runs((text or b"").lower()):
            for word in run:
                h = known.get(word)
                if h is None:
                    if len(known) >= CACHE:
                        known.clear()
                    h = known[word] = xxhash.xxh3_64_intdigest(word)
                yield h

    words = np.fromiter(hashes(), U64)
    if not len(words):
        return words
    k = min(words_each, len(words))
    out = np.full(len(words) - k + 1, k, U64)
    for i in range(k):
        out = mix64(out * U64(0x9E3779B97F4A7C15) + words[i: len(words) - k + 1 + i])
    return np.unique(out)


def signature(hashes: np.ndarray) -> np.ndarray:
    """BANDS x ROWS minima; for the empty set all ones."""
    scatter, pieces = permutations()
    out = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    places = scatter[(hashes % U64(UNIVERSE)).astype(np.int64)]
    for i in range(0, len(places), 4096):
        np.minimum(out, pieces[places[i: i + 4096]].min(axis=0), out=out)
    return out


def large_signature(hashes: np.ndarray) -> np.ndarray:
    """The same over all 64-bit integers."""
    out = np.full(BANDS * ROWS, 0xFFFFFFFFFFFFFFFF, U64)
    places = mix64(hashes + U64(SEED))
    shifts = np.arange(BANDS * ROWS, dtype=U64)[:, None]
    for i in range(0, len(places), 4096):
        np.minimum(out, mix64((places[i: i + 4096] + shifts) ^ U64(0xA0761D6478BD642F)).min(axis=1), out=out)
    return out


def bands_of(hashes: np.ndarray, percent: int, large: int) -> list[tuple[int, np.ndarray]]:
    """(universe, signature): the small one up to ``large`` shingles, the large one from the
    least size that can be linked to more than ``large``."""
    out = [(0, signature(hashes))] if len(hashes) <= large else []
    if 100 * len(hashes) >= percent * large:
        out.append((1, large_signature(hashes)))
    return out


def band_keys(signatures: np.ndarray, universe: np.ndarray | None = None) -> np.ndarray:
    """A 64-bit key for each band of each signature; bands and universes don't mix."""
    rows = signatures.reshape(len(signatures), BANDS, ROWS).astype(U64)
    out = np.tile(np.arange(1, BANDS + 1, dtype=U64), (len(signatures), 1))
    if universe is not None:
        out += universe.astype(U64)[:, None] * U64(BANDS)
    for r in range(ROWS):
        out = mix64(out * U64(0x9E3779B97F4A7C15) + rows[:, :, r])
    return out.view(np.int64)


def node_of(hashes: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(hashes.tobytes())


def sketch(docs: DataFrame, words_each: int, percent: int = 80) -> DataFrame:
    """doc_id, text_hash, n_shingles, node (128-bit name of the set; null if empty) and bands,
    for links of ``percent`` / 100 or more."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("text_hash"), F.col("text").cast("string").alias("text"))
    large = LARGE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            n, nodes, ends, universe, signatures = [], [], [0], [], []
            for text in raw(batch.column(2)):
                s = shingles(text, words_each, known)
                n.append(len(s))
                nodes.append(node_of(s) if len(s) else None)
                for number, values in bands_of(s, percent, large):
                    universe.append(number)
                    signatures.append(values)
                ends.append(len(universe) * BANDS)
            keys = band_keys(np.array(signatures, U64).reshape(-1, BANDS * ROWS), np.array(universe, U64))
            bands = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(nodes, pa.binary()), bands], ["doc_id", "text_hash", "n_shingles", "node", "bands"])

    return texts.mapInArrow(run, "doc_id long, text_hash long, n_shingles long, node binary, bands array<long>")


def sets_of(docs: DataFrame, wanted: DataFrame, words_each: int) -> DataFrame:
    """node and its shingles, for ``wanted`` (node, and doc_id and text_hash of a row that has the set)."""
    wanted = wanted.select(F.col("node").alias("wanted"), F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # By text as well: an id that many texts share mustn't bring each of them to each of its sets.
    found = texts.withColumn("own", F.xxhash64("text")).join(wanted, F.expr("doc_id <=> __id AND own = __hash")).select("wanted", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            nodes, sets = [], []
            for node, text in zip(batch.column(0).to_pylist(), raw(batch.column(1))):
                s = shingles(text, words_each, known)
                if node_of(s) == node:  # texts of equal hash may differ
                    nodes.append(node)
                    sets.append(pa.array(s.view(np.int64)))
            ends = np.cumsum([0, *(len(s) for s in sets)])
            values = pa.concat_arrays(sets) if sets else pa.array([], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)], ["node", "shingles"])

    # Texts that differ in case or blanks only have one set.
    return found.mapInArrow(run, "node binary, shingles array<long>").dropDuplicates(["node"])


def components(edges: DataFrame) -> DataFrame:
    """node and comp, the name of its component, for all nodes of ``edges`` (a, b).

    Contraction: every node is merged into the least of itself and its neighbours,
    until no edge is left. Names are hashes, so each turn takes a share of the nodes away."""
    edges = stored(edges.filter("a <> b").distinct(), "edges")
    names: DataFrame | None = None
    while not edges.isEmpty():
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        into = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select("node", F.least("node", "least").alias("comp")), "contract")
        if names is None:
            names = into
        else:
            later = into.select(F.col("node").alias("__n"), F.col("comp").alias("__c"))
            names = names.join(later, F.expr("comp = __n"), "left").select("node", F.coalesce("__c", "comp").alias("comp"))
            names = stored(names, "names")
        for side in ("a", "b"):
            edges = edges.join(into.select(F.col("node").alias("__n"), F.col("comp").alias("__c")), F.expr(f"{side} = __n")).drop(side, "__n").withColumnRenamed("__c", side)
        edges = stored(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    if names is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("comp"))
    return names


def is_link(common: str, a: str, b: str, percent: int) -> Column:
    return F.expr(f"100 * {common} >= {percent} * ({a} + {b} - {common})")


def block_links(x: dict, y: dict, percent: int) -> list[tuple[bytes, bytes]]:
    """Links that connect different components among two blocks of sets, each a dict of
    node: (component, set). Only links that join what isn't joined yet are returned."""
    parent: dict[bytes, bytes] = {}

    def root(c: bytes) -> bytes:
        while parent.get(c, c) != c:
            c = parent[c]
        return c

    names = list(x)
    if not names or not y:
        return []
    sizes = np.array([len(x[n][1]) for n in names])
    flat = np.concatenate([x[n][1] for n in names])
    owner = np.repeat(np.arange(len(names)), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    out = []
    for node, (comp, own) in y.items():
        lo, hi = np.searchsorted(flat, own, "left"), np.searchsorted(flat, own, "right")
        hit = np.flatnonzero(hi > lo)
        if not len(hit):
            continue
        n = hi[hit] - lo[hit]
        at = np.repeat(lo[hit] - np.cumsum(n) + n, n) + np.arange(n.sum())
        common = np.bincount(owner[at], minlength=len(names))
        for i in np.flatnonzero(100 * common >= percent * (sizes + len(own) - common)):
            other = names[i]
            a, b = root(x[other][0]), root(comp)
            if other != node and a != b:
                parent[max(a, b)] = min(a, b)
                out.append((min(node, other), max(node, other)))
    return out


def linked_nodes(docs: DataFrame, known: DataFrame, words_each: int, percent: int) -> DataFrame:
    """node, doc_id (the least, null if no row has one) and comp, the component's name,
    for the nodes of ``known`` (rows of the sketch that have shingles)."""
    nodes = known.groupBy("node", "n_shingles", "bands").agg(
        F.min("doc_id").alias("doc_id"), F.coalesce(F.min_by("text_hash", "doc_id"), F.min("text_hash")).alias("text_hash"))
    nodes = stored(nodes, "nodes")

    banded = nodes.select("node", "n_shingles", F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.count("*").alias("size"), F.min(F.struct("node", "n_shingles")).alias("first")).filter("size > 1")
    shared = shared.select(F.col("bucket").alias("__b"), F.col("first.node").alias("first"), F.col("first.n_shingles").alias("n_first"))
    members = stored(banded.join(shared, F.expr("bucket = __b")).drop("__b"), "members")
    sets = stored(sets_of(docs, nodes.join(members.select("node").distinct(), "node", "left_semi"), words_each), "sets")

    # 1. Everything against the first of its bucket.
    reach = F.expr(f"100 * least(n_shingles, n_first) >= {percent} * greatest(n_shingles, n_first)")
    stars = members.filter("node <> first").filter(reach).select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()
    a_sets, b_sets = (sets.select(F.col("node").alias(f"__{s}"), F.col("shingles").alias(f"{s}_set")) for s in "ab")
    pairs = stars.join(a_sets, F.expr("a = __a")).join(b_sets, F.expr("b = __b"))
    common = pairs.select("a", "b", F.size("a_set").alias("na"), F.size("b_set").alias("nb"), F.size(F.array_intersect("a_set", "b_set")).alias("common"))
    links = stored(common.filter(is_link("common", "na", "nb", percent)).select("a", "b"), "links")
    comp = components(links)

    # 2. What the stars leave open.
    named = members.select("bucket", "node", "n_shingles").join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    by_comp = named.groupBy("bucket", "comp").agg(F.count("*").alias("n"))
    largest = by_comp.groupBy("bucket").agg(F.count("*").alias("comps"), F.sum("n").alias("all"), F.max(F.struct("n", "comp")).alias("top")).filter("comps > 1")
    largest = largest.select(F.col("bucket").alias("__b"), F.col("top.comp").alias("top"), F.col("top.n").alias("n_top"), "all")
    # The first of a bucket has met all others.
    rest = members.filter("node <> first").select(F.col("bucket").alias("__m"), F.col("node").alias("__n"))
    open_ = named.join(rest, F.expr("bucket = __m AND node = __n")).drop("__m", "__n").join(largest.filter("all > 2"), F.expr("bucket = __b")).drop("__b")
    open_ = stored(open_, "open")
    x_blocks, y_blocks = (F.expr(f"cast(ceil({n} / {BLOCK}) as int)") for n in ("(all - n_top)", "all"))
    spread = open_.withColumn("xs", x_blocks).withColumn("ys", y_blocks).withColumn("own", F.xxhash64("node", F.lit("block")))
    left = spread.filter("comp <> top").withColumn("xb", F.expr("cast(pmod(own, xs) as int)")).withColumn("yb", F.explode(F.expr("sequence(0, ys - 1)"))).withColumn("side", F.lit(0))
    right = spread.withColumn("yb", F.expr("cast(pmod(own, ys) as int)")).withColumn("xb", F.explode(F.expr("sequence(0, xs - 1)"))).withColumn("side", F.lit(1))
    placed = left.unionByName(right).select("bucket", "xb", "yb", "side", "node", "comp")
    # Buckets of the same members in the same components ask the same question.
    ask = placed.groupBy("bucket", "xb", "yb").agg(F.array_sort(F.collect_list(F.struct("side", "node", "comp"))).alias("m"))
    ask = ask.filter("m[0].side = 0 AND m[size(m) - 1].side = 1 AND size(m) > 2").dropDuplicates(["m"])
    ask = stored(ask.select("bucket", "xb", "yb", F.explode("m").alias("m")).select("bucket", "xb", "yb", "m.*"), "blocks")
    full = ask.join(sets.select(F.col("node").alias("__n"), "shingles"), F.expr("node = __n")).drop("__n")

    def run(table: pa.Table) -> pa.Table:
        sides: tuple[dict, dict] = {}, {}
        for side, node, c, s in zip(*(table.column(k) for k in ("side", "node", "comp", "shingles"))):
            sides[side.as_py()][node.as_py()] = c.as_py(), s.values.to_numpy()
        found = block_links(*sides, percent)
        return pa.table({"a": pa.array([f[0] for f in found], pa.binary()), "b": pa.array([f[1] for f in found], pa.binary())})

    more = stored(full.groupBy("bucket", "xb", "yb").applyInArrow(run, "a binary, b binary"), "links")
    if not more.isEmpty():
        comp = components(links.unionByName(more))

    return nodes.select("node", "doc_id").join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))


def near_duplicates(docs: DataFrame, words_each: int = 5, percent: int = 80) -> DataFrame:
    """Components of near duplicates in ``docs`` (doc_id, text; other columns are ignored).

    Documents of which the sets of ``words_each``-word shingles (A-Z lower-cased) have
    a Jaccard similarity of ``percent`` / 100 or more are linked. Returns a row per input
    row: doc_id, text_hash, n_shingles, component_id (least doc_id of the component) and
    kept (doc_id = component_id).

    Null or empty texts, and texts without words, have no shingles, are linked with
    nothing and kept. Rows without a doc_id have no part in the links; their
    component_id is null and they are kept. Repeated rows are in one class. A very long text
    is one set like others (16 bytes a word in its task). An empty table gives an empty result. Pairs that share no band are missed (see BANDS);
    every link reported is exact.
    """
    sketches = stored(sketch(docs, words_each, percent), "sketch")
    ids = linked_nodes(docs, sketches.filter("n_shingles > 0 AND doc_id IS NOT NULL"), words_each, percent)
    least = ids.groupBy("comp").agg(F.min("doc_id").alias("component"))
    ids = stored(ids.join(least, "comp").select(F.col("node").alias("__n"), "component"), "component-ids")
    out = sketches.drop("bands").join(ids, F.expr("node = __n"), "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component", "doc_id")).alias("component_id")
    out = out.select("doc_id", "text_hash", "n_shingles", component)
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, words_each: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, with all their columns, without near duplicates: of each
    component one row stays, that of the least doc_id (null last) and then of the least
    text hash. Here rows without a doc_id are linked like others. Texts without
    shingles stay; of rows that agree in doc_id and text one."""
    sketches = stored(sketch(docs, words_each, percent), "sketch")
    comp = linked_nodes(docs, sketches.filter("n_shingles > 0"), words_each, percent).select(F.col("node").alias("__n"), "comp")
    rows = sketches.select("doc_id", "text_hash", "node")
    by_id = rows.join(comp, F.expr("node = __n")).groupBy("comp", "doc_id").agg(F.min("text_hash").alias("text_hash"))
    least = by_id.groupBy("comp").agg(F.min("doc_id").alias("doc_id"), F.coalesce(F.min_by("text_hash", "doc_id"), F.min("text_hash")).alias("text_hash")).drop("comp")
    stay = least.unionByName(rows.filter("node IS NULL").drop("node").distinct()).select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
    keyed = docs.withColumn("__own", F.xxhash64(F.col("text").cast("string"))).withColumn("__doc", F.col("doc_id").cast("long"))
    found = keyed.join(stay, F.expr("__doc <=> __id AND __own = __hash"), "left_semi").dropDuplicates(["__doc", "__own"])
    return found.drop("__own", "__doc")
