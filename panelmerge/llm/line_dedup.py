"""Line de-duplication through a sharded minimal perfect hash.

Every distinct line hash of the corpus gets a slot of a minimal perfect hash.
The hash is cut into shards of a bounded number of lines; a shard is one row
of binary arrays: the bit levels of the hash, a 32-bit fingerprint, a
saturating count and the largest document for each slot. Document lines are
sent to their shard as 16-byte hashes, probe its arrays as they stream by, and
only the verdicts travel back to the documents.

No task holds more than one shard and one batch of probes. Lines of more than
1/2000 of all occurrences (at most 2000 of them) get a small index of their
own, which every task holds: they never meet in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import U64, mix64, raw, shuffle_width, stored

HEAVY = 2000  # a line with more than 1/HEAVY of all occurrences is probed locally
SHARD_LINES = 100_000


def line_hashes(text: bytes | None, min_chars: int) -> list[tuple[int, int] | None]:
    """For each \\n-split line the two 64-bit halves of its key's hash, or None
    if the key (blanks stripped, A-Z lower-cased) has under ``min_chars`` code points."""
    out: list[tuple[int, int] | None] = []
    for line in (text or b"").split(b"\n"):
        key = line.strip().lower()
        if len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars:
            out.append(None)
        else:
            d = xxhash.xxh3_128_intdigest(key)
            out.append(((d >> 64) - (1 << 63), (d & 0xFFFFFFFFFFFFFFFF) - (1 << 63)))
    return out


class PerfectHash:
    """Minimal perfect hash over pairs of 64-bit hashes.

    Level by level, keys that have a bit of the level for themselves set it;
    the others go on to the next level. A key's slot is the rank of its bit.
    """

    SPREAD = 2

    def __init__(self, sizes: list[int], bits: bytes) -> None:
        self.sizes, self.bits = sizes, bits
        self.flags = np.unpackbits(np.frombuffer(bits, np.uint8), count=sum(sizes)).astype(bool)
        self.rank = np.cumsum(self.flags, dtype=np.int64) - 1

    @staticmethod
    def _place(h: np.ndarray, f: np.ndarray, level: int, size: int) -> np.ndarray:
        salt = mix64(np.array([level + 1], dtype=U64))[0]
        return (mix64(mix64(h.view(U64) ^ salt) + f.view(U64)) % U64(size)).astype(np.int64)

    @classmethod
    def build(cls, h: np.ndarray, f: np.ndarray) -> "PerfectHash":
        """h and f: int64 arrays; the pairs must be distinct."""
        sizes, levels = [], []
        while len(h):
            size = cls.SPREAD * len(h) + 1
            at = cls._place(h, f, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            levels.append(alone)
            left = ~alone[at]
            h, f = h[left], f[left]
        return cls(sizes, np.packbits(np.concatenate(levels)).tobytes() if levels else b"")

    def slots(self, h: np.ndarray, f: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 where a key certainly isn't in the set. Other
        keys that aren't in the set get any slot: the fingerprint tells."""
        out, rest, base = np.full(len(h), -1, np.int64), np.arange(len(h)), 0
        for level, size in enumerate(self.sizes):
            at = base + self._place(h[rest], f[rest], level, size)
            hit = self.flags[at]
            out[rest[hit]] = self.rank[at[hit]]
            rest, base = rest[~hit], base + size
            if not len(rest):
                break
        return out


class LineIndex:
    """A shard: the perfect hash and its fingerprint, count and last-document arrays."""

    def __init__(self, sizes, bits, prints, counts, last) -> None:
        self.hash = PerfectHash(list(sizes), bits)
        self.prints = np.frombuffer(prints, np.uint32)
        self.counts = np.frombuffer(counts, np.uint16)
        self.last = np.frombuffer(last, np.int64)

    @staticmethod
    def arrays(h: np.ndarray, f: np.ndarray, n_docs: np.ndarray, last: np.ndarray) -> tuple:
        index = PerfectHash.build(h, f)
        order = np.empty(len(h), np.int64)
        order[index.slots(h, f)] = np.arange(len(h))
        return (
            index.sizes, index.bits, f[order].view(U64).astype(np.uint32).tobytes(),
            np.minimum(n_docs[order], 65535).astype(np.uint16).tobytes(), last[order].astype(np.int64).tobytes(),
        )

    def dropped(self, h: np.ndarray, f: np.ndarray, doc: np.ndarray, known: np.ndarray, min_docs: int) -> np.ndarray:
        """Whether each probed line goes from its document. known: the document has an id."""
        slot = self.hash.slots(h, f)
        found = slot >= 0
        if not len(self.prints):
            return found
        slot = np.maximum(slot, 0)
        found &= self.prints[slot] == f.view(U64).astype(np.uint32)
        return found & (self.counts[slot] >= min_docs) & ~(known & (self.last[slot] == doc))


_INDEX = "sizes array<long>, bits binary, prints binary, counts binary, last_docs binary"


def _numbers(column: pa.Array) -> np.ndarray:
    return np.ascontiguousarray(column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """Drop lines that recur across documents, except in the largest doc_id holding them.

    ``docs`` has doc_id (integer) and text; other columns are ignored. A line's
    key is the line without blanks at its ends and with A-Z lower-cased. Keys of
    ``min_chars`` code points or more in ``min_docs`` documents or more lose all
    their lines but those of the largest doc_id. Returns a row per input row:
    doc_id, n_lines, n_dropped, text (the lines that stay, joined by \\n).

    Null or empty text: one empty line, kept. A null doc_id isn't counted as a
    document and is never the largest; its lines go if their key goes. Rows that
    share a doc_id are one document when counting and get the same verdicts. An
    empty table gives an empty result.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # Verdicts go to a document's text, not to its id: rows without an id, or an id that
    # many rows share, would gather the lines of all their texts in one place.
    docs = docs.withColumn("own", F.xxhash64("text"))

    def keys_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, h, f = [], [], []
            for row, text in enumerate(raw(batch.column(1))):
                for pair in {x for x in line_hashes(text, min_chars) if x}:
                    at.append(row)
                    h.append(pair[0])
                    f.append(pair[1])
            rows = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(2).take(rows), pa.array(h, pa.int64()), pa.array(f, pa.int64())], ["doc_id", "own", "h", "f"])

    keys = stored(docs.mapInArrow(keys_of, "doc_id long, own long, h long, f long"), "lines")
    facts = stored(
        keys.groupBy("h", "f").agg(F.count_distinct("doc_id").alias("n_docs"), F.max("doc_id").alias("last_doc")), "line-facts")

    occurrences, n_lines = keys.count(), facts.count()
    heavy = facts.filter((F.col("n_docs") >= min_docs) & (F.col("n_docs") * HEAVY > occurrences)).toPandas()
    hot = LineIndex.arrays(*(heavy[c].to_numpy(np.int64) for c in ("h", "f", "n_docs", "last_doc")))

    shards = max(shuffle_width(spark), -(-n_lines // SHARD_LINES))
    shard = F.pmod("h", F.lit(shards)).alias("shard")

    def build(table: pa.Table) -> pa.Table:
        made = LineIndex.arrays(*(_numbers(table.column(c).combine_chunks()) for c in ("h", "f", "n_docs", "last_doc")))
        return pa.table({"shard": pa.array([table.column("shard")[0].as_py()], pa.int64()), "sizes": pa.array([made[0]], pa.list_(pa.int64()))} | {
            c: pa.array([x], pa.binary()) for c, x in zip(("bits", "prints", "counts", "last_docs"), made[1:])})

    # A key only in rows without an id has no last document; nothing of it can be dropped.
    index = facts.filter("last_doc IS NOT NULL").select("*", shard).groupBy("shard").applyInArrow(build, f"shard long, {_INDEX}")
    light = keys.join(F.broadcast(spark.createDataFrame(heavy[["h", "f"]], "h long, f long")), ["h", "f"], "left_anti") if len(heavy) else keys
    routed = index.withColumn("kind", F.lit(0)).unionByName(
        light.select(shard, F.lit(1).alias("kind"), "doc_id", "own", "h", "f"), allowMissingColumns=True,
    ).repartition("shard").sortWithinPartitions("shard", "kind")

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = None, None
        for batch in batches:
            col = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            shard_of, kind = _numbers(col["shard"]), _numbers(col["kind"])
            doc, known = _numbers(col["doc_id"]), col["doc_id"].is_valid().to_numpy(zero_copy_only=False)
            h, f = _numbers(col["h"]), _numbers(col["f"])
            gone = np.zeros(len(h), bool)
            edges = np.flatnonzero(np.diff(shard_of, prepend=shard_of[:1] - 1)) if len(shard_of) else []
            for a, b in zip(edges, [*edges[1:], len(h)]):
                if kind[a] == 0:
                    held, at = LineIndex(*(col[c][int(a)].as_py() for c in ("sizes", "bits", "prints", "counts", "last_docs"))), shard_of[a]
                    a += 1
                if at == shard_of[b - 1] and a < b:
                    gone[a:b] = held.dropped(h[a:b], f[a:b], doc[a:b], known[a:b], min_docs)
            names = ["doc_id", "own", "h", "f"]
            yield pa.RecordBatch.from_arrays([col[c].filter(pa.array(gone)) for c in names], names)

    gone = routed.mapInArrow(probe, "doc_id long, own long, h long, f long")
    of_text = gone.distinct().groupBy(F.col("doc_id").alias("__doc"), F.col("own").alias("__own")).agg(F.collect_list("h").alias("hs"), F.collect_list("f").alias("fs"))
    joined = docs.join(of_text, F.expr("own = __own AND doc_id <=> __doc"), "left").select("doc_id", "text", "hs", "fs")

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = LineIndex(*hot)
        for batch in batches:
            texts = [t or b"" for t in raw(batch.column(1))]
            hashes = [line_hashes(t, min_chars) for t in texts]
            flat = [(i, *x) for i, own in enumerate(hashes) for x in own if x]
            at, h, f = np.array(flat, np.int64).reshape(-1, 3).T.copy()
            doc, known = _numbers(batch.column(0)), batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            bad: list[set] = [set(zip(hs.as_py(), fs.as_py())) if hs.is_valid else set() for hs, fs in zip(batch.column(2), batch.column(3))]
            for k in np.flatnonzero(held.dropped(h, f, doc[at], known[at], min_docs)):
                bad[at[k]].add((h[k], f[k]))
            kept = [
                b"\n".join(line for line, x in zip(t.split(b"\n"), own) if x not in gone) if gone else t
                for t, own, gone in zip(texts, hashes, bad)]
            n_lines = [len(own) for own in hashes]
            n_dropped = [sum(x in gone for x in own) if gone else 0 for own, gone in zip(hashes, bad)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string()),
            ], ["doc_id", "n_lines", "n_dropped", "text"])

    return joined.mapInArrow(rewrite, "doc_id long, n_lines long, n_dropped long, text string")
