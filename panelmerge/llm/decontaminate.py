"""Benchmark decontamination by pigeonhole edit matching.

An item with an error budget of k edits is split into k + 1 pieces: a text that
holds the item within k edits holds one piece unchanged. The pieces' hashes go to
the documents, and one pass over each text finds all places where a piece stands; only
the text around them travels on. Joined with the items of the piece, each place says where
an item would have to lie, and Myers' bit-parallel distance decides there.

A place has to begin and end with a word of the text, whatever the item's length, so that a
short answer isn't found inside a longer word. Letters of scripts written without blanks are
words of their own.

Documents are read once for each ``block_chars`` characters of benchmark and aren't
shuffled; the driver and each task hold one block's piece hashes (16 bytes for some 12
characters of benchmark).
"""

from __future__ import annotations

import re
import uuid
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import U64, raw, stored

ERRORS = 0.08  # edits allowed, as a share of the item's characters
MIN_CHARS = 2  # a single character is no item
BLOCK_CHARS = 50_000_000
LONGEST = 16  # of a longer piece only so many characters are looked up
SLICE = 1 << 18  # characters hashed at a time
SEGMENT = 1 << 16  # places that lie closer share a segment up to this length
_NOT_WORD = re.compile(r"[\W_]+")
#: Thai to Tibetan, Myanmar, Khmer, kana, Han: written without blanks.
_NO_BLANKS = re.compile(r"[฀-࿿က-႟ក-៿぀-ヿㇰ-ㇿ㐀-䶿一-鿿豈-﫿\U00020000-\U0003ffff]")

_BASE = 0x9E3779B97F4A7C15
_ODD = U64(0xD6E8FEB86659FD93)
_POWERS: list[np.ndarray] = []


def normalised(text: str | None) -> str:
    """Lower case, every run of other than letters and digits one space; letters of scripts
    without blanks stand alone."""
    text = (text or "").lower()
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        text = _NO_BLANKS.sub(r" \g<0> ", text)
    return _NOT_WORD.sub(" ", text).strip()


def pieces(item: str, errors: float = ERRORS) -> list[tuple[int, str]]:
    """The item in (error budget + 1) pieces of like length, with their offsets."""
    n = int(len(item) * errors) + 1
    cuts = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


@lru_cache(4096)
def _letters(item: str) -> dict[str, int]:
    at: dict[str, int] = defaultdict(int)
    for i, c in enumerate(item):
        at[c] |= 1 << i
    return dict(at)


def best_match(item: str, text: str, start: int, stop: int, words: bool = False) -> tuple[int, int]:
    """Least edit distance of the item to any part of text[start:stop], and where the
    first such part ends: Myers' bit-parallel scan, a column of the table as two integers.
    ``words``: only parts that begin at ``start`` and end with a word of the text."""
    m = len(item)
    full, high = (1 << m) - 1, 1 << (m - 1)
    at = _letters(item)
    plus, minus, score = full, 0, m
    best, end = m + words, start
    for j in range(start, stop):
        match = at.get(text[j], 0)
        vertical = match | minus
        horizontal = (((match & plus) + plus) ^ plus) | match
        up, down = minus | (full & ~(horizontal | plus)), plus & horizontal
        if up & high:
            score += 1
        elif down & high:
            score -= 1
        if score < best and not (words and (text[j] == " " or text[j + 1: j + 2].strip())):
            best, end = score, j + 1
        # Row 0 of the table: each character before the part's begin is free, or one edit.
        up, down = (up << 1 | words) & full, (down << 1) & full
        plus, minus = down | (full & ~(vertical | up)), up & vertical
    return best, end


def nearest(item: str, budget: int, places: list[int], text: str) -> tuple[int, int, int] | None:
    """(distance, start, end) of the nearest part of ``text`` within the budget that begins and
    ends with a word, the first of equals, near ``places`` (ascending) where it may begin.
    A blank stands on either side of the text."""
    m = len(item)
    for p in places:
        if p > 0 and text.startswith(item, p) and text[p - 1] == " " and text[p + m: p + m + 1] == " ":
            return 0, p, p + m
    if not budget:
        return None
    best = None
    groups = np.split(np.array(places), np.flatnonzero(np.diff(places) > m) + 1)
    for group in groups:
        if best_match(item, text, max(0, group[0] - budget), min(len(text), group[-1] + m + 2 * budget))[0] > budget:
            continue
        for s in sorted({s for p in group.tolist() for s in range(max(1, p - budget), min(len(text), p + budget + 1))}):
            if text[s - 1] == " " and text[s] != " ":
                distance, end = best_match(item, text, s, min(len(text), s + m + budget), True)
                if distance <= budget and (best is None or distance < best[0]):
                    best = distance, s, end
    return best


def _powers() -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    if not _POWERS:
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(SLICE + LONGEST, base, U64)
            steps[0] = 1
            _POWERS.append(np.cumprod(steps, dtype=U64))
    return _POWERS


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(U64) + U64(1)


def piece_hash(piece: str) -> int:
    c = codes(piece)
    return int((c * _powers()[0][: len(c)]).sum(dtype=U64).view(np.int64))


class Finder:
    """Where pieces of a block stand in a text: for each piece length the hashes, ascending,
    and how far before and behind a piece its items may reach."""

    def __init__(self, found: pa.Table) -> None:
        size, own, before, behind = (found.column(c).to_numpy() for c in ("size", "hash", "before", "behind"))
        own = own.view(U64)
        self.known = {}
        for s in np.unique(size):
            at = np.flatnonzero(size == s)
            at = at[np.argsort(own[at])]
            self.known[int(s)] = own[at], before[at], behind[at]
        self.tables: dict[int, tuple[np.ndarray, np.uint64]] = {}

    def __getstate__(self):
        return self.known

    def __setstate__(self, known) -> None:
        self.known, self.tables = known, {}

    def _table(self, size: int) -> tuple[np.ndarray, np.uint64]:
        if size not in self.tables:
            own = self.known[size][0]
            bits = max(20, int(len(own) * 8).bit_length())
            table = np.zeros(1 << bits, np.bool_)
            table[((own * _ODD) >> U64(64 - bits)).view(np.int64)] = True
            self.tables[size] = table, U64(64 - bits)
        return self.tables[size]

    def hits(self, text: str) -> tuple[np.ndarray, ...]:
        """place, size, hash, reach before and behind, ascending by place."""
        power, inverse = _powers()
        code, out = codes(text), []
        for a in range(0, len(code), SLICE):
            c = code[a: a + SLICE + LONGEST - 1]
            sums = np.zeros(len(c) + 1, U64)
            np.cumsum(c * power[: len(c)], out=sums[1:])
            for size, (own, before, behind) in self.known.items():
                n = min(len(c) - size + 1, SLICE)
                if n <= 0:
                    continue
                h = (sums[size: size + n] - sums[:n]) * inverse[:n]
                table, shift = self._table(size)
                likely = np.flatnonzero(table[((h * _ODD) >> shift).view(np.int64)])
                h = h[likely]
                k = np.minimum(np.searchsorted(own, h), len(own) - 1)
                right = own[k] == h
                k = k[right]
                out.append((likely[right] + a, np.full(len(k), size), own[k].view(np.int64), before[k], behind[k]))
        if not out:
            return tuple(np.zeros(0, np.int64) for _ in range(5))
        joined = [np.concatenate(x) for x in zip(*out)]
        order = np.argsort(joined[0], kind="stable")
        return tuple(x[order] for x in joined)


def segments(text: str, finder: Finder, longest: int = SEGMENT) -> Iterator[tuple[int, str, list[int], list[int], list[int]]]:
    """(start, text, sizes, hashes, places in the segment) around the hits; every hit's whole
    reach lies in its segment."""
    at, sizes, hashes, before, behind = finder.hits(text)
    lo, hi = np.maximum(at - before, 0).tolist(), np.minimum(at + behind, len(text)).tolist()
    first, start, stop = 0, len(text), 0
    for i in range(len(lo)):
        start, stop = min(start, lo[i]), max(stop, hi[i])
        if i + 1 == len(lo) or lo[i + 1] > stop or stop - start >= longest:
            yield start, text[start:stop], sizes[first:i + 1].tolist(), hashes[first:i + 1].tolist(), (at[first:i + 1] - start).tolist()
            first, start, stop = i + 1, len(text), 0


ITEM = "item_id long, key binary, item string"
PIECE = "size int, hash long, key binary, offset int, before int, behind int"
SEGMENTS = "block int, uid binary, doc_id long, hash_1 long, hash_2 long, start long, text string, sizes array<int>, hashes array<long>, places array<int>"
FOUND = "uid binary, doc_id long, hash_1 long, hash_2 long, key binary, distance long, item_chars long, start long, end long"
LEAK = "doc_id long, item_id long, distance long, item_chars long, start long, end long"


def _decoded(column: pa.Array) -> list[str]:
    return [(t or b"").decode("utf-8", "replace") for t in raw(column)]


def _items(benchmark: DataFrame, min_chars: int) -> DataFrame:
    """item_id, key and normalised text of all items of at least ``min_chars``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items = [normalised(t) for t in _decoded(batch.column(1))]
            keys = [xxhash.xxh3_128_digest(t.encode()) for t in items]
            whole = pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary()), pa.array(items, pa.string())], ["item_id", "key", "item"])
            yield whole.filter(pa.array([len(t) >= max(1, min_chars) for t in items], pa.bool_()))

    return benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, ITEM)


def _pieces(items: DataFrame, errors: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, item in zip(batch.column(0).to_pylist(), _decoded(batch.column(1))):
                m, k = len(item), int(len(item) * errors)
                # Without edits the one piece is the item with the blanks around it.
                for offset, piece in pieces(item, errors) if k else [(-1, f" {item} ")]:
                    piece = piece[:LONGEST]
                    out.append((len(piece), piece_hash(piece), key, offset, offset + k + 1, m - offset + 2 * k + 1))
            kinds = (pa.int32(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], ["size", "hash", "key", "offset", "before", "behind"])

    return items.mapInArrow(run, PIECE)


def _scan(texts: DataFrame, finder: Finder, block: int) -> DataFrame:
    shared, longest = texts.sparkSession.sparkContext.broadcast(finder), SEGMENT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32()))
        names = ["block", "uid", "doc_id", "hash_1", "hash_2", "start", "text", "sizes", "hashes", "places"]
        for batch in batches:
            out = []
            for doc, one, two, text in zip(*(batch.column(i).to_pylist() for i in range(3)), raw(batch.column(3))):
                uid = None
                for found in segments(f" {normalised((text or b'').decode('utf-8', 'replace'))} ", shared.value, longest):
                    uid = uid or uuid.uuid4().bytes
                    out.append((block, uid, doc, one, two, *found))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], names)

    return texts.mapInArrow(run, SEGMENTS)


def _text_hashes() -> tuple:
    text = F.col("text").cast("string")
    return F.xxhash64(text), F.xxhash64(F.lit("leak"), text)


def _search(docs: DataFrame, items: DataFrame, errors: float, block_chars: int) -> DataFrame:
    """FOUND: the nearest place of each item in each row of ``docs`` that holds it."""
    spark = docs.sparkSession
    unique = stored(items.select("key", "item").dropDuplicates(["key"]), "leak-items")
    chars, n = unique.agg(F.sum(F.length("item")), F.count("*")).first()
    blocks = min(n, -(-(chars or 0) // block_chars))
    # All pieces of an item are in one block, so a row meets an item in one scan only.
    parts = stored(_pieces(unique, errors).withColumn("block", F.pmod(F.xxhash64("key"), F.lit(max(1, blocks))).cast("int")), "leak-pieces")
    reach = parts.groupBy("block", "size", "hash").agg(F.max("before").alias("before"), F.max("behind").alias("behind"))
    one, two = _text_hashes()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), one.alias("hash_1"), two.alias("hash_2"), F.col("text").cast("string").alias("text"))
    found = spark.createDataFrame([], SEGMENTS)
    for block in range(blocks):
        known = reach.filter(F.col("block") == block).toArrow()
        if known.num_rows:
            found = found.unionByName(_scan(texts, Finder(known), block))
    found = stored(found, "leak-segments") if blocks else found

    places = found.select("block", "uid", "start", F.explode(F.arrays_zip("sizes", "hashes", "places")).alias("h")).select(
        "block", "uid", "start", F.col("h.sizes").alias("size"), F.col("h.hashes").alias("hash"), F.col("h.places").alias("place"))
    asked = places.join(parts, ["block", "size", "hash"]).groupBy("block", "uid", "start", "key").agg(F.sort_array(F.collect_set(F.expr("place - offset"))).alias("begins"))
    asked = asked.join(unique, "key").join(found.select("block", "uid", "start", "doc_id", "hash_1", "hash_2", "text"), ["block", "uid", "start"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (*[pa.int64()] * 4, pa.bool_())
        for batch in batches:
            out = []
            for start, begins, item, text in zip(batch.column("start").to_pylist(), batch.column("begins").to_pylist(), _decoded(batch.column("item")), _decoded(batch.column("text"))):
                got = nearest(item, int(len(item) * errors), begins, text)
                # A blank was put before the text.
                out.append((got[0], len(item), start + got[1] - 1, start + got[2] - 1, True) if got else (None, None, None, None, False))
            distance, size, first, last, held = (pa.array([r[i] for r in out], t) for i, t in enumerate(kinds))
            whole = [*(batch.column(c) for c in ("uid", "doc_id", "hash_1", "hash_2", "key")), distance, size, first, last]
            yield pa.RecordBatch.from_arrays(whole, ["uid", "doc_id", "hash_1", "hash_2", "key", "distance", "item_chars", "start", "end"]).filter(held)

    near = asked.mapInArrow(run, FOUND)
    # A row has another uid in each block, but all places of an item are in one.
    best = near.groupBy("uid", "doc_id", "hash_1", "hash_2", "key", "item_chars").agg(F.min(F.struct("distance", "start", "end")).alias("b"))
    return best.select("uid", "doc_id", "hash_1", "hash_2", "key", "item_chars", "b.*")


def find_leaks(docs: DataFrame, benchmark: DataFrame, errors: float = ERRORS, block_chars: int = BLOCK_CHARS, min_chars: int = MIN_CHARS) -> DataFrame:
    """A row for each row of ``docs`` (doc_id, text) and item of ``benchmark`` (item_id,
    text) that it holds within ``errors`` edits per character: doc_id, item_id, distance,
    item_chars, start and end of the nearest place, in characters of the normalised text.

    Both sides are normalised: lower case, runs of other than letters and digits as one
    space, letters of scripts without blanks as words of their own. The place begins and
    ends with a word. Items of under ``min_chars``, null or empty ones among them, and items
    without an id are left out. Null or empty texts hold nothing; very long texts are
    hashed in slices, as a whole, and very long items cost Myers' scan on integers of their
    length. Rows with a null doc_id are searched and reported with it. Repeated documents are
    reported each; of repeated items every id. Empty tables give an empty result. Other
    columns are ignored.
    """
    items = stored(_items(benchmark, min_chars), "leak-benchmark")
    names = items.filter("item_id IS NOT NULL").select("item_id", "key").distinct()
    found = _search(docs, items.filter("item_id IS NOT NULL"), errors, block_chars)
    return found.join(names, "key").select("doc_id", "item_id", "distance", "item_chars", "start", "end")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, errors: float = ERRORS, block_chars: int = BLOCK_CHARS, min_chars: int = MIN_CHARS) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no item of ``benchmark``,
    whether the item has an id or not; see find_leaks. Rows go by two hashes of their text, so
    documents are shuffled only where the leaking texts are too many for Spark to broadcast."""
    items = stored(_items(benchmark, min_chars), "leak-benchmark")
    leaks = stored(_search(docs, items, errors, block_chars).select("hash_1", "hash_2").distinct(), "leak-texts")
    one, two = _text_hashes()
    leaks = leaks.select(F.col("hash_1").alias("__leak_1"), F.col("hash_2").alias("__leak_2"))
    return docs.join(leaks, (one == F.col("__leak_1")) & (two == F.col("__leak_2")), "left_anti")
