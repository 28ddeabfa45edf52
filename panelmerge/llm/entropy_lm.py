"""LM scoring by a hashed maximum-entropy model with a class-factored softmax.

P(word | context) = P(class | context) x P(word | class). The class is a softmax over two
context features: the word before (an n-gram feature), and the one before that (a skip
feature). Words are classed by hashed spelling: the ``VOCABULARY`` most frequent in
``CLASSES`` - 1 classes, the others, by beginning, end and accents, in classes of their own, which
grow with the counted types. Each of these also has a word that was never seen, with a count of 0, plus 1.

Every counted word has a row of weights for both features. The rows of the ``DENSE`` most
frequent, and one that all others share, come from rounds of distributed gradient
updates: in a round every task runs minibatch updates on its share of the training texts,
starting from the common weights; Spark averages the changes, weighted by the tokens that
touched the row. The row of any other word is one gradient step more, from the shared row, scaled by
curvature: Spark sums the classes that followed the word, and the gradient is what was
seen less what the shared row expects. So a word travels as its few class counts, not as a
vector of weights, and meets the texts only once, for scoring.

Texts are cut into chunks of ``CHUNK_BYTES``, a longer text into pieces that know the two
words before them, and stored as numbers of words: the texts are split into words for the counts
and once more for all that follows. Each chunk is joined with the words it holds.

The softmax over two rows takes the exponential of each row, not of each token: e^(a + b) is
e^a times e^b, so a token costs products and their sum.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import BLANKS, LOWER, UPPER, id_remainder, raw, stored

END = b"\n"  # the end token; no word has a blank
VOCABULARY = 80_000  # words that each task holds, with counts and classes
DENSE = 8192  # of them with rows from the rounds
CLASSES = 32  # of frequent words, and the first class of the others
CHUNK_BYTES = 1 << 22
CHUNKS_PER_FILE = 16  # a reader or writer of values of some MB holds those of a file at once
ROUNDS = 2
BATCH = 16_384
SCORED = 4096  # tokens scored at once, so their rows stay in the cache
RATE = 0.5
CAUTION = 4.0  # what is added to the curvature in the last step
SPELLING = 192  # places that a word's byte n-grams hash to
MARKS = 4096  # places that a word's beginning, end and least common letter hash to
CLASSED = 30_000  # most frequent words, which the classes are made from
COUNT_BYTES = 1 << 23  # text that a counting task takes at once
START = -(1 << 40)  # before the first word
SHORT = 16  # values of a run that are added with those of other runs
LEAST = 1e-30  # a smaller sum of products may have lost its terms
PLAIN = bytes.maketrans((UPPER + BLANKS).encode(), (LOWER + " " * len(BLANKS)).encode())


def words_in(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts in order, A-Z lower-cased, and how many each text has."""
    blank = np.ones(sum(map(len, texts)) + len(texts) + 1, bool)
    data = np.frombuffer(b" ".join(texts).translate(PLAIN), np.uint8)
    np.equal(data, 32, out=blank[1:len(data) + 1])
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    starts, stops = edges[::2], edges[1::2]
    offsets = np.append(0, np.cumsum(stops - starts))
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[~blank[1:len(data) + 1]])])
    ends = np.cumsum([len(t) + 1 for t in texts])
    return words, np.diff(np.searchsorted(starts, ends), prepend=0)


def token_counts(docs: DataFrame) -> DataFrame:
    """token, n over whole texts, the end token of every text included. ``docs``: text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out():
            found = words_in(held)[0].value_counts()
            words = pa.chunked_array([found.field("values").cast(pa.string()), pa.array([END.decode()])])
            n = pa.chunked_array([found.field("counts"), pa.array([ends], pa.int64())])
            return pa.Table.from_arrays([words, n], ["token", "n"]).combine_chunks().to_batches()

        held, size, ends = [], 0, 0
        for batch in batches:
            for text in raw(batch.column(0)):
                for _, piece, _ in pieces(text or b"", COUNT_BYTES):
                    held.append(piece)
                    size += len(piece)
                    if size >= COUNT_BYTES:
                        yield from out()
                        held, size, ends = [], 0, 0
                ends += 1
        if held or ends:
            yield from out()

    return docs.select(F.col("text").cast("string")).mapInArrow(count, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))


def frequent_tokens(counts: DataFrame, limit: int = VOCABULARY) -> pd.DataFrame:
    """The most frequent tokens, ``limit`` at most, most frequent first.

    Cut at a step of a geometric scale of counts, found from the number of tokens on
    each step (some hundred rows), and in that step by count and hash piece: sorting for
    an exact number would send so many rows of every partition to one place."""
    step, piece = F.floor(F.log2("n") * 16).cast("int"), F.pmod(F.xxhash64("token"), F.lit(4096))
    sizes = counts.groupBy(step.alias("step")).agg(F.count("*").alias("tokens")).toPandas().sort_values("step", ascending=False)
    over = sizes[sizes["tokens"].cumsum() > limit]
    if over.empty:
        return counts.toPandas().sort_values(["n", "token"], ascending=[False, True])
    cut = int(over["step"].iloc[0])
    room = limit - int(sizes.loc[sizes["step"] > cut, "tokens"].sum())
    parts = counts.filter(step == cut).groupBy("n", piece.alias("piece")).agg(F.count("*").alias("tokens")).toPandas().sort_values(["n", "piece"], ascending=[False, True])
    fit = parts[parts["tokens"].cumsum() <= room]
    taken = step > cut
    if len(fit):
        n, last = int(fit["n"].iloc[-1]), int(fit["piece"].iloc[-1])
        taken = taken | (step == cut) & ((F.col("n") > n) | (F.col("n") == n) & (piece <= last))
    return counts.filter(taken).toPandas().sort_values(["n", "token"], ascending=[False, True])


def spelling_vectors(words: list[bytes]) -> np.ndarray:
    """How many of each word's 1- to 3-grams of bytes, ends marked, hash to each place."""
    if not words:
        return np.zeros((0, SPELLING))
    letters = np.frombuffer(b"^" + b"$^".join(words) + b"$", np.uint8).astype(np.uint64)
    own = np.repeat(np.arange(len(words)), [len(w) + 2 for w in words])
    places, owners, gram = [], [], letters
    for n in (1, 2, 3):
        if n > 1:
            gram = gram[:-1] * np.uint64(257) + letters[n - 1:]
        within = own[n - 1:] == own[:len(own) - n + 1]
        hashed = ((gram[within] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
        places.append(hashed.astype(np.int64) % SPELLING)
        owners.append(own[:len(own) - n + 1][within])
    at = np.concatenate(owners) * SPELLING + np.concatenate(places)
    return np.bincount(at, minlength=len(words) * SPELLING).reshape(-1, SPELLING).astype(float)


def spelling_classes(vectors: np.ndarray, counts: np.ndarray, classes: int, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """A class from 0 for each word (most frequent first), and the classes' centres:
    k-means over spelling vectors, words weighing as the root of their counts. Starts
    from the most frequent words; the same words give the same classes."""
    weight = np.sqrt(counts)[:, None].astype(np.float32)
    centres = vectors[:classes].copy()
    own = np.zeros(len(vectors), np.int64)
    for _ in range(rounds):
        own = (vectors @ centres.T).argmax(axis=1) if len(vectors) else own
        sums = np.zeros_like(centres)
        np.add.at(sums, own, vectors * weight)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norm > 0, sums / np.maximum(norm, 1e-9), centres)
    return own, centres


def nearest(words: list[bytes], centres: np.ndarray) -> np.ndarray:
    """Number of the centre that a word's spelling is most like."""
    out = np.zeros(len(words), np.int64)
    if len(centres):
        for i in range(0, len(words), 4096):
            out[i:i + 4096] = (spelling_vectors(words[i:i + 4096]) @ centres.T).argmax(axis=1)
    return out


def spelling_marks(words: list[bytes]) -> np.ndarray:
    """words x 3: hashed first and last two bytes, and the greatest pair of bytes (in an accented
    word the accented letter)."""
    letters = np.frombuffer(b"^" + b"$^".join(words) + b"$", np.uint8).astype(np.int64)
    sizes = np.array([len(w) + 2 for w in words])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    pairs = letters[:-1] * 256 + letters[1:]
    within = pairs.copy()
    within[ends[:-1] - 1] = 0
    marks = np.stack([pairs[starts + 1], pairs[ends - 3], np.maximum.reduceat(within, starts)], axis=1)
    return (marks * 0x9E3779B1 >> 16) % MARKS


class Vocabulary:
    """Frequent words by number from 1 (0: any other), their classes and their share of their class."""

    def __init__(self, words: list[bytes], counts: np.ndarray, tokens: int, types: int) -> None:
        self.words, self.dense = words, min(DENSE, len(words))
        self.number = {w: i + 1 for i, w in enumerate(words)}
        self.tokens, self.types = tokens, types
        self.known = np.concatenate([[0.0], np.log10(counts + 1.0)])
        smooth = counts + 1.0
        vectors = spelling_vectors(words[:CLASSED]).astype(np.float32)
        vectors /= np.maximum(1e-9, np.linalg.norm(vectors, axis=1, keepdims=True))
        _, centres = spelling_classes(vectors, counts[:CLASSED], CLASSES - 1)
        bins = nearest(words, np.round(1000 * centres.astype(float)))
        self.cls = np.concatenate([[CLASSES - 1], bins])
        mass = np.bincount(bins, weights=smooth, minlength=CLASSES)
        self.inside = np.concatenate([[0.0], np.log10(smooth / mass[bins])])
        # The others' classes: four more each time that the types double.
        rare_classes = 1 + int(4 * np.log2(max(1.0, types / max(1, len(words)))))
        own, _ = spelling_classes(vectors, counts[:CLASSED], rare_classes)
        # What each mark says for each class, from the frequent words of the class.
        self.mark_scores = np.zeros((3, MARKS, rare_classes), np.float32)
        if len(words):
            prior = np.bincount(own, minlength=rare_classes) + 1.0
            for k, marks in enumerate(spelling_marks(words[:CLASSED]).T):
                seen = np.bincount(marks * rare_classes + own, minlength=MARKS * rare_classes).reshape(MARKS, rare_classes)
                self.mark_scores[k] = np.log((seen + prior / prior.sum()) / prior)
        self.classes = CLASSES - 1 + rare_classes
        self.rare_masses = np.ones(rare_classes)  # of each class, an unseen word included

    def numbers(self, words: list[bytes]) -> np.ndarray:
        get = self.number.get
        return np.fromiter(map(get, words, repeat(0)), np.int64, len(words))

    def rare_class(self, words: list[bytes]) -> np.ndarray:
        """Classes of words that aren't frequent, by the marks of their spelling."""
        if not words or self.mark_scores.shape[2] == 1:
            return np.full(len(words), CLASSES - 1)
        marks = spelling_marks(words)
        scores = self.mark_scores[0][marks[:, 0]]
        for k in (1, 2):
            scores += self.mark_scores[k][marks[:, k]]
        return CLASSES - 1 + scores.argmax(axis=1)


def word_keys(words: list[bytes]) -> np.ndarray:
    """64 bits of hash of each word."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)).view(np.int64)


# ---- chunks of texts

def pieces(text: bytes, size: int) -> Iterator[tuple[bytes, bytes, bool]]:
    """(the two words before, piece, whether it is the last) of a text, cut at blanks."""
    start, before = 0, b""
    while True:
        stop = start + size
        while stop < len(text) and text[stop] not in b" \t\n\x0b\x0c\r":
            stop += 1
        piece = text[start:stop]
        yield before, piece, stop >= len(text)
        if stop >= len(text):
            return
        before, start = b" ".join((before.split() + piece.split()[-2:])[-2:]), stop


class Tokens:
    """Tokens of some pieces. ``ids``: frequent words by number, any other word ``names[-1 - id]``,
    the names in order of their ``keys``. ``one``, ``two``: the ids before and two before, or START.
    ``cls``: classes, ``row``: the piece."""

    def __init__(self, rows: list[tuple[bytes, bytes, bool]], vocabulary: Vocabulary) -> None:
        words, sizes = words_in([before + b" " + text for before, text, _ in rows])
        last = np.array([last for *_, last in rows], bool)
        self.known = np.array([len(before.split()) for before, *_ in rows], np.int64)
        coded = words.dictionary_encode()
        distinct = [*coded.dictionary.to_numpy(zero_copy_only=False).tolist(), *([END] if last.any() else [])]  # no word is the end
        numbers = vocabulary.numbers(distinct)
        rare = np.flatnonzero(numbers == 0)
        keys = word_keys([distinct[i] for i in rare.tolist()])
        order = np.argsort(keys, kind="stable")
        rare, self.keys = rare[order], keys[order]
        numbers[rare] = -1 - np.arange(len(rare))
        self.names = [distinct[i] for i in rare.tolist()]
        self.sizes = sizes + last
        ends = np.cumsum(self.sizes)[last] - 1
        self.flat = np.empty(int(self.sizes.sum()), np.int32)
        within = np.ones(len(self.flat), bool)
        within[ends] = False
        self.flat[within] = numbers[coded.indices.to_numpy()]
        if len(ends):
            self.flat[ends] = numbers[-1]
        self.rare_cls = vocabulary.rare_class(self.names)
        self.place(vocabulary)

    def place(self, vocabulary: Vocabulary) -> None:
        """``ids``, ``one``, ``two``, ``row`` and ``cls`` from the others."""
        flat, sizes = self.flat.astype(np.int64), self.sizes
        starts = np.cumsum(sizes) - sizes
        one, two = np.full(len(flat), START), np.full(len(flat), START)
        one[1:], two[2:] = flat[:-1], flat[:-2]
        first = starts[sizes > 0]
        one[first] = two[first] = START
        two[starts[sizes > 1] + 1] = START
        row = np.repeat(np.arange(len(sizes)), sizes)
        if self.known.any():  # the words before aren't scored here
            scored = np.arange(len(flat)) - starts[row] >= self.known[row]
            flat, one, two, row = flat[scored], one[scored], two[scored], row[scored]
        self.ids, self.one, self.two, self.row = flat, one, two, row
        classes = np.append(vocabulary.cls, self.rare_cls[::-1])  # an id below 0 counts from the end
        self.cls = classes[flat]

    def packed(self) -> dict[str, np.ndarray]:
        """Columns that ``unpacked`` reads: each byte of the numbers apart, as the high ones are much alike."""
        return {"flat": self.flat.view(np.uint8).reshape(-1, 4).T.ravel(), "sizes": self.sizes.astype(np.int32), "known": self.known.astype(np.int8), "rare": self.rare_cls.astype(np.int16)}

    @classmethod
    def unpacked(cls, columns: dict[str, np.ndarray], vocabulary: Vocabulary) -> Tokens:
        """As they were packed, without ``names`` and ``keys``."""
        self = cls.__new__(cls)
        self.flat = np.ascontiguousarray(columns["flat"].reshape(4, -1).T).view(np.int32).ravel()
        self.sizes, self.known, self.rare_cls = (columns[c].astype(np.int64) for c in ("sizes", "known", "rare"))
        self.place(vocabulary)
        return self

    def only(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``one``, ``two`` and ``cls`` of the pieces where ``rows`` holds."""
        part = rows[self.row]
        return self.one[part], self.two[part], self.cls[part]


def in_chunks(docs: DataFrame, shared_vocabulary) -> DataFrame:
    """The texts of ``docs`` (doc_id, text, round) as numbers, a row for each chunk of about CHUNK_BYTES of
    text: tokens, with row number, id and round of each piece, and the keys of the words that aren't frequent."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out():
            doc_id, row, rounds, *texts = zip(*held)
            tokens = Tokens(list(zip(*texts)), shared_vocabulary.value)
            ids = pa.array(doc_id, pa.int64())
            columns = {**tokens.packed(), "row": np.array(row), "doc_id": ids.fill_null(0).to_numpy(), "no_id": ids.is_null().to_numpy(False).astype(np.int8), "round": np.array(rounds, np.int16)}
            return pa.RecordBatch.from_arrays([pa.array([chunk]), pa.array([pack_columns(columns)], pa.binary()), pa.array([tokens.keys.tobytes()], pa.binary())], ["chunk", "tokens", "keys"])

        first = TaskContext.get().partitionId() << 33
        held, size, row, chunk = [], 0, first, first
        for batch in batches:
            for doc_id, text, r in zip(batch.column(0).to_pylist(), raw(batch.column(1)), batch.column(2).to_pylist()):
                for before, piece, last in pieces(text or b"", CHUNK_BYTES):
                    held.append((doc_id, row, -1 if r is None else r, before, piece, last))
                    size += len(piece) + 1
                    if size >= CHUNK_BYTES:
                        yield out()
                        held, size, chunk = [], 0, chunk + 1
                row += 1
        if held:
            yield out()

    return docs.select("doc_id", "text", "round").mapInArrow(cut, "chunk long, tokens binary, keys binary")


def chunk_values(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary) -> Iterator[tuple[Tokens, dict[str, np.ndarray], list[bytes]]]:
    """Tokens and columns of each row (tokens, others), and its other values."""
    for batch in batches:
        for i in range(batch.num_rows):
            columns = unpack_columns(batch.column(0)[i].as_buffer())
            yield Tokens.unpacked(columns, vocabulary), columns, [c[i].as_py() for c in batch.columns[1:]]


# ---- rounds of gradient updates

def feature_rows(one: np.ndarray, two: np.ndarray, dense: int) -> np.ndarray:
    """Rows of the weights (tokens x 2): of the words before, if they are dense; the other words share
    a row for each feature, and so does the start."""
    def row(ids):
        return np.where(ids == START, 0, np.where((ids > 0) & (ids <= dense), ids + 1, 1))
    return np.stack([2 * row(one), 2 * row(two) + 1], axis=1)


def class_log_probs(z: np.ndarray) -> np.ndarray:
    """Natural log softmax over classes."""
    z = z - z.max(axis=1, keepdims=True)
    z -= np.log(np.exp(z).sum(axis=1, keepdims=True))
    return z


def rated(weights: np.ndarray, features: np.ndarray) -> np.ndarray:
    """Sums of the features' rows and the bias, which is the last row."""
    z = weights.take(features[:, 0], axis=0)
    z += weights.take(features[:, 1], axis=0)
    z += weights[-1]
    return z


def add_by_row(values: np.ndarray, part: tuple[np.ndarray, ...], out: np.ndarray) -> None:
    """Sums of ``values`` by runs of an order (starts, sizes): the first values of all short runs, and to them the
    second ones, and so on; the long runs one by one."""
    order, _, starts, sizes = part
    short = np.flatnonzero(sizes <= SHORT)
    short = short[np.argsort(-sizes[short], kind="stable")]
    first, longer = starts[short], np.cumsum(np.bincount(sizes[short], minlength=SHORT + 1)[::-1])[::-1]
    sums = values.take(order[first], axis=0)
    for k in range(1, SHORT):
        n = longer[k + 1]
        if not n:
            break
        sums[:n] += values.take(order[first[:n] + k], axis=0)
    out[short] = sums
    for i in np.flatnonzero(sizes > SHORT).tolist():
        out[i] = values.take(order[starts[i]:starts[i] + sizes[i]], axis=0).sum(axis=0)


def update(weights: np.ndarray, squares: np.ndarray, touched: np.ndarray, features: np.ndarray, cls: np.ndarray) -> None:
    """One minibatch step: gradient of the mean log loss by row, scaled by the root of its
    running sum of squares (kept by row)."""
    parts, gradient = [], None
    for feature in (0, 1):
        rows = features[:, feature]
        order = np.argsort(rows.astype(np.uint16) if len(weights) < 1 << 16 else rows, kind="stable")  # short integers sort by radix
        rows = rows[order]
        starts = np.flatnonzero(np.diff(rows, prepend=-1))
        own, sizes = rows[starts], np.diff(np.append(starts, len(rows)))
        e = weights.take(own, axis=0)
        if not feature:
            e += weights[-1]
        e -= e.max(axis=1, keepdims=True)
        np.exp(e, out=e)
        at = np.empty(len(rows), np.int64)
        at[order] = np.repeat(np.arange(len(own)), sizes)
        parts.append((order, own, starts, sizes))
        gradient = np.multiply(gradient, e.take(at, axis=0), out=gradient) if feature else e.take(at, axis=0)
    total = gradient @ np.ones(gradient.shape[1], np.float32)
    least = np.flatnonzero(total < LEAST)
    total[least] = 1
    gradient *= (1 / total)[:, None]
    gradient[least] = np.exp(class_log_probs(rated(weights, features[least])))
    gradient[np.arange(len(cls)), cls] -= 1
    own = np.concatenate([*(p[1] for p in parts), [len(weights) - 1]])
    counts = np.concatenate([*(p[3] for p in parts), [len(cls)]])
    mean = np.empty((len(own), gradient.shape[1]), np.float32)
    first = len(parts[0][1])
    add_by_row(gradient, parts[0], mean[:first])
    add_by_row(gradient, parts[1], mean[first:-1])
    mean[-1] = mean[:first].sum(axis=0)
    mean *= (1 / np.sqrt(counts)).astype(np.float32)[:, None]
    squares[own] += mean**2 @ np.full(mean.shape[1], 1 / mean.shape[1], np.float32)
    touched[own] += counts
    weights[own] -= (RATE / np.sqrt(squares[own] + 1e-6))[:, None].astype(np.float32) * mean


def packed(x: np.ndarray) -> pa.Array:
    """Each row as half-precision numbers."""
    data, size = np.ascontiguousarray(x, np.float16).tobytes(), 2 * x.shape[1]
    return pa.array([data[i:i + size] for i in range(0, len(data), size)], pa.binary())


def unpacked(values: list[bytes], classes: int) -> np.ndarray:
    return np.frombuffer(b"".join(values), np.float16).reshape(-1, classes).astype(np.float32)


CHANGES = "row int, n long, change binary"


def add_up(batches: Iterator[pa.RecordBatch], classes: int) -> Iterator[pa.RecordBatch]:
    """Mean change by row, weighted by the tokens that touched it: a bounded number of rows."""
    sums: dict[int, list] = {}
    for batch in batches:
        for row, n, change in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), unpacked(batch.column(2).to_pylist(), classes)):
            own = sums.setdefault(row, [0, 0.0])
            own[0] += n
            own[1] = own[1] + n * change.astype(float)
    if sums:
        mean = np.stack([total / n for n, total in sums.values()])
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([n for n, _ in sums.values()], pa.int64()), packed(mean)], ["row", "n", "change"])


def train_classes(chunked: DataFrame, vocabulary: Vocabulary, shared_vocabulary, rounds: int = ROUNDS) -> np.ndarray:
    """Weights (rows + 1 x classes, float32; the last row is the bias) of the dense words."""
    spark, classes = chunked.sparkSession, vocabulary.classes
    weights = np.zeros((2 * (vocabulary.dense + 2) + 1, classes), np.float32)
    prior = np.bincount(vocabulary.cls[1:], weights=10 ** vocabulary.known[1:], minlength=classes).astype(float)
    prior[CLASSES - 1:] += vocabulary.rare_masses
    weights[-1] = np.log(np.maximum(prior, 1e-3) / max(1e-3, prior.sum()))
    for r in range(rounds):
        shared = spark.sparkContext.broadcast(weights)

        def learn(batches: Iterator[pa.RecordBatch], shared=shared, r=r) -> Iterator[pa.RecordBatch]:
            start, own = shared.value, shared.value.copy()
            squares, touched = np.zeros(len(own)), np.zeros(len(own), np.int64)
            held = []
            for tokens, columns, _ in chunk_values(batches, shared_vocabulary.value):
                one, two, cls = tokens.only(columns["round"] == r)
                held.append((feature_rows(one, two, shared_vocabulary.value.dense), cls))
                x, cls = (np.concatenate(part) for part in zip(*held))
                whole = len(cls) - len(cls) % BATCH
                for i in range(0, whole, BATCH):
                    update(own, squares, touched, x[i:i + BATCH], cls[i:i + BATCH])
                held = [(x[whole:], cls[whole:])]
            for x, cls in held:
                if len(cls):
                    update(own, squares, touched, x, cls)
            some = np.flatnonzero(touched)
            if len(some):
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(touched[some]), packed(own[some] - start[some])], ["row", "n", "change"])

        changes = chunked.select("tokens").mapInArrow(learn, CHANGES).repartition("row").mapInArrow(lambda batches: add_up(batches, classes), CHANGES)
        mean = stored(changes, "lm-changes", free_shuffles=True).toPandas().sort_values("row")  # the dense words at most
        weights = weights.copy()
        if len(mean):
            weights[mean["row"].to_numpy()] += unpacked([bytes(x) for x in mean["change"]], classes)
        shared.destroy()
    return weights


# ---- rows of the other words

CLASS_COUNTS = "key long, codes array<long>"


def coded(keys: np.ndarray, slots: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """A row for each key with the codes (count << 16 | slot) of its slots; ``keys`` in order."""
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(keys)), pa.int32()), pa.array(n.astype(np.int64) << 16 | slots, pa.int64()))
    return pa.RecordBatch.from_arrays([pa.array(keys[starts], pa.int64()), lists], ["key", "codes"])


def summed(ids: np.ndarray, slots: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums of ``n`` by id and slot, in order."""
    order = np.lexsort((slots, ids))
    ids, slots, n = ids[order], slots[order], n[order]
    starts = np.flatnonzero(np.append(True, (ids[1:] != ids[:-1]) | (slots[1:] != slots[:-1]))) if len(ids) else np.zeros(0, np.int64)
    return ids[starts], slots[starts], np.add.reduceat(n, starts) if len(starts) else n


def tallied(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order, and how often each comes."""
    codes = np.sort(codes)
    starts = np.flatnonzero(np.append(True, codes[1:] != codes[:-1])) if len(codes) else np.zeros(0, np.int64)
    return codes[starts], np.diff(np.append(starts, len(codes)))


def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a key; rows come in order of the keys."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        lists = batch.column(1)
        codes, sizes = lists.flatten().to_numpy(), lists.value_lengths().to_numpy()
        own = np.repeat(batch.column(0).to_numpy(), sizes), codes & 0xFFFF, codes >> 16
        if held is not None:
            own = tuple(np.concatenate(x) for x in zip(held, own))
        keys, slots, n = summed(*own)
        last = keys == keys[-1]
        if not last.all():
            yield coded(keys[~last], slots[~last], n[~last])
        held = keys[last], slots[last], n[last]
    if held is not None:
        yield coded(*held)


def class_counts(chunked: DataFrame, vocabulary: Vocabulary, shared_vocabulary) -> DataFrame:
    """key, codes: how often each class followed each word that isn't dense, in training texts.
    A slot is a class behind the word, or, from ``classes`` on, one place further on."""
    classes = vocabulary.classes

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared_vocabulary.value
        sums = np.zeros((len(words.words) + 1 - words.dense) * 2 * classes, np.int32)  # of the frequent words that aren't dense
        for tokens, columns, (keys,) in chunk_values(batches, words):
            one, two, cls = tokens.only(columns["round"] >= 0)
            ids, slots = np.concatenate([one, two]), np.concatenate([cls, cls + classes])
            part = ids > words.dense
            at, n = tallied((ids[part] - words.dense) * (2 * classes) + slots[part])
            sums[at] += n.astype(np.int32)
            part = (ids < 0) & (ids != START)
            at, n = tallied((-1 - ids[part]) * (2 * classes) + slots[part])
            yield coded(np.frombuffer(keys, np.int64)[at // (2 * classes)], at % (2 * classes), n)
        at = np.flatnonzero(sums)
        keys = np.append(0, word_keys(words.words[words.dense:]))
        yield coded(keys[at // (2 * classes)], at % (2 * classes), sums[at])

    found = chunked.select("tokens", "keys").mapInArrow(count, CLASS_COUNTS)
    return found.repartition("key").sortWithinPartitions("key").mapInArrow(merged, CLASS_COUNTS)


class Steps:
    """Rows of words from the classes that followed them: a step along the gradient, by curvature."""

    def __init__(self, expected: np.ndarray, classes: int) -> None:
        self.classes, totals = classes, expected.reshape(2, classes)
        self.expected = totals / np.maximum(1, totals.sum(axis=1, keepdims=True))

    def rows(self, codes: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        """words x 2 x classes, and how often each word was counted."""
        n, width, expected = len(codes), 2 * self.classes, self.expected.astype(np.float32)
        total, out, spread = np.empty((n, 2, 1)), np.empty((n, 2, self.classes), np.float32), expected * (1 - expected)
        for i in range(0, n, 2048):
            own = codes[i:i + 2048]
            flat, m = own.flatten().to_numpy(), len(own)
            word, slots, counts = np.repeat(np.arange(m), own.value_lengths().to_numpy()), flat & 0xFFFF, flat >> 16
            total[i:i + m] = np.bincount(2 * word + (slots >= self.classes), weights=counts, minlength=2 * m).reshape(m, 2, 1)
            sums = total[i:i + m].astype(np.float32)
            step = np.multiply(sums, -expected, out=out[i:i + m])
            step.reshape(-1)[slots + word * width] += counts  # a word's slots come once
            curve = sums * spread
            curve += np.float32(CAUTION)
            step /= curve
        return out, total[:, 0, 0]  # a word is followed by a token, the end at least


def rare_masses(counts: DataFrame, shared_vocabulary) -> DataFrame:
    """cls, mass (counts plus 1) of the counted words that aren't frequent."""

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared_vocabulary.value
        for batch in batches:
            own, n = raw(batch.column(0)), batch.column(1).to_numpy()
            at = np.flatnonzero(words.numbers(own) == 0)
            cls = words.rare_class([own[i] for i in at])
            mass = np.bincount(cls, n[at] + 1, words.classes).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(words.classes)), pa.array(mass)], ["cls", "mass"])

    return counts.select("token", "n").mapInArrow(rate, "cls long, mass long").groupBy("cls").agg(F.sum("mass").alias("mass"))


# ---- scoring

def words_of_chunks(chunked: DataFrame) -> DataFrame:
    """chunk, key, at: the words of each chunk that aren't frequent, and their places among its names."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, chunk in enumerate(batch.column(0).to_pylist()):
                keys = np.frombuffer(batch.column(1)[i].as_buffer(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), chunk)), pa.array(keys), pa.array(np.arange(len(keys)))], ["chunk", "key", "at"])

    return chunked.select("chunk", "keys").mapInArrow(find, "chunk long, key long, at long")


MET = "chunk long, kind int, packed binary"
PACKED_ROWS = 1 << 18  # words that a packing task holds at most, besides a batch


def pack(table: pa.Table | pa.RecordBatch) -> bytes:
    """Columns as one compressed value: shuffled, they take a fraction of their rows' size."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write(table)
    return sink.getvalue().to_pybytes()


def unpack(values: list[bytes]) -> pa.Table:
    return pa.concat_tables([pa.ipc.open_stream(v).read_all() for v in values]).combine_chunks()


def pack_columns(columns: dict[str, np.ndarray]) -> bytes:
    return pack(pa.table({k: pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), pa.array(c)) for k, c in columns.items()}))


def unpack_columns(value: bytes | pa.Buffer) -> dict[str, np.ndarray]:
    table = pa.ipc.open_stream(value).read_all()
    return {c: table[c].combine_chunks().flatten().to_numpy() for c in table.column_names}


def pack_words(words: pa.Table) -> bytes:
    """key, codes as one value: the steps from key to key, how many codes each has, and of the codes the steps from
    slot to slot and the counts, each apart from the others, as most of them are small."""
    codes = words["codes"].combine_chunks()
    flat, sizes = codes.flatten().to_numpy(), codes.value_lengths().to_numpy()
    slots, starts = flat & 0xFFFF, (np.cumsum(sizes) - sizes)[sizes > 0]
    steps = np.diff(slots, prepend=0)
    steps[starts] = slots[starts]
    return pack_columns({"keys": np.diff(words["key"].to_numpy(), prepend=0), "sizes": sizes, "steps": steps.astype(np.uint16), "counts": flat >> 16})


def unpack_words(values: list[bytes]) -> tuple[np.ndarray, pa.ListArray]:
    """Keys and their codes."""
    if not values:
        return np.zeros(0, np.int64), pa.array([], pa.list_(pa.int64()))
    parts = [unpack_columns(v) for v in values]
    sizes, steps, counts = (np.concatenate([p[c] for p in parts]) for c in ("sizes", "steps", "counts"))
    keys = np.concatenate([np.cumsum(p["keys"]) for p in parts])
    ends, passed = np.cumsum(sizes), np.append(0, np.cumsum(steps, dtype=np.int64))
    slots = passed[1:] - np.repeat(passed[ends - sizes], sizes) & 0xFFFF
    return keys, pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(counts << 16 | slots))


def by_chunk(held: list[pa.RecordBatch], kind: int) -> pa.RecordBatch:
    """A row of MET for each chunk of the rows of ``held``, whose first column is the chunk."""
    rows = pa.Table.from_batches(held)
    chunk = rows.column(0).to_numpy()
    if (chunk[1:] < chunk[:-1]).any():
        order = np.argsort(chunk, kind="stable")
        rows, chunk = rows.take(pa.array(order)), chunk[order]
    starts = np.flatnonzero(np.append(True, chunk[1:] != chunk[:-1]))
    rows = rows.drop_columns(["chunk"]).combine_chunks()
    packed = [(pack if kind else pack_words)(rows.slice(i, n)) for i, n in zip(starts.tolist(), np.diff(np.append(starts, len(chunk))).tolist())]
    return pa.RecordBatch.from_arrays([pa.array(chunk[starts]), pa.array(np.full(len(starts), kind, np.int32)), pa.array(packed, pa.binary())], ["chunk", "kind", "packed"])


def packed_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """chunk, key, codes in the columns of MET."""
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.num_rows
        if size >= PACKED_ROWS:
            yield by_chunk(held, 0)
            held, size = [], 0
    if held:
        yield by_chunk(held, 0)


def packed_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of chunks in the columns of MET."""
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.nbytes
        if size >= CHUNK_BYTES:
            yield by_chunk(held, 1)
            held, size = [], 0
    if held:
        yield by_chunk(held, 1)


def meet(texts: DataFrame, needs: DataFrame, rare: DataFrame, name: str = "key") -> DataFrame:
    """The rows of each chunk (chunk, others) in one task, its words first, in the columns of MET. ``name``: the column
    of ``needs`` that the words are told apart by there."""
    words = needs.join(rare, "key").select("chunk", F.col(name).alias("key"), "codes").mapInArrow(packed_words, MET)
    texts = texts.mapInArrow(packed_texts, MET)
    return words.unionByName(texts).repartition("chunk").sortWithinPartitions("chunk", "kind")


def chunks_in(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        own = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(own)) + 1).tolist(), len(own)]
        for start, stop in zip(cuts, cuts[1:]):
            if stop > start:
                if held and own[start] != last:
                    yield pa.Table.from_batches(held)
                    held = []
                held.append(batch.slice(start, stop - start))
                last = own[start]
    if held:
        yield pa.Table.from_batches(held)


class Scorer:
    """What each task holds of the model: weights of the dense words, codes of the other frequent ones."""

    def __init__(self, vocabulary: Vocabulary, weights: np.ndarray, frequent_codes: pa.ListArray, steps: Steps) -> None:
        self.vocabulary, self.weights, self.frequent_codes, self.steps = vocabulary, weights, frequent_codes, steps

    def score(self, tokens: Tokens, at: np.ndarray, codes: pa.ListArray) -> tuple[np.ndarray, ...]:
        """n_tokens, n_known, sum of log10(count + 1) and log10 probability of each piece. ``at``, ``codes``:
        the counted words among the names of ``tokens``."""
        words, names = self.vocabulary, len(tokens.rare_cls)
        seen, found = np.zeros(names), np.zeros(names, bool)
        rare_steps, seen[at] = self.steps.rows(codes)
        found[at] = True
        # A row for the start and each word here, in order of the ids: the common part and the word's own.
        used = np.flatnonzero(np.bincount(tokens.flat + names)) - names
        number = np.zeros(names + len(words.words) + 1, np.int64)
        number[used] = np.arange(1, len(used) + 1)  # an id below 0 counts from the end
        used = np.append(START, used)
        common = feature_rows(used, used, words.dense)
        middle = int(np.searchsorted(used, words.dense, side="right"))
        middle_steps, _ = self.steps.rows(self.frequent_codes.take(pa.array(used[middle:] - words.dense - 1)))
        rows, scale = [], []
        for feature, before in enumerate((tokens.one, tokens.two)):
            z = self.weights.take(common[:, feature], axis=0)
            z[middle:] += middle_steps[:, feature]
            z[names - at] += rare_steps[:, feature]
            if not feature:
                z += self.weights[-1]
            z -= z.max(axis=1, keepdims=True)
            rows.append(z)
            scale.append((np.exp(z), np.where(before == START, 0, number.take(np.where(before == START, 0, before), mode="wrap"))))
        rare, name = tokens.ids < 0, np.maximum(-1 - tokens.ids, 0)
        known, inside, counted = words.known[np.maximum(tokens.ids, 0)], words.inside[np.maximum(tokens.ids, 0)], np.ones(len(tokens.ids), bool)
        known[rare], counted[rare] = np.log10(seen + 1)[name[rare]], found[name[rare]]
        inside[rare] = known[rare] - np.log10(words.rare_masses)[tokens.cls[rare] - CLASSES + 1]
        logs, ones = np.empty(len(tokens.ids)), np.ones(words.classes, np.float32)
        (a, one), (b, two) = scale
        for i in range(0, len(logs), SCORED):
            x, y, cls = one[i:i + SCORED], two[i:i + SCORED], tokens.cls[i:i + SCORED]
            z = a.take(x, axis=0)
            z *= b.take(y, axis=0)
            total = z @ ones
            own = z[np.arange(len(z)), cls]
            least = np.flatnonzero(np.minimum(total, own) < LEAST)
            total[least] = own[least] = 1
            logs[i:i + SCORED] = np.log(own) - np.log(total)
            if len(least):
                exact = class_log_probs(rows[0][x[least]] + rows[1][y[least]])
                logs[i + least] = exact[np.arange(len(least)), cls[least]]
        logs, m = logs / np.log(10) + inside, len(tokens.sizes)
        return np.bincount(tokens.row, minlength=m), np.bincount(tokens.row, counted, m).astype(np.int64), np.bincount(tokens.row, known, m), np.bincount(tokens.row, logs, m)


def learn_vocabulary(spark: SparkSession, counts: DataFrame) -> Vocabulary:
    tokens, types = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    top = frequent_tokens(counts, VOCABULARY)
    if tokens and END.decode() not in set(top["token"]):
        top = pd.concat([top, counts.filter(F.col("token") == END.decode()).toPandas()])
    vocabulary = Vocabulary([w.encode() for w in top["token"]], top["n"].to_numpy(float), tokens, types)
    for row in rare_masses(counts, spark.sparkContext.broadcast(vocabulary)).collect():  # a row a class
        if row.cls >= CLASSES - 1:
            vocabulary.rare_masses[row.cls - CLASSES + 1] += row.mass
    return vocabulary


def learn_model(chunked: DataFrame, vocabulary: Vocabulary, shared, rounds: int = ROUNDS) -> tuple[Scorer, DataFrame]:
    """The model, as far as each task holds it, and the table of the words that aren't dense: key, codes."""
    spark = chunked.sparkSession
    weights = train_classes(chunked, vocabulary, shared, rounds)
    followed = stored(class_counts(chunked, vocabulary, shared), "lm-classes", free_shuffles=True)
    expected = np.zeros(2 * vocabulary.classes)
    slots = followed.select(F.explode("codes").alias("code")).groupBy(F.col("code").bitwiseAND(0xFFFF).alias("slot")).agg(F.sum(F.shiftright("code", 16)).alias("n"))
    for row in slots.collect():  # 2 x classes
        expected[row.slot] = row.n
    # Codes of the frequent words that aren't dense: VOCABULARY words at most.
    middle = word_keys(vocabulary.words[vocabulary.dense:])
    codes = [np.zeros(0, np.int64)] * len(middle)
    if len(middle):
        place = {k: i for i, k in enumerate(middle.tolist())}
        keys = spark.createDataFrame(pd.DataFrame({"key": middle}))
        got = followed.join(F.broadcast(keys), "key").toPandas()
        for k, c in zip(got["key"], got["codes"]):
            codes[place[k]] = np.asarray(c, np.int64)
    codes = pa.array(codes, pa.list_(pa.int64()))
    return Scorer(vocabulary, weights, codes, Steps(expected, vocabulary.classes)), followed


def score_texts(docs: DataFrame, training: Column, rounds: int = ROUNDS) -> DataFrame:
    """Learn from the rows of ``docs`` (doc_id, text; other columns are ignored) where
    ``training`` holds, and score all rows: doc_id, n_tokens, n_known, train_tokens,
    base_score (log10, unigram, add-one) and score (the model's log10 probability).

    Null text: empty, which is the end token alone. Null ids are rows like others. Repeated
    rows count as often as they occur and get equal scores. With no training text the counts
    are 0 and every word is unseen; an empty table gives an empty result. Word order within
    a text and whole texts count; a text of over CHUNK_BYTES is held in pieces, a single
    word whole. Without words beyond the frequent ones there are just no rows for them.
    """
    spark = docs.sparkSession
    text_hash = F.pmod(F.xxhash64("doc_id", "text"), F.lit(rounds)).cast("int")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.when(training, text_hash).alias("round"))
    counts = stored(token_counts(docs.filter("round IS NOT NULL")), "tokens", free_shuffles=True)
    vocabulary = learn_vocabulary(spark, counts)
    words = spark.sparkContext.broadcast(vocabulary)
    chunked = stored(in_chunks(docs, words), "lm-chunks", rows_per_file=CHUNKS_PER_FILE)
    model, rare = learn_model(chunked, vocabulary, words, rounds)
    shared = spark.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks_in(batches):
            n_words = int((chunk["kind"].to_numpy() == 0).sum())
            values = chunk["packed"].to_pylist()
            at, codes = unpack_words(values[:n_words])
            for value in unpack(values[n_words:])["tokens"]:
                columns = unpack_columns(value.as_buffer())
                found = shared.value.score(Tokens.unpacked(columns, shared.value.vocabulary), at, codes)
                doc_id = pa.array(columns["doc_id"], mask=columns["no_id"] == 1)
                yield pa.RecordBatch.from_arrays([pa.array(columns["row"]), doc_id, *map(pa.array, found)], ["row", "doc_id", "n_tokens", "n_known", "known_sum", "score"])

    met = meet(chunked.select("chunk", "tokens"), words_of_chunks(chunked), rare, "at")
    scored = met.mapInArrow(score, "row long, doc_id long, n_tokens long, n_known long, known_sum double, score double")
    # The pieces of a text; most have one.
    scored = scored.groupBy("row").agg(F.first("doc_id").alias("doc_id"), *(F.sum(c).alias(c) for c in ("n_tokens", "n_known", "known_sum", "score")))
    n = model.vocabulary.tokens + model.vocabulary.types + 1
    return scored.select(
        "doc_id", "n_tokens", "n_known", F.lit(int(model.vocabulary.tokens)).cast("long").alias("train_tokens"),
        (F.col("known_sum") - F.col("n_tokens") * F.log10(F.lit(float(n)))).alias("base_score"), "score")


def held_out(mod: int, remainder: int) -> Column:
    return id_remainder(F.col("doc_id"), mod) == remainder
