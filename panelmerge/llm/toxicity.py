"""Toxicity: a counterfactual-regularised linear classifier over hashed word features.

Features of a text: its distinct words, their beginnings and their ends, hashed.
The fit is a sparse logistic regression on a bounded sample of labelled
documents, over the features that prefer one label (counted by Spark). Sentences that name a group are copied with the group swapped for
others of its kind, and the squared change of the score is a penalty: the name
of a group can't carry weight that the names of the others don't.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .linear import Rows, fit_logistic, hashed
from .shared import raw, stored, word_runs

BUCKETS = 1 << 18
SAMPLE = 20_000  # labelled documents that the fit uses at most, lowest hash first
MARKS = b".,;:!?\"'()[]{}<>|*#$%&+-_=/\\~"
BEGINNINGS, ENDS = (4, 5, 6, 8), (5, 7)
L1, SWAP_WEIGHT = 2e-5, 10.0
SCREEN = 3.0  # standard deviations by which a feature must prefer a label to enter the fit
CACHE = 400_000

# Names of groups; a name is swapped for the others of its line.
GROUPS = (
    ("muslim", "christian", "jewish", "hindu", "buddhist", "sikh", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "sikhs", "atheists"),
    ("black", "white", "asian", "latino", "arab", "indigenous"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("mothers", "fathers"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("old", "young"), ("deaf", "blind", "disabled"),
    ("frauen", "männer"), ("juden", "christen", "muslime"), ("ausländer", "einheimische"),
    ("femmes", "hommes"), ("juifs", "chrétiens", "musulmans"), ("étrangers", "immigrés"),
    ("mujeres", "hombres"), ("judíos", "cristianos", "musulmanes"), ("extranjeros", "inmigrantes"),
)
SWAPS = {w.encode(): [x.encode() for x in line if x != w] for line in GROUPS for w in line}


def word_features(word: bytes) -> tuple[int, ...]:
    """The bare word, its beginnings and its ends, by character."""
    text = word.decode("utf-8", "replace")
    names = [b"w" + word]
    names += [b"b" + text[:n].encode() for n in BEGINNINGS if len(text) > n]
    names += [b"e" + text[-n:].encode() for n in ENDS if len(text) > n]
    return tuple(hashed(x, BUCKETS) for x in names)


def bare_words(text: bytes | None) -> set[bytes]:
    """Distinct words of the whole text, A-Z lower-cased, without marks at their ends."""
    out: set[bytes] = set()
    for words in word_runs((text or b"").lower()):
        out.update(words)
    bare = {w.strip(MARKS) for w in out}
    bare.discard(b"")
    return bare


def text_features(words: set[bytes]) -> np.ndarray:
    return np.array(sorted({f for w in words for f in word_features(w)}), np.int64)


def swapped(words: set[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each group name in the words and each other name of its kind: the features
    that the swap changes, and by how much."""
    out = []
    for word in sorted(words & SWAPS.keys()):
        own = text_features(words)
        for other in SWAPS[word]:
            new = text_features(words - {word} | {other})
            gone, come = np.setdiff1d(own, new), np.setdiff1d(new, own)
            out.append((np.concatenate([gone, come]), np.concatenate([-np.ones(len(gone)), np.ones(len(come))])))
    return out


def labelled_sample(docs: DataFrame, labels: DataFrame, allowed: Column, limit: int = SAMPLE) -> DataFrame:
    """Up to ``limit`` labelled documents where ``allowed`` (over doc_id) holds, those of
    the lowest hash: doc_id, text, toxic. The ids are few, so the texts don't move."""
    ids = labels.filter(allowed & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("__id"), F.col("toxic").cast("int").alias("toxic"))
    ids = ids.groupBy("__id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("__id"), "__id").limit(limit)
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(ids), F.expr("doc_id = __id"))
    # An id with a third of all rows is still one document of the sample.
    return found.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))


def fit(sample: DataFrame, l1: float = L1, swap_weight: float = SWAP_WEIGHT, screen: float = SCREEN) -> tuple[np.ndarray, float]:
    """Weights by bucket and bias, from ``sample`` (text, toxic): a bounded table.

    The rarer label weighs as the root of the odds against it."""
    spark = sample.sparkSession

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [bare_words(t) for t in raw(batch.column(0))]
            moves = [swapped(w) for w in words]
            yield pa.RecordBatch.from_arrays([
                pa.array([text_features(w) for w in words], pa.list_(pa.int32())), batch.column(1),
                pa.array([[f.astype(np.int32).tobytes() for f, _ in m] for m in moves], pa.list_(pa.binary())),
                pa.array([[v.astype(np.int8).tobytes() for _, v in m] for m in moves], pa.list_(pa.binary())),
            ], ["features", "toxic", "moved", "by"])

    found = stored(sample.select("text", "toxic").mapInArrow(find, "features array<int>, toxic int, moved array<binary>, by array<binary>"), "toxic-sample")
    n, n_toxic = found.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not 0 < n_toxic < n:
        return np.zeros(BUCKETS), 4.0 if n_toxic else -4.0
    counts = found.select("toxic", F.explode("features").alias("f")).groupBy("f").agg(F.count("*").alias("n"), F.sum("toxic").alias("k")).toPandas()  # BUCKETS rows at most
    expected = counts["n"] * (n_toxic / n)
    lean = np.abs(counts["k"] - expected) >= screen * np.sqrt(expected * (1 - n_toxic / n))
    chosen = np.zeros(BUCKETS, bool)
    chosen[counts["f"][lean & (counts["n"] >= 2)]] = True
    shared = spark.sparkContext.broadcast(chosen)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [x.values.to_numpy() for x in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array([x[shared.value[x]].tobytes() for x in own], pa.binary()), *batch.columns[1:]], ["features", "toxic", "moved", "by"])

    got = found.mapInArrow(keep, "features binary, toxic int, moved array<binary>, by array<binary>").toPandas()
    got["key"] = got["features"].map(lambda f: hashed(f, 1 << 32))
    got = got.sort_values(["key", "toxic"], kind="stable")  # the order of the tasks must not matter
    rows = Rows([np.frombuffer(f, np.int32) for f in got["features"]])
    moved = [np.frombuffer(f, np.int32) for m in got["moved"] for f in m]
    by = [np.frombuffer(v, np.int8) for m in got["by"] for v in m]
    target = got["toxic"].to_numpy(float)
    weight = np.where(target > 0, np.sqrt(max(1.0, (n - n_toxic) / n_toxic)), np.sqrt(max(1.0, n_toxic / (n - n_toxic))))
    return fit_logistic(rows, target, weight, BUCKETS, l1=l1, swaps=Rows(moved, by) if moved else None, swap_weight=swap_weight)


def score_texts(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """doc_id and score (0 to 1) for each row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((model[0].astype(np.float32), model[1]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = shared.value
        known: dict[bytes, tuple[int, ...]] = {}  # of each word the features that have weight
        for batch in batches:
            z = []
            for text in raw(batch.column(1)):
                features: set[int] = set()
                for word in bare_words(text):
                    own = known.get(word)
                    if own is None:
                        if len(known) >= CACHE:
                            known.clear()
                        own = known[word] = tuple(f for f in word_features(word) if weights[f])
                    features.update(own)
                z.append(bias + sum(float(weights[f]) for f in sorted(features)))
            score = 1 / (1 + np.exp(-np.clip(np.array(z, float), -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64())], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, score double")


def score_toxicity(docs: DataFrame, labels: DataFrame, held_out: Column, limit: int = SAMPLE) -> DataFrame:
    """Scores for all rows of ``docs`` (doc_id, text; other columns are ignored), learnt
    from ``labels`` (doc_id, toxic) where ``held_out`` (over doc_id) is false: doc_id,
    held_out, score (0 to 1) and predicted (1 from 0.5).

    The fit uses up to ``limit`` labelled documents. Null or empty texts have the score
    of a text without words. Null labels or ids aren't learnt from; of repeated labels
    of an id the greatest counts. Repeated documents get equal scores. Without labels of both kinds the
    score is the same for all. An empty table gives an empty result.
    """
    model = fit(labelled_sample(docs, labels, ~held_out, limit))
    return score_texts(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
