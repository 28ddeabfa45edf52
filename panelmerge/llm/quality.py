"""Quality classifier from weak labels.

Heuristic labellers vote good, bad or nothing on every whole text. Expectation
maximisation over the counts of the vote patterns (3 to the number of labellers
at most, whatever the corpus) estimates how often each labeller gives each vote
to good and to bad texts, and with it the probability that a text is good. These
probabilities are the labels that a hashed linear scorer learns from, on a bounded
sample; the scorer then judges all texts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .linear import Rows, fit_logistic, hashed
from .outliers import text_stats
from .shared import raw, word_runs

BUCKETS = 1 << 14
SAMPLE = 20_000  # documents that the scorer is fitted on at most, lowest hash first
L2 = 1e-4
# Common function words of the four languages.
COMMON = frozenset(
    w.encode() for w in (
        "the of and to in a is that for it as with was on be by this are from at or an "
        "der die und das den in zu von mit ist des ein eine für im dem auf "
        "le la les de des et un une que qui est dans pour en du par sur "
        "el los las y del se por con una su para al lo como").split())
ABSTAIN, BAD, GOOD = 0, 1, 2


#: A-Z lower-cased and sentence marks blank, for looking up common words.
_BARE = bytes(c + 32 if 65 <= c <= 90 else 32 if c in b".,;:!" else c for c in range(256))
_MARKED = re.compile(rb"[!?$%*#&|<>=+~^_@](?![^\x20\x09-\x0D])")


def measures(text: bytes | None) -> tuple[dict[str, float], Counter]:
    """Rates of the whole text that the labellers and the scorer look at, and how often
    each common word occurs."""
    text = text or b""
    n_words, chars, symbols, dup_lines, repeats, lines, capitals = text_stats(text)
    words: Counter = Counter()
    common: Counter = Counter()
    echoes, last = 0, b""
    for run in word_runs(text):
        words.update(run)
        echoes += sum(map(eq, run, [last, *run]))
        last = run[-1] if run else last
    for run in word_runs(text.translate(_BARE)):
        common.update(filter(COMMON.__contains__, run))
    per_word, per_char = max(1, n_words), max(1, chars)
    return {
        "words": n_words, "word_length": chars / per_word, "symbols": symbols / per_char, "capitals": capitals / per_char,
        "repeats": repeats / per_word, "dup_lines": dup_lines / max(1, lines),
        "marked": len(_MARKED.findall(text)) / per_word, "common": sum(common.values()) / per_word,
        "top_word": max(words.values(), default=0) / per_word, "echoes": echoes / per_word,
    }, common


#: A defect labeller says bad or nothing: the absence of its defect tells little.
LABELLERS = {
    "symbols": lambda m: BAD if m["symbols"] > 0.03 else ABSTAIN,
    "capitals": lambda m: BAD if m["capitals"] > 0.3 else ABSTAIN,
    "marked": lambda m: BAD if m["marked"] > 0.2 else ABSTAIN,
    "repeats": lambda m: BAD if m["repeats"] > 0.3 else ABSTAIN,
    "dup_lines": lambda m: BAD if m["dup_lines"] > 0.3 else ABSTAIN,
    "top_word": lambda m: BAD if m["words"] >= 20 and m["top_word"] > 0.2 else ABSTAIN,
    "echoes": lambda m: BAD if m["echoes"] > 0.3 else GOOD if m["echoes"] < 0.05 and m["words"] >= 20 else ABSTAIN,
    "common": lambda m: BAD if m["common"] < 0.03 and m["words"] >= 20 else GOOD if m["common"] > 0.15 else ABSTAIN,
    "word_length": lambda m: BAD if not 2.5 <= m["word_length"] <= 12 else GOOD if m["word_length"] <= 8 else ABSTAIN,
}


def votes(m: dict[str, float]) -> tuple[int, ...]:
    return tuple(f(m) for f in LABELLERS.values())


def weak_label_model(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray, float]:
    """Expectation maximisation over vote patterns (rows of votes) and their counts.

    Returns the probability of good for each pattern, the vote tables (labeller x
    class x vote; class 0 bad, 1 good) and the share of good texts. Starts from
    labellers that seldom call a good text bad, which fixes the
    meaning of the classes. A text without any vote has about the share of good texts."""
    k = patterns.shape[1]
    tables = np.empty((k, 2, 3))
    tables[:, 0, [ABSTAIN, BAD, GOOD]] = 0.35, 0.35, 0.3
    tables[:, 1, [ABSTAIN, BAD, GOOD]] = 0.48, 0.02, 0.5
    good = 0.8
    for _ in range(rounds):
        log = np.tile(np.log([1 - good, good]), (len(patterns), 1))
        for j in range(k):
            log += np.log(tables[j][:, patterns[:, j]]).T
        log -= log.max(axis=1, keepdims=True)
        p = np.exp(log)
        p /= p.sum(axis=1, keepdims=True)
        mass = p * counts[:, None]
        good = min(max((mass[:, 1].sum() + 8) / (counts.sum() + 10), 1e-6), 1 - 1e-6)
        for j in range(k):
            for vote in (ABSTAIN, BAD, GOOD):
                tables[j, :, vote] = mass[patterns[:, j] == vote].sum(axis=0) + 1
            # Prior: as many right votes as before any was seen, so no class is empty.
            tables[j, 1, GOOD] += 4
            tables[j, 0, BAD] += 2
            tables[j] /= tables[j].sum(axis=1, keepdims=True)
    return p[:, 1], tables, good


#: Letters, capitals and digits as classes, other ASCII as is.
_CLASSES = bytes(97 if 97 <= c <= 122 or c >= 128 else 65 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else c for c in range(256))
_RUNS = ((re.compile(rb"a+"), b"a"), (re.compile(rb"A+"), b"A"), (re.compile(rb"0+"), b"0"))


def _looks(text: bytes) -> Counter:
    """How often each look of a word occurs (classes of its characters, runs of one class
    once) and each length of a word, up to 20 bytes."""
    shapes: Counter = Counter()
    lengths: Counter = Counter()
    for run in word_runs(text):
        lengths.update(map(len, run))
    text = text.translate(_CLASSES)
    for run_of, one in _RUNS:
        text = run_of.sub(one, text)
    for run in word_runs(text):
        shapes.update(run)
    out = Counter({b"s" + shape[:32]: 0 for shape in shapes})
    for shape, times in shapes.items():
        out[b"s" + shape[:32]] += times
    for length, times in lengths.items():
        out[b"l%d" % min(20, length)] += times
    return out


@lru_cache(1 << 16)
def _bucket(name: bytes) -> int:
    return hashed(name, BUCKETS)


def _rate_features(m: dict[str, float]) -> list[int]:
    """Rates in bins: tenths, and the words in powers of two."""
    names = [f"r{name}{min(10, int(10 * m[name]))}" for name in ("repeats", "dup_lines", "marked", "top_word", "echoes", "capitals", "symbols", "common")]
    names += [f"n{min(6, int(m['words']).bit_length())}", f"z{m['symbols'] > 0}{m['marked'] > 0.02}"]
    return [hashed(x.encode(), BUCKETS) for x in names]


def features(text: bytes | None, m: dict[str, float], common: Counter) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers (distinct, ascending) and values: the rates' bins as 1, and looks,
    lengths and common words by their share of the words."""
    shares: dict[int, float] = dict.fromkeys(_rate_features(m), 1.0)
    n = max(1.0, m["words"])
    for names in (_looks(text or b""), {b"c" + w: times for w, times in common.items()}):
        for name, times in names.items():
            f = _bucket(name)
            shares[f] = shares.get(f, 0.0) + times / n
    order = sorted(shares)
    return np.array(order, np.int32), np.array([shares[f] for f in order], np.float32)


class QualityModel:
    """Fitted on ``docs``: pattern table, vote tables and the scorer's weights."""

    def __init__(self, docs: DataFrame, limit: int = SAMPLE) -> None:
        spark = docs.sparkSession
        texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

        def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                given = [bytes(votes(measures(t)[0])) for t in raw(batch.column(0))]
                counted = Counter(given)
                yield pa.RecordBatch.from_arrays([pa.array(counted.keys(), pa.binary()), pa.array(counted.values(), pa.int64())], ["pattern", "n"])

        counted = texts.select("text").mapInArrow(vote, "pattern binary, n long").groupBy("pattern").agg(F.sum("n").alias("n")).orderBy("pattern").toPandas()
        self.patterns = np.array([list(p) for p in counted["pattern"]], np.int64).reshape(-1, len(LABELLERS))
        self.counts = counted["n"].to_numpy(float)
        self.weights, self.bias = np.zeros(BUCKETS), 4.0
        if not len(counted):
            return
        self.good, self.tables, self.share = weak_label_model(self.patterns, self.counts)
        posterior = dict(zip(map(bytes, counted["pattern"]), self.good))

        def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = []
                for t in raw(batch.column(0)):
                    m, common = measures(t)
                    f, v = features(t, m, common)
                    out.append((f.tobytes(), v.tobytes(), float(posterior[bytes(votes(m))])))
                yield pa.RecordBatch.from_arrays([
                    pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], pa.binary()), pa.array([x[2] for x in out], pa.float64()),
                ], ["f", "v", "target"])

        rows = self.counts.sum()
        # Lowest hashes: a threshold that lets through about the limit, so no sort and no shuffle.
        low = F.xxhash64("doc_id", "text").bitwiseAND(F.lit((1 << 62) - 1)) < F.lit(int(min(1.0, limit / rows) * ((1 << 62) - 1)))
        distinct = texts.filter(low).groupBy(F.xxhash64("text").alias("h")).agg(F.min("text").alias("text")).limit(2 * limit)
        sample = distinct.select("text").mapInArrow(learn, "f binary, v binary, target double").toPandas()
        if sample.empty:
            return
        sample["key"] = sample["f"].map(lambda b: hashed(b, 1 << 32))
        sample = sample.sort_values(["key", "target"], kind="stable")  # the order of the tasks must not matter
        rows_ = Rows([np.frombuffer(b, np.int32).astype(np.int64) for b in sample["f"]], [np.frombuffer(b, np.float32).astype(float) for b in sample["v"]])
        self.weights, self.bias = fit_logistic(rows_, sample["target"].to_numpy(float), np.ones(len(sample)), BUCKETS, l2=L2)

    def score(self, text: bytes | None) -> float:
        f, v = features(text, *measures(text))
        return float(1 / (1 + np.exp(-np.clip(self.bias + (self.weights[f] * v).sum(), -30, 30))))


def scorer(model: QualityModel, spark):
    """An Arrow UDF from text to the probability of a good text."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        return pa.array([shared.value.score(t) for t in raw(column)], pa.float64())

    return score


def score_quality(docs: DataFrame, limit: int = SAMPLE) -> DataFrame:
    """doc_id, score (probability of a good text) and kept (score from 0.5) for each row
    of ``docs`` (doc_id, text; other columns are ignored).

    Null or empty texts are texts without words: the labellers say what they say
    of them. Repeated rows count as often as they occur in the label model, and once in
    the sample; they get equal scores. Null ids are ids like others. An empty table gives
    an empty result.
    """
    score = scorer(QualityModel(docs, limit), docs.sparkSession)
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), score(F.col("text").cast("string")).alias("score"))
    return out.withColumn("kept", F.col("score") >= 0.5)


def keep_good(docs: DataFrame, limit: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, with all their columns."""
    score = scorer(QualityModel(docs, limit), docs.sparkSession)
    return docs.filter(score(F.col("text").cast("string")) >= 0.5)
