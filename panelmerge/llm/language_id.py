"""Language identification by a convolutional network over bytes, in numpy.

A text's bytes (A-Z lower-cased) are cut into windows of ``WINDOW`` bytes, the last one
filled up with zeros; neighbours overlap by the widest filter less one, so no sequence of
bytes is lost. Filters of several widths run over the embedded bytes of each window, each
keeps its greatest value, and a softmax layer rates the languages. A text's rates are
those of all its windows, averaged before the softmax.

Training: windows of a bounded sample of labelled texts, by gradient steps on the driver.
For scoring, embedding and filters are folded into tables: a filter's value at a place is the
sum of table rows of the bytes, or pairs of bytes, under it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import raw, stored

WINDOW = 192
WIDTHS = (2, 3, 4)
FILTERS = 16  # of each width
EMBEDDING = 8
OVERLAP = max(WIDTHS) - 1
BATCH = 512  # windows that are rated at once
TEXTS_EACH = 800  # texts of each language that the fit uses at most, lowest hash first
WINDOWS_EACH = 6  # windows of each of these texts
LANGUAGES = 1000  # a table with more values of lang isn't one of languages: an error
EPOCHS, STEP, RATE, DECAY = 6, 64, 0.01, 1e-4
UNKNOWN = "und"


@dataclass
class Network:
    embedding: np.ndarray  # 256 x EMBEDDING
    filters: list[np.ndarray]  # for each width: width x EMBEDDING x FILTERS
    bias: np.ndarray  # widths x FILTERS
    out: np.ndarray  # (widths x FILTERS) x languages
    out_bias: np.ndarray

    def parts(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters, self.bias, self.out, self.out_bias]


def windows_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Windows (rows of bytes) of whole texts, and the number of the text of each; an
    empty text is one window of zeros."""
    step = WINDOW - OVERLAP
    counts = [1 + max(0, -(-(len(t) - WINDOW) // step)) for t in texts]
    out, at = np.zeros((sum(counts), WINDOW), np.uint8), 0
    for text, n in zip(texts, counts):
        size = (n - 1) * step + WINDOW
        filled = np.frombuffer(text + bytes(size - len(text)), np.uint8)
        out[at:at + n] = np.lib.stride_tricks.as_strided(filled, (n, WINDOW), (step, 1))
        at += n
    return out, np.repeat(np.arange(len(texts)), counts)


def start(languages: int, seed: int = 12) -> Network:
    rng = np.random.default_rng(seed)
    return Network(
        rng.normal(0, 0.5, (256, EMBEDDING)).astype(np.float32),
        [rng.normal(0, 1 / np.sqrt(w * EMBEDDING), (w, EMBEDDING, FILTERS)).astype(np.float32) for w in WIDTHS],
        np.zeros((len(WIDTHS), FILTERS), np.float32), rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, languages)).astype(np.float32), np.zeros(languages, np.float32))


def pooled(net: Network, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Greatest value of each filter in each window (windows x widths x FILTERS), and where it begins."""
    values, places = [], []
    for w, filters in zip(WIDTHS, net.filters):
        tables = np.einsum("be,wef->wbf", net.embedding, filters)
        z = tables[0][windows[:, :WINDOW - w + 1]]
        for j in range(1, w):
            z += tables[j][windows[:, j:WINDOW - w + 1 + j]]
        place = z.argmax(axis=1)
        values.append(np.take_along_axis(z, place[:, None], axis=1)[:, 0])
        places.append(place)
    return np.stack(values, axis=1) + net.bias, np.stack(places, axis=1)


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def gradients(net: Network, windows: np.ndarray, target: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    """Of the weighted mean log loss, in the order of ``Network.parts``."""
    n = len(windows)
    values, places = pooled(net, windows)
    hidden = np.maximum(values, 0).reshape(n, -1)
    delta = softmax(hidden @ net.out + net.out_bias)
    delta[np.arange(n), target] -= 1
    delta *= (weight / weight.sum())[:, None]
    back = (delta @ net.out.T).reshape(values.shape) * (values > 0)
    embedding, filters = np.zeros_like(net.embedding), []
    for k, (w, own) in enumerate(zip(WIDTHS, net.filters)):
        # Only the place of the greatest value moves the filter and the bytes under it.
        under = windows[np.arange(n)[:, None, None], places[:, k][:, :, None] + np.arange(w)]  # n x FILTERS x w
        filters.append(np.einsum("nf,nfwe->wef", back[:, k], net.embedding[under]))
        np.add.at(embedding, under, back[:, k][:, :, None, None] * own.transpose(2, 0, 1)[None])
    return [embedding, *filters, back.sum(axis=0), hidden.T @ delta, delta.sum(axis=0)]


def fit(windows: np.ndarray, target: np.ndarray, weight: np.ndarray, languages: int, epochs: int = EPOCHS) -> Network:
    """A network from training windows, by gradient steps with running moments. The same
    windows give the same network."""
    net, rng = start(languages), np.random.default_rng(7)
    parts = net.parts()
    first, second, t = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts], 0
    for epoch in range(epochs):
        order = rng.permutation(len(windows))
        for i in range(0, len(order), STEP):
            own, t = order[i:i + STEP], t + 1
            rate = RATE * (1 - epoch / epochs)
            for p, g, m, v in zip(parts, gradients(net, windows[own], target[own], weight[own]), first, second):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= (rate * (m / (1 - 0.9**t) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8) + DECAY * p)).astype(np.float32)
    return net


class Tables:
    """The network with embedding and filters folded into rows by byte and by pair of bytes."""

    def __init__(self, net: Network) -> None:
        by_byte = [np.einsum("be,wef->wbf", net.embedding, f) for f in net.filters]
        # Of each width: (offset, pair or byte, table).
        self.steps = []
        for w, tables in zip(WIDTHS, by_byte):
            own = [(j, True, (tables[j][:, None] + tables[j + 1][None]).reshape(-1, FILTERS)) for j in range(0, w - 1, 2)]
            self.steps.append(own + [(w - 1, False, tables[w - 1])] * (w % 2))
        self.bias, self.out, self.out_bias = net.bias, net.out, net.out_bias

    def rate(self, windows: np.ndarray) -> np.ndarray:
        """Of each window and language, before the softmax."""
        out = np.empty((len(windows), len(self.out_bias)), np.float32)
        for i in range(0, len(windows), BATCH):
            own = windows[i:i + BATCH].astype(np.int32)
            pairs = own[:, :-1] * 256 + own[:, 1:]
            values = []
            for w, steps in zip(WIDTHS, self.steps):
                z, places = None, WINDOW - w + 1
                for j, by_pair, table in steps:
                    part = table.take((pairs if by_pair else own)[:, j:j + places], axis=0)
                    z = part if z is None else np.add(z, part, out=z)
                values.append(z.max(axis=1))
            hidden = np.maximum(np.stack(values, axis=1) + self.bias, 0).reshape(len(own), -1)
            out[i:i + BATCH] = hidden @ self.out + self.out_bias
        return out


def rate_texts(tables: Tables, texts: list[bytes]) -> np.ndarray:
    """Rates of whole texts (texts x languages): the mean over their windows. A huge text
    goes through in pieces of whole windows."""
    step, out, small = WINDOW - OVERLAP, np.zeros((len(texts), len(tables.out_bias))), []
    limit = BATCH * 64 * step
    for i, text in enumerate(texts):
        if len(text) <= limit:
            small.append(i)
            continue
        total = 0
        for at in range(0, len(text) - OVERLAP, limit):
            windows, _ = windows_of([text[at:at + limit + OVERLAP]])
            out[i] += tables.rate(windows).sum(axis=0, dtype=float)
            total += len(windows)
        out[i] /= total
    held: list[int] = []
    size = 0
    for i in [*small, -1]:
        if held and (i < 0 or size + len(texts[i]) > limit):
            windows, own = windows_of([texts[x] for x in held])
            rates, n = tables.rate(windows), np.bincount(own)
            for k in range(out.shape[1]):
                out[held, k] = np.bincount(own, rates[:, k]) / n
            held, size = [], 0
        if i >= 0:
            held.append(i)
            size += len(texts[i])
    return out


def labelled_sample(docs: DataFrame, training: Column, limit: int = TEXTS_EACH) -> DataFrame:
    """lang, text: up to ``limit`` labelled texts of each language, of the lowest hash.

    A threshold by language, from the counts, lets about twice the limit through, so the
    ranking by language is over a bounded number of rows. Repeated rows are one."""
    rows = docs.filter(training & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("u", F.pmod(F.xxhash64("text", F.lit("sample")), F.lit(1 << 32)))
    counts = rows.groupBy("lang", "u").agg(F.count("*")).groupBy("lang").agg(F.count("*").alias("n")).limit(LANGUAGES + 1).collect()
    if len(counts) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    if not counts:
        return rows.select("lang", "text").limit(0)
    below = docs.sparkSession.createDataFrame([(r.lang, int(min(1.0, 2.0 * limit / r.n + 40.0 / r.n) * (1 << 32))) for r in counts], "lang string, below long")
    few = rows.join(F.broadcast(below), "lang").filter("u < below").groupBy("lang", "u").agg(F.min("text").alias("text"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("u"))
    return few.withColumn("rank", rank).filter(F.col("rank") <= limit).select("lang", "text")


def training_windows(texts: list[bytes], target: list[int], each: int = WINDOWS_EACH) -> tuple[np.ndarray, np.ndarray]:
    """Windows from all over each text, ``each`` at most, every fourth of them cut short, as
    the last ones of texts are."""
    out, own = [], []
    for text, language in zip(texts, target):
        windows, _ = windows_of([text])
        at = np.unique(np.linspace(0, len(windows) - 1, each).astype(int))
        out.append(windows[at])
        own.extend([language] * len(at))
    windows = np.concatenate(out)
    for i in range(0, len(windows), 4):
        windows[i, 12 + i * 37 % (WINDOW - 12):] = 0
    return windows, np.array(own)


def learn(sample: DataFrame) -> tuple[list[str], Network]:
    """The languages, by name, and a network; every language has the same weight."""
    got = stored(sample, "language-sample").toPandas()  # TEXTS_EACH texts of each language
    languages = sorted(set(got["lang"]))
    if not languages:
        return [], start(1)
    got = got.sort_values(["lang", "text"])  # the order of the tasks must not matter
    windows, target = training_windows([t.encode().lower() for t in got["text"]], [languages.index(x) for x in got["lang"]])
    weight = 1 / np.maximum(1, np.bincount(target, minlength=len(languages)))[target]
    return languages, fit(windows, target, weight, len(languages))


def predict(docs: DataFrame, languages: list[str], net: Network) -> DataFrame:
    """doc_id, lang_pred and score for each row of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast((languages, net))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, net = shared.value
        tables = Tables(net)
        for batch in batches:
            rated = np.flatnonzero(np.array(batch.column(2).to_pylist(), bool)) if names else np.zeros(0, int)
            texts = raw(batch.column(1))
            label, score = np.full(batch.num_rows, UNKNOWN, object), np.zeros(batch.num_rows)
            if len(rated):
                p = softmax(rate_texts(tables, [texts[i].lower() for i in rated]))
                best = p.argmax(axis=1)
                label[rated], score[rated] = [names[k] for k in best], p[np.arange(len(p)), best]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(label, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    text = F.col("text").cast("string")
    has_letter = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), has_letter.alias("letter"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame, training: Column, limit: int = TEXTS_EACH) -> DataFrame:
    """A row per row of ``docs`` (doc_id, text, lang; other columns are ignored): doc_id,
    lang_pred and score (0 to 1), learnt from text and lang of the rows where ``training``
    holds, up to ``limit`` texts of each language.

    Null texts and texts without a letter, empty ones too, are ``und`` with score 0. Rows
    of null lang or text aren't learnt from; a text with several labels counts for each.
    Very long texts are rated whole, in pieces. Repeated rows get equal results. Without
    anything to learn from all rows are ``und``; with one language it is the answer, with
    score 1. An empty table gives an empty result.
    """
    languages, net = learn(labelled_sample(docs, training, limit))
    return predict(docs.select("doc_id", "text"), languages, net)
