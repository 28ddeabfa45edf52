"""Quality rules: robust multivariate outliers by minimum covariance determinant.

Word statistics of every whole text, then per (lang, source) the mean and
covariance of the half of the documents whose covariance has the smallest
determinant. A document is rejected if its Mahalanobis distance to that centre
is beyond a chi-square quantile.

The estimate is FAST-MCD spread over Spark: each group is cut into chunks of
about ``CHUNK`` rows, every chunk searches its own best half from several
deterministic starts, the chunk results are averaged, and concentration steps
over all rows of the group (distance, quantile, new mean and covariance, all
of them aggregations) refine the average. No task holds a whole group. Chunks and
quantiles hang on the data alone, not on how the rows are partitioned.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import raw, stored

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
#: Transformed statistics, as SQL over the base columns, and the least standard
#: deviation of each: most texts have no symbol, repeated line or capital beyond
#: the sentence starts, so the plain covariance would be singular and the first
#: symbol an outlier.
FEATURES = {
    "log_words": ("ln(1 + n_words)", 0.9),
    "word_length": ("word_chars / greatest(n_words, 1)", 0.6),
    "symbol_rate": ("ln(1 + 1000 * n_symbols / greatest(word_chars, 1))", 0.7),
    "dup_line_rate": ("ln(1 + 100 * n_dup_lines / greatest(n_lines, 1))", 0.9),
    "repeat_rate": ("ln(1 + 100 * n_repeat_words / greatest(n_words, 1))", 0.7),
    "capital_rate": ("ln(1 + 100 * n_capitals / greatest(word_chars, 1))", 0.6),
}
NAMES, P = list(FEATURES), len(FEATURES)
ALPHA = 0.75  # share of the rows in the covariance
TAIL = 1e-7  # share of a normal population beyond the cut
CHUNK = 1000
PRIOR_ROWS = 50  # as many rows as this of all groups' estimate are mixed into that of each group
STEPS = 64  # steps of the distance's histogram for each doubling
PAIRS = [(i, j) for i in range(P) for j in range(i, P)]


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words covered by a window of ``window`` words (a power of two) that occurs
    twice or more in the text, the first occurrence included."""
    n = len(words)
    if n <= window:
        return 0
    ids = {w: i for i, w in enumerate(dict.fromkeys(words))}
    if len(ids) == n:
        return 0
    rank = np.fromiter(map(ids.__getitem__, words), np.int64, n)
    span = 1
    while span < window:  # rank of a window: the rank of the pair of its halves
        both = rank[:-span] * (rank.max() + 1) + rank[span:]
        names, rank = np.unique(both, return_inverse=True)
        if len(names) == len(rank):  # no window this long occurs twice, so no longer one does
            return 0
        span *= 2
    twice = np.flatnonzero(np.bincount(rank)[rank] > 1)
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, twice, 1)
    np.add.at(edge, twice + window, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def text_stats(text: bytes | None) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_capitals."""
    text = text or b""
    words = text.split()
    count = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    points = len(text) - int(count[0x80:0xC0].sum())
    lines = [x for x in text.split(b"\n") if x.strip()]
    return (
        len(words), points - int(count[9:14].sum()) - int(count[32]), int(count[list(SYMBOLS)].sum()),
        len(lines) - len(set(lines)), repeated_words(words), len(lines), int(count[65:91].sum()),
    )


_STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals"]


def base_stats(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the statistics of each whole text; base_failed."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                       F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([text_stats(t) for t in raw(batch.column(3))], np.int64).reshape(-1, len(_STATS))
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(3)] + [pa.array(x) for x in rows.T], ["doc_id", "lang", "source", *_STATS])

    out = docs.mapInArrow(run, "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in _STATS))
    return out.withColumn("base_failed", F.expr("n_words < 20 OR 100 * n_repeat_words > 30 * n_words"))


def chi2_cdf(x: float, k: int) -> float:
    """Regularised lower incomplete gamma function of k/2 at x/2, by its series."""
    if x <= 0:
        return 0.0
    a, x = k / 2, x / 2
    term = total = 1 / a
    n = a
    while term > total * 1e-15:
        n += 1
        term *= x / n
        total += term
    return total * math.exp(-x + a * math.log(x) - math.lgamma(a))


def chi2_quantile(p: float, k: int) -> float:
    """Wilson and Hilferty's start, then bisection; for tails too thin for that, the start."""
    guess = k * (1 - 2 / (9 * k) + NormalDist().inv_cdf(p) * math.sqrt(2 / (9 * k))) ** 3
    lo, hi = guess / 2, guess * 2
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_cdf(mid, k) < p else (lo, mid)
    return (lo + hi) / 2


FLOOR = np.diag([sd**2 for _, sd in FEATURES.values()])


def _distances(x: np.ndarray, mean: np.ndarray, cov: np.ndarray) -> np.ndarray:
    d = x - mean
    return np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d)


def mcd(x: np.ndarray, alpha: float = ALPHA, steps: int = 20) -> tuple[np.ndarray, np.ndarray]:
    """Mean and covariance (plus FLOOR) of the best subset of ``alpha`` of the rows:
    concentration steps from deterministic starts, the smallest determinant wins."""
    h = max(1, min(len(x), math.ceil(alpha * len(x))))
    median = np.median(x, axis=0)
    scale = np.maximum(1.4826 * np.median(np.abs(x - median), axis=0), np.sqrt(np.diag(FLOOR)))
    z = (x - median) / scale
    rank = (np.argsort(np.argsort(z, axis=0), axis=0) + 0.5) / len(x) - 0.5
    starts = (
        (z**2).sum(1), np.abs(z).max(1), (np.tanh(z) ** 2).sum(1), (rank**2).sum(1),
    )  # distances that an outlier can't pull: squares, worst coordinate, squashed, ranks
    best = None
    for first in starts:
        own = np.argsort(first, kind="stable")[:h]
        for _ in range(steps):
            mean = x[own].mean(axis=0)
            cov = np.cov(x[own].T, bias=True).reshape(x.shape[1], -1) + FLOOR
            nearer = np.argsort(_distances(x, mean, cov), kind="stable")[:h]
            if np.array_equal(np.sort(nearer), np.sort(own)):
                break
            own = nearer
        det = np.linalg.slogdet(cov)[1]
        if best is None or det < best[0]:
            best = det, mean, cov
    return best[1], best[2]


_MEANS = [f"m{i}" for i in range(P)]
_COVS = [f"c{i}_{j}" for i, j in PAIRS]
_STATE = ", ".join(f"{c} double" for c in _MEANS + _COVS)


def _search(table: pd.DataFrame) -> pd.DataFrame:
    table = table.sort_values(NAMES, kind="stable")  # a chunk's rows come in any order
    x = table[NAMES].to_numpy(float).repeat(table["copies"].to_numpy(), axis=0)
    mean, cov = mcd(x)
    return pd.DataFrame([[table["group"].iat[0], len(x), *mean, *(cov[i, j] for i, j in PAIRS)]], columns=["group", "n", *_MEANS, *_COVS])


def chunked(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """group, chunk, the statistics and copies: equal vectors are counted, then dealt one by one to the chunks, from one
    that their hash names on, so that vectors which repeat spread evenly."""
    counted = rows.groupBy("group", *NAMES).agg(F.count("*").alias("n")).join(sizes, "group")
    counted = counted.withColumn("first", F.pmod(F.xxhash64(*NAMES), "chunks")).withColumn(
        "turn", F.explode(F.expr("sequence(0L, least(n, chunks) - 1)")))
    return counted.select("group", *NAMES, F.expr("(first + turn) % chunks").alias("chunk"),
                          F.expr("n div chunks + int(turn < n % chunks)").alias("copies"))


def _invert(state: DataFrame, scale: float = 1.0) -> DataFrame:
    """Covariances to precisions, with the floor and the consistency factor."""

    def run(tables: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in tables:
            out = t[["group", *_MEANS]].copy()
            cov = np.zeros((len(t), P, P))
            for (i, j), c in zip(PAIRS, _COVS):
                cov[:, i, j] = cov[:, j, i] = t[c].to_numpy(float)
            inverse = np.linalg.inv(scale * cov + FLOOR)
            for (i, j), c in zip(PAIRS, _COVS):
                out[c] = inverse[:, i, j] * (1 if i == j else 2)
            yield out

    return state.select("group", *_MEANS, *_COVS).mapInPandas(run, f"group string, {_STATE}")


DISTANCE = " + ".join(f"c{i}_{j} * ({NAMES[i]} - m{i}) * ({NAMES[j]} - m{j})" for i, j in PAIRS)


def _measured(rows: DataFrame, state: DataFrame) -> DataFrame:
    return rows.join(state, "group").withColumn("d2", F.expr(DISTANCE)).drop(*_MEANS, *_COVS)


def _quantile(near: DataFrame) -> DataFrame:
    """group and cut: the upper end of the step of d2 in which the share ALPHA of the group's rows is reached. Steps
    are the same for all data, so the cut doesn't depend on the order in which partial counts meet."""
    step = F.floor(F.log2(F.greatest("d2", F.lit(1e-9))) * STEPS)
    counts = near.groupBy("group", step.alias("step")).agg(F.count("*").alias("n"))
    # Some thousand steps a group at most.
    running = F.sum("n").over(Window.partitionBy("group").orderBy("step"))
    total = F.sum("n").over(Window.partitionBy("group"))
    reached = counts.withColumns({"running": running, "total": total}).filter(F.col("running") >= ALPHA * F.col("total"))
    return reached.groupBy("group").agg(F.pow(F.lit(2.0), (F.min("step") + 1) / STEPS).alias("cut"))


def robust_estimates(rows: DataFrame, rounds: int = 2) -> DataFrame:
    """Rows, mean and covariance (without the floor) by group: a row per value of ``group``, which isn't null.
    ``rows`` is a stored table with group and the transformed statistics."""
    sizes = stored(rows.groupBy("group").agg(F.count("*").alias("rows")).withColumn("chunks", F.expr(f"cast(greatest(1, round(rows / {CHUNK})) as long)")), "groups")
    found = chunked(rows, sizes).groupBy("group", "chunk").applyInPandas(_search, f"group string, n long, {_STATE}")
    state = found.groupBy("group").agg(*(F.expr(f"sum(n * {c}) / sum(n) AS {c}") for c in _MEANS + _COVS))
    # The chunks' covariances have the floor in them already; _invert adds it.
    state = state.select("group", *_MEANS, *(F.expr(f"c{i}_{j} - {float(FLOOR[i, j])!r}D").alias(f"c{i}_{j}") for i, j in PAIRS))
    state = stored(state, "mcd")
    for _ in range(rounds):
        # Stored, the few estimates are known to be small: the rows needn't move to meet them.
        near = _measured(rows, stored(_invert(state), "mcd"))
        cut = stored(_quantile(near), "mcd-cut")
        half = near.join(cut, "group").filter("d2 <= cut")
        half = half.groupBy("group").agg(
            *(F.expr(f"avg({x}) AS m{i}") for i, x in enumerate(NAMES)),
            *(F.expr(f"covar_pop({NAMES[i]}, {NAMES[j]}) AS c{i}_{j}") for i, j in PAIRS))
        state = stored(half, "mcd")
    return state.join(sizes.select("group", "rows"), "group")


def shrunk(state: DataFrame, common: str) -> DataFrame:
    """Each group's estimate mixed with that of the group ``common``, which stands for PRIOR_ROWS rows: mean and covariance
    of the mixture. The smaller a group, the more it is judged by the common estimate; there is no step."""
    prior = state.filter(F.col("group") == common).select(*(F.col(c).alias(f"p_{c}") for c in _MEANS + _COVS))
    both = state.filter(F.col("group") != common).crossJoin(F.broadcast(prior)).withColumn("w", F.expr(f"rows / (rows + {PRIOR_ROWS})"))  # prior: one row
    means = [F.expr(f"w * m{i} + (1 - w) * p_m{i}").alias(f"m{i}") for i in range(P)]
    covs = [F.expr(f"w * c{i}_{j} + (1 - w) * p_c{i}_{j} + w * (1 - w) * (m{i} - p_m{i}) * (m{j} - p_m{j})").alias(f"c{i}_{j}") for i, j in PAIRS]
    return both.select("group", *means, *covs)


def reject_outliers(docs: DataFrame, tail: float = TAIL) -> DataFrame:
    """Verdicts on ``docs`` (doc_id, lang, source, text; other columns are ignored).

    Returns a row per input row: doc_id, lang, source, the statistics, base_failed,
    distance (squared Mahalanobis; null if base_failed) and kept. Estimates come
    from all rows that pass the base rules; a group is a (lang, source) pair, null
    being a value like others. Each group's estimate is mixed with that over all groups,
    which counts as PRIOR_ROWS rows. However the rows are partitioned, verdicts agree (but for
    distances that differ from the cut in their last digits only).

    Null or empty text: no words, base_failed. Repeated rows count as often as they
    occur. If no row passes the base rules, or the table is empty, nothing is kept.
    """
    stats = stored(
        base_stats(docs).withColumn("group", F.to_json(F.struct("lang", "source")))
        .select("*", *(F.expr(f"cast({sql} as double)").alias(c) for c, (sql, _) in FEATURES.items())), "text-stats")
    good = stats.filter(~F.col("base_failed")).select("group", *NAMES)
    everyone = ""  # no pair's JSON
    state = robust_estimates(stored(good.unionByName(good.withColumn("group", F.lit(everyone))), "mcd-rows"))
    # A subset of the nearest rows has too small a covariance: the factor for normal data.
    factor = ALPHA / chi2_cdf(chi2_quantile(ALPHA, P), P + 2)
    state = stored(_invert(shrunk(stored(state, "mcd-state"), everyone), factor), "mcd-precision")

    judged = stats.join(state, "group", "left").withColumn("distance", F.when(~F.col("base_failed"), F.expr(DISTANCE)))
    cut = chi2_quantile(1 - tail, P)
    return judged.select(
        "doc_id", "lang", "source", *_STATS, "base_failed", "distance",
        F.coalesce(F.col("distance") <= cut, F.lit(False)).alias("kept"))
