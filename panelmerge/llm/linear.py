"""Sparse logistic regression in numpy, for models fitted on a bounded sample."""

from __future__ import annotations

import zlib

import numpy as np


def hashed(name: bytes, buckets: int) -> int:
    return zlib.crc32(name) % buckets


class Rows:
    """Sparse rows: feature numbers and values (1 if not given), row after row."""

    def __init__(self, features: list[np.ndarray], values: list[np.ndarray] | None = None) -> None:
        self.n = len(features)
        self.sizes = np.array([len(f) for f in features], np.int64)
        self.row = np.repeat(np.arange(self.n, dtype=np.int32), self.sizes)
        self.feature = np.concatenate(features).astype(np.int32) if features else np.zeros(0, np.int32)
        self.value = np.concatenate(values).astype(np.float32) if values else None

    def _times(self, x: np.ndarray) -> np.ndarray:
        return x if self.value is None else x * self.value

    def dot(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self._times(weights[self.feature]), self.n)

    def spread(self, residual: np.ndarray, buckets: int) -> np.ndarray:
        return np.bincount(self.feature, self._times(residual[self.row]), buckets)

    def size(self) -> np.ndarray:
        """Sum of the values' magnitudes by row."""
        return self.sizes.astype(float) if self.value is None else np.bincount(self.row, np.abs(self.value), self.n)

    def spread_abs(self, weight: np.ndarray, buckets: int) -> np.ndarray:
        own = weight[self.row]
        return np.bincount(self.feature, own if self.value is None else own * np.abs(self.value), buckets)


def fit_logistic(
    rows: Rows, target: np.ndarray, weight: np.ndarray, buckets: int, l1: float = 0.0, l2: float = 0.0, steps: int = 150,
    swaps: Rows | None = None, swap_weight: float = 0.0,
) -> tuple[np.ndarray, float]:
    """Weights and bias of least (weighted mean log loss + l2/2 |w|^2 + l1 |w|
    + swap_weight/2 x mean squared (swaps . w)), by accelerated proximal gradient
    steps with a curvature bound per feature.

    ``target`` may be a probability. ``swaps`` holds, for each counterfactual, the
    change of the features: its score change is swaps . w."""
    total = max(1e-12, weight.sum())
    # Curvature by feature: the diagonal bound of the Hessian, sum_j |x_ij x_ik| / 4.
    size = rows.size()
    curve = rows.spread_abs(weight * (size + 1) / 4, buckets) / total + l2
    bias_curve = float((weight * (size + 1) / 4).sum() / total)
    if swaps is not None and swaps.n and swap_weight:
        curve += swap_weight * swaps.spread_abs(swaps.size(), buckets) / swaps.n
    curve = np.maximum(curve, 1e-9)
    w = look = np.zeros(buckets)
    mean = float((weight * target).sum() / total)
    mean = min(max(mean, 1e-6), 1 - 1e-6)
    b = look_b = float(np.log(mean / (1 - mean)))
    t = 1.0
    for _ in range(steps):
        residual = weight * (1 / (1 + np.exp(-(rows.dot(look) + look_b))) - target) / total
        gradient = rows.spread(residual, buckets) + l2 * look
        if swaps is not None and swaps.n and swap_weight:
            gradient += swap_weight / swaps.n * swaps.spread(swaps.dot(look), buckets)
        moved = look - gradient / curve
        moved = np.sign(moved) * np.maximum(0, np.abs(moved) - l1 / curve)
        moved_b = look_b - float(residual.sum()) / bias_curve
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        look = moved + (t - 1) / t_next * (moved - w)
        look_b = moved_b + (t - 1) / t_next * (moved_b - b)
        w, b, t = moved, moved_b, t_next
    return w, b

