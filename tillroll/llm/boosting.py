"""Gradient-boosted trees in numpy: logistic loss, histograms, monotonic constraints."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 48
LEVELS = 3
TREES = 60
RATE = 0.15
PENALTY = 1.0  # added to the Hessian sum of a leaf
MIN_HESSIAN = 0.5
MIN_GAIN = 1e-6


@dataclass(frozen=True)
class Forest:
    """All trees' nodes in flat arrays. A leaf is its own child, so every row takes LEVELS steps."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        rows = np.arange(len(x))
        total = np.full(len(x), self.base)
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(LEVELS):
                low = x[rows, self.feature[node]] <= self.threshold[node]
                node = np.where(low, self.left[node], self.right[node])
            total += self.value[node]
        return 1.0 / (1.0 + np.exp(-total))


def _edges(x: np.ndarray) -> list[np.ndarray]:
    """Cut points of each feature, between values that occur; none without rows."""
    if not len(x):
        return [np.empty(0)] * x.shape[1]
    quantiles = np.linspace(0, 1, BINS + 1)[1:-1]
    return [np.unique(np.quantile(column, quantiles, method="lower")) for column in x.T]


def fit(x: np.ndarray, y: np.ndarray, signs: np.ndarray) -> Forest:
    """signs: per feature -1 (score never rises with it), 1 (never falls) or 0. Deterministic."""
    n, width = x.shape
    edges = _edges(x)
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], axis=1)
    offsets = np.arange(width) * BINS
    share = np.clip(y.mean() if n else 0.5, 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    total = np.full(n, base)
    nodes: list[list[float]] = []  # feature, threshold, left, right, value
    roots = []

    def leaf(value: float) -> int:
        k = len(nodes)
        nodes.append([0, 0.0, k, k, value])
        return k

    def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, level: int, low: float, high: float) -> int:
        sum_g, sum_h = g[rows].sum(), h[rows].sum()
        own = float(np.clip(-sum_g / (sum_h + PENALTY), low, high))
        if level == LEVELS or sum_h < 2 * MIN_HESSIAN:
            total[rows] += RATE * own
            return leaf(RATE * own)
        cells = (binned[rows] + offsets).ravel()
        shape = (width, BINS)
        left_g = np.bincount(cells, np.repeat(g[rows], width), width * BINS).reshape(shape).cumsum(1)
        left_h = np.bincount(cells, np.repeat(h[rows], width), width * BINS).reshape(shape).cumsum(1)
        right_g, right_h = sum_g - left_g, sum_h - left_h
        left_v = np.clip(-left_g / (left_h + PENALTY), low, high)
        right_v = np.clip(-right_g / (right_h + PENALTY), low, high)

        def loss(g, h, v):
            return g * v + 0.5 * (h + PENALTY) * v * v

        gain = loss(sum_g, sum_h, own) - loss(left_g, left_h, left_v) - loss(right_g, right_h, right_v)
        allowed = (left_h >= MIN_HESSIAN) & (right_h >= MIN_HESSIAN)
        allowed &= signs[:, None] * (right_v - left_v) >= 0
        allowed &= np.arange(BINS) < np.array([len(e) for e in edges])[:, None]
        gain = np.where(allowed, gain, -np.inf)
        f, cut = np.unravel_index(np.argmax(gain), shape)
        if not gain[f, cut] > MIN_GAIN:
            total[rows] += RATE * own
            return leaf(RATE * own)
        k = len(nodes)
        nodes.append([f, edges[f][cut], 0, 0, 0.0])
        goes_left = binned[rows, f] <= cut
        middle = float(left_v[f, cut] + right_v[f, cut]) / 2
        bounds = {0: ((low, high),) * 2, 1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}
        a, b = bounds[int(signs[f])]
        nodes[k][2] = grow(rows[goes_left], g, h, level + 1, *a)
        nodes[k][3] = grow(rows[~goes_left], g, h, level + 1, *b)
        return k

    for _ in range(TREES if n else 0):
        p = 1.0 / (1.0 + np.exp(-total))
        roots.append(grow(np.arange(n), p - y, p * (1 - p), 0, -np.inf, np.inf))
    flat = np.array(nodes, dtype=float).reshape(-1, 5)
    whole = flat[:, [0, 2, 3]].astype(np.int64)
    return Forest(whole[:, 0], flat[:, 1], whole[:, 1], whole[:, 2], flat[:, 4], np.array(roots, dtype=np.int64), base)
