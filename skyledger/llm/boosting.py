"""Gradient-boosted trees on histograms, for fits on bounded samples."""

from __future__ import annotations

import numpy as np

TREES, DEPTH, RATE, BINS, LEAST_ROWS, SMOOTH = 60, 4, 0.2, 32, 20, 1.0


class Trees:
    """Complete binary trees: at each inner node a feature and a limit, at each leaf a value."""

    def __init__(self, depth: int = DEPTH):
        self.depth = depth
        self.base = 0.0
        self.feature: list[np.ndarray] = []
        self.limit: list[np.ndarray] = []
        self.value: list[np.ndarray] = []

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Log odds of every row."""
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, limit, value in zip(self.feature, self.limit, self.value):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > limit[node])
            out += value[node - (len(feature))]
        return out


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Trees for 0/1 labels by Newton steps of the logistic loss."""
    model = Trees(depth)
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    model.base = float(np.log(share / (1 - share)))
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], 1)
    score = np.full(len(x), model.base)
    inner = (1 << depth) - 1
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        slope, curve = p - y, p * (1 - p) + 1e-6
        feature, limit = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(len(x), np.int64)
        for level in range(depth):
            first, width = (1 << level) - 1, 1 << level
            best = np.full(width, 1e-9)
            for j, edge in enumerate(edges):
                if not len(edge):
                    continue
                cell = (node - first) * BINS + binned[:, j]
                total = [np.bincount(cell, w, width * BINS).reshape(width, BINS).cumsum(1) for w in (slope, curve, None)]
                (g, h, n), ends = total, [t[:, -1:] for t in total]
                gain = (
                    g**2 / (h + SMOOTH) + (ends[0] - g) ** 2 / (ends[1] - h + SMOOTH) - ends[0] ** 2 / (ends[1] + SMOOTH)
                )
                gain[(n < LEAST_ROWS) | (ends[2] - n < LEAST_ROWS)] = 0
                gain = gain[:, : len(edge)]
                at = gain.argmax(1)
                better = gain[np.arange(width), at] > best
                best = np.where(better, gain[np.arange(width), at], best)
                feature[first : first + width] = np.where(better, j, feature[first : first + width])
                limit[first : first + width] = np.where(better, edge[at], limit[first : first + width])
            node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > limit[node])
        leaf = node - inner
        value = -RATE * np.bincount(leaf, slope, 1 << depth) / (np.bincount(leaf, curve, 1 << depth) + SMOOTH)
        model.feature.append(feature)
        model.limit.append(limit)
        model.value.append(value)
        score += value[leaf]
    return model
