"""Gradient-boosted trees for binary labels, in NumPy.

Features are cut into at most ``BINS`` quantile bins; trees of fixed depth
grow level by level on gradient histograms of the logistic loss.
"""

from __future__ import annotations

import numpy as np

BINS = 32


class Boosted:
    """``trees`` of a full binary shape: per tree the feature and threshold of
    each inner node in level order, and the leaves' values."""

    def __init__(self, depth: int):
        self.depth, self.start = depth, 0.0
        self.feature, self.threshold, self.value = [], [], []

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += value[node - (2**self.depth - 1)]
        return out


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.3, ridge: float = 1.0) -> Boosted:
    model = Boosted(depth)
    share = float(np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99))
    model.start = float(np.log(share / (1 - share)))
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    codes = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1) if len(x) else x.astype(int)
    margin = np.full(len(x), model.start)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p) + 1e-9
        node = np.zeros(len(x), dtype=np.int64)
        feature = np.zeros(2**depth - 1, dtype=np.int64)
        threshold = np.full(2**depth - 1, np.inf)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            own = node - first
            best = np.zeros(width)
            total_g, total_h = np.bincount(own, g, width), np.bincount(own, h, width)
            base = total_g**2 / (total_h + ridge)
            for j, e in enumerate(edges):
                if len(e) == 0:
                    continue
                slot, bins = own * (len(e) + 1) + codes[:, j], len(e) + 1
                gl = np.bincount(slot, g, width * bins).reshape(width, bins).cumsum(1)[:, :-1]
                hl = np.bincount(slot, h, width * bins).reshape(width, bins).cumsum(1)[:, :-1]
                gain = (gl**2 / (hl + ridge) + (total_g[:, None] - gl)**2 / (total_h[:, None] - hl + ridge) - base[:, None])
                at = gain.argmax(1)
                won = np.flatnonzero(gain[np.arange(width), at] > best + 1e-6)
                best[won] = gain[won, at[won]]
                feature[first + won] = j
                threshold[first + won] = e[at[won]]
            node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > threshold[node])
        leaf = node - (2**depth - 1)
        value = -rate * np.bincount(leaf, g, 2**depth) / (np.bincount(leaf, h, 2**depth) + ridge)
        model.feature.append(feature), model.threshold.append(threshold), model.value.append(value)
        margin += value[leaf]
    return model
