"""Gradient-boosted trees for a yes/no label, in numpy: histogram splits, logistic loss."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 32


@dataclass
class Trees:
    """Complete binary trees of equal depth: feature and threshold of each inner node, value of each leaf."""
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    base: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        depth = int(np.log2(self.value.shape[1]))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
            out += value[at - len(feature)]
        return out


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 4, rate: float = 0.3, ridge: float = 5.0) -> Trees:
    """Boost ``rounds`` trees; a split that gains nothing sends every row left."""
    n, m = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(m)]
    binned = np.stack([np.searchsorted(edges[j], x[:, j]) for j in range(m)], 1)     # x > edges[k]  <=>  bin > k
    mean = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    base = float(np.log(mean / (1 - mean)))
    z = np.full(n, base)
    inner, leaves = 2 ** depth - 1, 2 ** depth
    features, thresholds, values = [], [], []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-z))
        g, h = y - p, np.maximum(p * (1 - p), 1e-6)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        at = np.zeros(n, np.int64)
        for level in range(depth):
            first, width = 2 ** level - 1, 2 ** level
            local = at - first
            best = np.zeros(width)
            whole_g, whole_h = (np.bincount(local, v, width) for v in (g, h))
            for j in range(m):
                if not len(edges[j]):
                    continue
                cell = local * BINS + binned[:, j]
                left_g, left_h = (np.bincount(cell, v, width * BINS).reshape(width, BINS).cumsum(1)[:, :len(edges[j])]
                                  for v in (g, h))
                right_g, right_h = whole_g[:, None] - left_g, whole_h[:, None] - left_h
                gain = left_g ** 2 / (left_h + ridge) + right_g ** 2 / (right_h + ridge) \
                    - (whole_g ** 2 / (whole_h + ridge))[:, None]
                k = gain.argmax(1)
                top = gain[np.arange(width), k]
                for i in np.flatnonzero(top > best + 1e-6):
                    best[i], feature[first + i], threshold[first + i] = top[i], j, edges[j][k[i]]
            at = 2 * at + 1 + (x[np.arange(n), feature[at]] > threshold[at])
        leaf = at - inner
        value = rate * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + ridge)
        z += value[leaf]
        features.append(feature)
        thresholds.append(threshold)
        values.append(value)
    return Trees(np.array(features), np.array(thresholds), np.array(values), base)
