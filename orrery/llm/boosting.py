"""Gradient-boosted trees for small dense tables (logistic loss, quantile
bins), fitted on a bounded sample; a model is a few arrays, cheap to send."""

from __future__ import annotations

import numpy as np


class Trees:
    """Trees of equal depth: node i of a level splits on feature[i] at
    threshold[i] (greater goes right)."""

    def __init__(self, trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 32,
                 smooth: float = 1.0) -> None:
        self.size, self.depth, self.rate, self.bins, self.smooth = trees, depth, rate, bins, smooth
        self.base, self.trees = 0.0, []

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        edges = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        coded = np.stack([np.searchsorted(e, c) for e, c in zip(edges, x.T)], axis=1)
        p = np.clip(y.mean(), 1e-4, 1 - 1e-4)
        self.base = float(np.log(p / (1 - p)))
        score = np.full(len(y), self.base)
        for _ in range(self.size):
            prob = 1 / (1 + np.exp(-score))
            gain, hess = y - prob, prob * (1 - prob)
            node = np.zeros(len(y), dtype=np.int64)
            features, thresholds = [], []
            for level in range(self.depth):
                f, t, cut = self._split(coded, edges, node, gain, hess, 1 << level)
                features.append(f)
                thresholds.append(t)
                node = 2 * node + (coded[np.arange(len(y)), f[node]] > cut[node])
            n = 1 << self.depth
            leaf = np.bincount(node, gain, n) / (np.bincount(node, hess, n) + self.smooth)
            self.trees.append((features, thresholds, self.rate * leaf))
            score += self.rate * leaf[node]
        return self

    def _split(self, coded, edges, node, gain, hess, nodes):
        best = np.zeros(nodes)
        feature, threshold = np.zeros(nodes, np.int64), np.full(nodes, np.inf)
        cut = np.full(nodes, self.bins + 1, np.int64)
        g_all, h_all = np.bincount(node, gain, nodes), np.bincount(node, hess, nodes)
        whole = g_all ** 2 / (h_all + self.smooth)
        for j, e in enumerate(edges):
            if not len(e):
                continue
            cell = node * (len(e) + 1) + coded[:, j]
            g = np.bincount(cell, gain, nodes * (len(e) + 1)).reshape(nodes, -1).cumsum(1)[:, :-1]
            h = np.bincount(cell, hess, nodes * (len(e) + 1)).reshape(nodes, -1).cumsum(1)[:, :-1]
            value = g ** 2 / (h + self.smooth) \
                + (g_all[:, None] - g) ** 2 / (h_all[:, None] - h + self.smooth) - whole[:, None]
            at = value.argmax(axis=1)
            better = value[np.arange(nodes), at] > best + 1e-9
            best[better] = value[np.arange(nodes), at][better]
            feature[better], cut[better], threshold[better] = j, at[better], e[at[better]]
        return feature, threshold, cut

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for features, thresholds, leaf in self.trees:
            node = np.zeros(len(x), dtype=np.int64)
            for f, t in zip(features, thresholds):
                node = 2 * node + (x[rows, f[node]] > t[node])
            out += leaf[node]
        return out
