"""Gradient-boosted trees for small training sets, with numpy alone."""

from __future__ import annotations

import numpy as np


class Boosted:
    """Binary classifier: logistic loss, trees of fixed depth over quantile thresholds."""

    def __init__(self, trees: int = 40, depth: int = 3, rate: float = 0.3, bins: int = 16):
        self.trees, self.depth, self.rate, self.bins = trees, depth, rate, bins
        self.nodes: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.base = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base = float(np.log(p / (1 - p)))
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0.02, 0.98, self.bins))) for j in range(x.shape[1])]
        codes = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
        width = self.bins + 1
        score = np.full(len(y), self.base)
        leaves = 1 << self.depth
        for _ in range(self.trees):
            q = 1 / (1 + np.exp(-score))
            g, h = y - q, q * (1 - q)
            at = np.zeros(len(y), dtype=np.int64)
            feature, value = np.zeros(leaves - 1, dtype=np.int64), np.full(leaves - 1, np.inf)
            for d in range(self.depth):
                for k in range(1 << d):
                    node = (1 << d) - 1 + k
                    rows = np.flatnonzero(at == k)
                    best = (1e-6, 0, np.inf, 0)
                    if len(rows) >= 8:
                        total_g, total_h = g[rows].sum(), h[rows].sum()
                        for j, c in enumerate(cuts):
                            gs = np.bincount(codes[rows, j], g[rows], width).cumsum()[: len(c)]
                            hs = np.bincount(codes[rows, j], h[rows], width).cumsum()[: len(c)]
                            gain = gs**2 / (hs + 1) + (total_g - gs) ** 2 / (total_h - hs + 1) - total_g**2 / (total_h + 1)
                            b = int(gain.argmax()) if len(gain) else 0
                            if len(gain) and gain[b] > best[0]:
                                best = (gain[b], j, c[b], b)
                    feature[node], value[node] = best[1], best[2]
                go = x[np.arange(len(y)), feature[(1 << d) - 1 + at]] > value[(1 << d) - 1 + at]
                at = 2 * at + go
            leaf = np.bincount(at, g, leaves) / (np.bincount(at, h, leaves) + 1)
            self.nodes.append((feature, value, self.rate * leaf))
            score = score + self.rate * leaf[at]
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        score = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, value, leaf in self.nodes:
            at = np.zeros(len(x), dtype=np.int64)
            for d in range(self.depth):
                first = (1 << d) - 1
                at = 2 * at + (x[rows, feature[first + at]] > value[first + at])
            score = score + leaf[at]
        return 1 / (1 + np.exp(-score))
