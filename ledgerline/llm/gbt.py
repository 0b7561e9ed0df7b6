"""Gradient-boosted trees for a binary label (numpy): binned features, logistic loss, level-wise growth."""

from __future__ import annotations

import numpy as np


class Trees:
    """Boosted trees of a fixed depth over binned features."""

    def __init__(self, n_trees: int = 40, depth: int = 4, rate: float = 0.25, bins: int = 48, l2: float = 1.0,
                 least: float = 5.0):
        self.n_trees, self.depth, self.rate, self.bins, self.l2, self.least = n_trees, depth, rate, bins, l2, least
        self.edges: list[np.ndarray] = []
        self.feature = np.zeros((0, 0), np.int64)
        self.cut = np.zeros((0, 0), np.uint8)
        self.leaf = np.zeros((0, 0))
        self.base = 0.0

    def _binned(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(x.shape, np.uint8)
        for f, e in enumerate(self.edges):
            out[:, f] = np.searchsorted(e, x[:, f], side="left")
        return out

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Trees:
        """x [rows, features], labels 0/1 and row weights."""
        self.edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, self.bins)[1:-1])) for f in range(x.shape[1])]
        b = self._binned(x).astype(np.int64)
        inner, n_bins = 2 ** self.depth - 1, self.bins
        self.base = float(np.log((weight @ y + 1) / (weight @ (1 - y) + 1)))
        score = np.full(len(y), self.base)
        features, cuts, leaves = [], [], []
        for _ in range(self.n_trees):
            p = 1 / (1 + np.exp(-score))
            g, h = weight * (p - y), weight * p * (1 - p)
            feature, cut = np.zeros(inner, np.int64), np.full(inner, 255, np.uint8)     # 255: all go left
            node = np.zeros(len(y), np.int64)
            for level in range(self.depth):
                width = 2 ** level
                best, start = np.zeros(width), width - 1
                for f in range(x.shape[1]):
                    key = node * n_bins + b[:, f]
                    sums = [np.cumsum(np.bincount(key, w, width * n_bins).reshape(width, n_bins), axis=1) for w in (g, h)]
                    gl, hl = sums[0][:, :-1], sums[1][:, :-1]
                    gt, ht = sums[0][:, -1:], sums[1][:, -1:]
                    gain = gl ** 2 / (hl + self.l2) + (gt - gl) ** 2 / (ht - hl + self.l2) - gt ** 2 / (ht + self.l2)
                    gain[(hl < self.least) | (ht - hl < self.least)] = 0
                    at = gain.argmax(axis=1)
                    top = gain[np.arange(width), at]
                    better = top > best + 1e-9
                    best[better] = top[better]
                    feature[start:start + width][better] = f
                    cut[start:start + width][better] = at[better]
                node = 2 * node + (b[np.arange(len(y)), feature[start + node]] > cut[start + node])
            gs, hs = (np.bincount(node, w, 2 ** self.depth) for w in (g, h))
            leaf = -self.rate * gs / (hs + self.l2)
            score += leaf[node]
            features.append(feature)
            cuts.append(cut)
            leaves.append(leaf)
        self.feature, self.cut, self.leaf = np.array(features), np.array(cuts), np.array(leaves)
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of label 1."""
        b = self._binned(x)
        rows, score = np.arange(len(x)), np.full(len(x), self.base)
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for level in range(self.depth):
                at = node + 2 ** level - 1
                node = 2 * node + (b[rows, feature[at]] > cut[at])
            score += leaf[node]
        return score
