"""FTRL-proximal logistic regression over sets of hashed features (numpy core)."""

from __future__ import annotations

import numpy as np

from ledgerline.llm import textkernel as K

U64 = np.uint64


def word_features(raw: np.ndarray, offsets: np.ndarray, bits: int, grams: tuple[int, ...] = (1, 2), skips: tuple[int, ...] = (2,)):
    """Hashed word n-grams and skip-grams of the documents of a slab: (feature index, doc index).

    A skip-gram joins a word with the one ``skip`` words on.
    """
    h, _, doc, _ = K.words(raw, offsets)
    feats, docs = [], []
    for n in grams:
        m = len(h) - n + 1
        if m > 0:
            g = np.zeros(m, U64)
            for k in range(n):
                g += h[k:m + k] * K.ORDER[k]
            inside = doc[:m] == doc[n - 1:]
            feats.append(K.mix64(g + U64(n))[inside])
            docs.append(doc[:m][inside])
    for s in skips:
        if len(h) > s:
            inside = doc[:-s] == doc[s:]
            feats.append(K.mix64(h[:-s] * K.ORDER[20] + h[s:] * K.ORDER[20 + s])[inside])
            docs.append(doc[:-s][inside])
    if not feats:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return (np.concatenate(feats) >> U64(64 - bits)).astype(np.int64), np.concatenate(docs)


class Ftrl:
    """Per-coordinate learning rates, L1 and L2; features are sets, plus an unpenalised bias."""

    def __init__(self, bits: int, alpha: float = 0.3, beta: float = 1.0, l1: float = 1.0, l2: float = 0.1):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z = np.zeros(1 << bits)
        self.n = np.zeros(1 << bits)
        self.bias_z = self.bias_n = 0.0

    def weights(self, z: np.ndarray, n: np.ndarray) -> np.ndarray:
        w = (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) > self.l1, w, 0.0)

    def bias(self) -> float:
        return -self.bias_z / ((self.beta + self.bias_n ** 0.5) / self.alpha)

    def learn(self, features: np.ndarray, label: int) -> None:
        """One example: distinct feature indexes and its label."""
        z, n = self.z[features], self.n[features]
        w = self.weights(z, n)
        bias = self.bias()
        g = 1.0 / (1.0 + np.exp(-np.clip(w.sum() + bias, -35, 35))) - label
        step = (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha
        self.z[features] = z + g - step * w
        self.n[features] = n + g * g
        self.bias_z += g - ((self.bias_n + g * g) ** 0.5 - self.bias_n ** 0.5) / self.alpha * bias
        self.bias_n += g * g
