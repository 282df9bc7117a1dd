"""Gradient-boosted trees for a binary label, small enough to train on a bounded sample and to send to every task."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

TREES, DEPTH, RATE, BINS = 60, 4, 0.2, 32
MIN_HESSIAN, RIDGE = 2.0, 1.0


@dataclass
class BoostedTrees:
    """Complete trees: feature and threshold of each inner node, value of each leaf."""

    base: float
    features: np.ndarray  # trees x (2^DEPTH - 1)
    thresholds: np.ndarray
    leaves: np.ndarray  # trees x 2^DEPTH

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of label 1 for each row of x."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, leaf in zip(self.features, self.thresholds, self.leaves):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
            total += leaf[at - (1 << DEPTH) + 1]
        return total


def train(x: np.ndarray, y: np.ndarray) -> BoostedTrees:
    """Fit by second-order boosting of the logistic loss over histograms of BINS quantiles."""
    cuts = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in x.T]
    binned = np.column_stack([np.searchsorted(c, column, "left") for c, column in zip(cuts, x.T)])
    base = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    total = np.full(len(y), base)
    inner, size = (1 << DEPTH) - 1, BINS + 1
    features, thresholds, leaves = [], [], []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-total))
        gradient, hessian = y - p, p * (1 - p)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        at = np.zeros(len(y), np.int64)
        for level in range(DEPTH):
            first, width = (1 << level) - 1, 1 << level
            best = np.full(width, 1e-6)
            for f, column in enumerate(binned.T):
                if not len(cuts[f]):
                    continue
                cell = (at - first) * size + column
                g, h = (np.bincount(cell, v, width * size).reshape(width, size).cumsum(axis=1) for v in (gradient, hessian))
                g_all, h_all = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + RIDGE) + (g_all - g) ** 2 / (h_all - h + RIDGE) - g_all**2 / (h_all + RIDGE)
                gain = np.where((h >= MIN_HESSIAN) & (h_all - h >= MIN_HESSIAN), gain, 0)[:, : len(cuts[f])]
                k = gain.argmax(axis=1)
                won = gain[np.arange(width), k] > best
                best[won] = gain[won, k[won]]
                feature[first : first + width][won] = f
                threshold[first : first + width][won] = cuts[f][k[won]]
            at = 2 * at + 1 + (x[np.arange(len(y)), feature[at]] > threshold[at])
        leaf = at - inner
        g, h = (np.bincount(leaf, v, inner + 1) for v in (gradient, hessian))
        value = RATE * g / (h + RIDGE)
        total += value[leaf]
        features.append(feature)
        thresholds.append(threshold)
        leaves.append(value)
    return BoostedTrees(base, np.array(features), np.array(thresholds), np.array(leaves))
