"""Gradient-boosted trees for two classes, in numpy: histograms of binned features, logistic loss."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Boosted:
    """Trees as complete binary trees of the same depth: features, thresholds and leaf values."""

    start: float
    feature: np.ndarray  # trees x (2^depth - 1)
    threshold: np.ndarray
    leaf: np.ndarray  # trees x 2^depth

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        depth = int(np.log2(self.leaf.shape[1])) if self.leaf.size else 0
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += leaf[node - (len(leaf) - 1)]
        return out


def _bins(column: np.ndarray, most: int) -> np.ndarray:
    """Thresholds between values: all of few, quantiles of many."""
    values = np.unique(column)
    if len(values) > most:
        values = np.unique(np.quantile(column, np.linspace(0, 1, most + 1), method="nearest"))
    return (values[1:] + values[:-1]) / 2


def boost(
    x: np.ndarray,
    y: np.ndarray,
    weight: np.ndarray | None = None,
    trees: int = 80,
    depth: int = 3,
    rate: float = 0.2,
    bins: int = 24,
    ridge: float = 2.0,
) -> Boosted:
    """Fit trees to log-odds, each on the gradient and curvature of what the ones before it leave.

    A split is the one with the largest gain in loss; ties go to the lowest feature. Without rows of both
    classes there are no trees.
    """
    weight = np.ones(len(y)) if weight is None else weight
    share = float(np.average(y, weights=weight)) if len(y) else 0.0
    share = min(max(share, 1e-3), 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    inner, leaves = 2**depth - 1, 2**depth
    if len(np.unique(y)) < 2:
        none = np.empty((0, inner))
        return Boosted(start, none.astype(int), none, np.empty((0, leaves)))
    cuts = [_bins(c, bins) for c in x.T]
    used = [f for f, c in enumerate(cuts) if len(c)]
    width = max(len(cuts[f]) for f in used) + 1
    binned = np.stack([np.searchsorted(cuts[f], x[:, f], side="left") for f in used], axis=1)
    flat = binned + np.arange(len(used)) * width
    margin = np.full(len(y), start)
    features, thresholds, values = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = weight * (y - p), np.maximum(1e-6, weight * p * (1 - p))
        node = np.zeros(len(y), np.int64)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for k in range(inner):
            mine = np.flatnonzero(node == k)
            if len(mine) >= 2:
                cells = flat[mine].ravel()
                size = len(used) * width
                g = np.bincount(cells, np.repeat(grad[mine], len(used)), size).reshape(-1, width).cumsum(1)
                h = np.bincount(cells, np.repeat(hess[mine], len(used)), size).reshape(-1, width).cumsum(1)
                all_g, all_h = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + ridge) + (all_g - g) ** 2 / (all_h - h + ridge)
                gain -= all_g**2 / (all_h + ridge)
                best = int(gain.argmax())
                f, b = divmod(best, width)
                if gain.flat[best] > 1e-6 and b < len(cuts[used[f]]):
                    feature[k], threshold[k] = used[f], cuts[used[f]][b]
            node[mine] = 2 * k + 1 + (x[mine, feature[k]] > threshold[k])
        leaf_of = node - inner
        g = np.bincount(leaf_of, grad, leaves)
        h = np.bincount(leaf_of, hess, leaves)
        leaf = rate * g / (h + ridge)
        margin += leaf[leaf_of]
        features.append(feature)
        thresholds.append(threshold)
        values.append(leaf)
    return Boosted(start, np.array(features), np.array(thresholds), np.array(values))
