"""Gradient-boosted trees for yes or no, on binned numeric features."""

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Trees:
    """Complete binary trees of one depth: inner nodes in level order, then leaves."""

    depth: int
    prior: float
    features: np.ndarray  # trees x inner nodes
    cuts: np.ndarray  # go right if the feature is above
    leaves: np.ndarray  # trees x leaves

    def logits(self, rows: np.ndarray) -> np.ndarray:
        out = np.full(len(rows), self.prior)
        each = np.arange(len(rows))
        for features, cuts, leaves in zip(self.features, self.cuts, self.leaves):
            node = np.zeros(len(rows), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (rows[each, features[node]] > cuts[node])
            out += leaves[node - len(features)]
        return out


def fit(rows: np.ndarray, labels: np.ndarray, trees: int = 40, depth: int = 4, rate: float = 0.3, bins: int = 32,
        ridge: float = 1.0, weights: np.ndarray | None = None) -> Trees:
    """Trees by second-order gain; a constant without rows or with one kind of label only."""
    inner = 2 ** depth - 1
    weights = np.ones(len(rows)) if weights is None else weights
    share = float(np.average(labels, weights=weights)) if len(rows) else 0.0
    prior = float(np.log(max(share, 1e-3) / max(1 - share, 1e-3)))
    if share in (0.0, 1.0):
        return Trees(depth, prior, np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for column in rows.T]
    binned = np.array([np.searchsorted(e, column) for e, column in zip(edges, rows.T)])  # bin > k: value > edge k
    count = rows.shape[1]
    logits, all_features, all_cuts, all_leaves = np.full(len(rows), prior), [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-logits))
        gradient, curve = weights * (labels - p), weights * np.maximum(p * (1 - p), 1e-6)
        features, cuts = np.zeros(inner, int), np.full(inner, np.inf)
        node = np.zeros(len(rows), np.int64)
        for level in range(depth):
            first, width = 2 ** level - 1, 2 ** level
            at = node - first
            g_all, h_all = np.bincount(at, gradient, width), np.bincount(at, curve, width)
            best = np.full(width, 1e-9)
            for f in range(count):
                if not len(edges[f]):
                    continue
                cell = at * (bins + 1) + binned[f]
                g = np.cumsum(np.bincount(cell, gradient, width * (bins + 1)).reshape(width, -1), axis=1)[:, :len(edges[f])]
                h = np.cumsum(np.bincount(cell, curve, width * (bins + 1)).reshape(width, -1), axis=1)[:, :len(edges[f])]
                gain = g ** 2 / (h + ridge) + (g_all[:, None] - g) ** 2 / (h_all[:, None] - h + ridge) - (
                    g_all ** 2 / (h_all + ridge))[:, None]
                k = gain.argmax(axis=1)
                top = gain[np.arange(width), k]
                better = top > best
                best[better] = top[better]
                features[first:first + width][better] = f
                cuts[first:first + width][better] = edges[f][k[better]]
            node = 2 * node + 1 + (rows[np.arange(len(rows)), features[node]] > cuts[node])
        leaf = node - inner
        values = rate * np.bincount(leaf, gradient, inner + 1) / (np.bincount(leaf, curve, inner + 1) + ridge)
        logits += values[leaf]
        all_features.append(features), all_cuts.append(cuts), all_leaves.append(values)
    return Trees(depth, prior, np.array(all_features), np.array(all_cuts), np.array(all_leaves))
