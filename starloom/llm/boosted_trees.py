"""Gradient-boosted trees for two classes, on binned features, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 32


@dataclass(frozen=True)
class BoostedTrees:
    """Complete trees of one depth: ``feature`` and ``bin`` of every inner node, ``leaves`` last.

    A row goes right where its feature lies above the cut ``cuts[feature][bin]``.
    """

    cuts: list[np.ndarray]
    feature: np.ndarray
    bin: np.ndarray
    leaves: np.ndarray
    prior: float

    def binned(self, rows: np.ndarray) -> np.ndarray:
        return _binned(rows, self.cuts)

    def log_odds(self, rows: np.ndarray) -> np.ndarray:
        codes = self.binned(rows)
        out = np.full(len(rows), self.prior)
        depth = int(self.leaves.shape[1]).bit_length() - 1
        everyone = np.arange(len(rows))
        for feature, cut, leaves in zip(self.feature, self.bin, self.leaves, strict=True):
            node = np.zeros(len(rows), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (codes[everyone, feature[node]] > cut[node])
            out += leaves[node - (len(leaves) - 1)]
        return out


def _binned(rows: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    codes = np.empty(rows.shape, np.uint8)
    for k, cut in enumerate(cuts):
        codes[:, k] = np.searchsorted(cut, rows[:, k], "left")
    return codes


def fit_trees(
    rows: np.ndarray,
    labels: np.ndarray,
    weights: np.ndarray,
    trees: int = 40,
    depth: int = 4,
    rate: float = 0.25,
    least_weight: float = 2.0,
    smoothing: float = 1.0,
) -> BoostedTrees:
    """Newton steps on the logistic loss; every split takes the best of all features and cuts."""
    n, width = rows.shape
    cuts = []
    for k in range(width):
        values = np.unique(rows[:, k])
        if len(values) > BINS:
            values = np.unique(np.quantile(rows[:, k], np.linspace(0, 1, BINS + 1)[1:-1]))
        cuts.append((values if len(values) >= BINS - 1 else values[:-1]).astype(np.float32))
    codes = _binned(rows, cuts).astype(np.int64)
    share = np.clip((weights * labels).sum() / max(weights.sum(), 1e-9), 0.01, 0.99)
    prior = float(np.log(share / (1 - share)))
    odds = np.full(n, prior)
    inner, ends = (1 << depth) - 1, 1 << depth
    features, bins, leaves = (np.zeros((trees, inner), np.int64), np.zeros((trees, inner), np.int64),
                              np.zeros((trees, ends)))
    for tree in range(trees):
        chance = 1 / (1 + np.exp(-odds))
        slope, bend = weights * (labels - chance), weights * chance * (1 - chance) + 1e-9
        node = np.zeros(n, np.int64)  # within its level
        for level in range(depth):
            nodes = 1 << level
            best = np.full(nodes, 1e-6)
            at = np.zeros(nodes, np.int64)
            cut = np.full(nodes, BINS + 1)  # above all bins: every row goes left
            for k in range(width):
                if not len(cuts[k]):
                    continue
                place = node * (BINS + 1) + codes[:, k]
                size = nodes * (BINS + 1)
                g = np.bincount(place, slope, size).reshape(nodes, -1).cumsum(1)
                h = np.bincount(place, bend, size).reshape(nodes, -1).cumsum(1)
                all_g, all_h = g[:, -1:], h[:, -1:]
                gain = (
                    g**2 / (h + smoothing)
                    + (all_g - g) ** 2 / (all_h - h + smoothing)
                    - all_g**2 / (all_h + smoothing)
                )
                gain[(h < least_weight / 4) | (all_h - h < least_weight / 4)] = 0
                top = gain.argmax(1)
                value = gain[np.arange(nodes), top]
                better = value > best
                best[better], at[better], cut[better] = value[better], k, top[better]
            features[tree, nodes - 1 : 2 * nodes - 1], bins[tree, nodes - 1 : 2 * nodes - 1] = at, cut
            node = 2 * node + (codes[np.arange(n), at[node]] > cut[node])
        g, h = np.bincount(node, slope, ends), np.bincount(node, bend, ends)
        leaves[tree] = rate * g / (h + smoothing)
        odds += leaves[tree][node]
    return BoostedTrees(cuts, features, bins, leaves, prior)
