"""Small gradient boosting for a few thousand rows of features, with calibrated probabilities."""

from __future__ import annotations

import numpy as np


class BoostedTrees:
    """Logistic gradient boosting of shallow trees over binned features, with Platt scaling on rows left out of it."""

    def __init__(self, rounds: int = 40, depth: int = 3, rate: float = 0.25, bins: int = 32, l2: float = 1.0):
        self.rounds, self.depth, self.rate, self.bins, self.l2 = rounds, depth, rate, bins, l2

    def fit(self, rows: np.ndarray, labels: np.ndarray, held: np.ndarray) -> BoostedTrees:
        """``held`` marks the rows that only set the calibration."""
        x, y = rows[~held], labels[~held].astype(float)
        self.edges = [np.unique(np.quantile(x[:, i], np.linspace(0, 1, self.bins)[1:-1])) for i in range(x.shape[1])]
        binned = self._bin(x)
        rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.start = float(np.log(rate / (1 - rate)))
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        score = np.full(len(y), self.start)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            tree = self._grow(binned, y - p, p * (1 - p))
            self.trees.append(tree)
            score += self.rate * self._leaf(tree, binned)
        self.scale = self._platt(self.margin(rows[held]), labels[held].astype(float))
        return self

    def _bin(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(edges, x[:, i], side="right") for i, edges in enumerate(self.edges)], axis=1)

    def _grow(self, binned: np.ndarray, pull: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Split feature and bin of each inner node of a full tree, level by level, and the leaves' values."""
        features, cuts = np.zeros((1 << self.depth) - 1, int), np.full((1 << self.depth) - 1, self.bins)
        node = np.zeros(len(pull), int)
        for level in range(self.depth):
            first, count = (1 << level) - 1, 1 << level
            best = np.zeros(count)
            for feature in range(binned.shape[1]):
                slot = node * self.bins + binned[:, feature]
                g = np.bincount(slot, pull, count * self.bins).reshape(count, -1).cumsum(axis=1)
                h = np.bincount(slot, weight, count * self.bins).reshape(count, -1).cumsum(axis=1)
                total_g, total_h = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + self.l2) + (total_g - g) ** 2 / (total_h - h + self.l2) - total_g**2 / (total_h + self.l2)
                gain[(h < 1) | (total_h - h < 1)] = 0
                at = gain.argmax(axis=1)
                better = gain[np.arange(count), at] > best + 1e-9
                best[better] = gain[np.arange(count), at][better]
                features[first : first + count][better] = feature
                cuts[first : first + count][better] = at[better]
            node = 2 * node + (binned[np.arange(len(node)), features[first + node]] > cuts[first + node])
        g, h = np.bincount(node, pull, 1 << self.depth), np.bincount(node, weight, 1 << self.depth)
        return features, cuts, g / (h + self.l2)

    def _leaf(self, tree: tuple[np.ndarray, np.ndarray, np.ndarray], binned: np.ndarray) -> np.ndarray:
        features, cuts, values = tree
        node = np.zeros(len(binned), int)
        for level in range(self.depth):
            at = (1 << level) - 1 + node
            node = 2 * node + (binned[np.arange(len(node)), features[at]] > cuts[at])
        return values[node]

    def margin(self, rows: np.ndarray) -> np.ndarray:
        binned = self._bin(rows)
        return self.start + self.rate * sum(self._leaf(tree, binned) for tree in self.trees)

    @staticmethod
    def _platt(margin: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
        """Slope and offset that fit the labels best, with targets drawn in a little; the identity without both labels."""
        ones, zeros = labels.sum(), len(labels) - labels.sum()
        if not ones or not zeros:
            return 1.0, 0.0
        target = np.where(labels > 0, (ones + 1) / (ones + 2), 1 / (zeros + 2))
        x, w = np.stack([margin, np.ones_like(margin)], axis=1), np.array([1.0, 0.0])
        for _ in range(25):
            p = 1 / (1 + np.exp(-x @ w))
            curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
            w = w + np.clip(np.linalg.solve(curve, x.T @ (target - p)), -2, 2)
        return float(w[0]), float(w[1])

    def probability(self, rows: np.ndarray) -> np.ndarray:
        slope, offset = self.scale
        return 1 / (1 + np.exp(-(slope * self.margin(rows) + offset)))
