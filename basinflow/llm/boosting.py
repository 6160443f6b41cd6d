"""Gradient-boosted regression trees for binary labels, in numpy alone."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

from .features import sigmoid


@dataclass
class Tree:
    """Nodes by number; a leaf has feature -1."""

    feature: list[int] = field(default_factory=list)
    limit: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)

    def add(self, value: float) -> int:
        for column, v in ((self.feature, -1), (self.limit, 0.0), (self.left, -1), (self.right, -1), (self.value, value)):
            column.append(v)
        return len(self.value) - 1

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), int)
        feature, limit = np.array(self.feature), np.array(self.limit)
        left, right = np.array(self.left), np.array(self.right)
        while True:
            inner = feature[at] >= 0
            if not inner.any():
                return np.array(self.value)[at]
            rows, nodes = np.flatnonzero(inner), at[inner]
            at[rows] = np.where(x[rows, feature[nodes]] <= limit[nodes], left[nodes], right[nodes])


def grow(tree: Tree, x: np.ndarray, g: np.ndarray, h: np.ndarray, rows: np.ndarray, depth: int, rate: float, ridge: float = 1.0, least: int = 8) -> int:
    """Add the subtree for these rows by exact greedy splits on first and second derivatives."""
    total_g, total_h = g[rows].sum(), h[rows].sum()
    node = tree.add(-rate * total_g / (total_h + ridge))
    if depth == 0 or len(rows) < 2 * least:
        return node
    best = (1e-6, -1, 0.0)
    for f in range(x.shape[1]):
        order = rows[np.argsort(x[rows, f], kind="stable")]
        v = x[order, f]
        cg, ch = np.cumsum(g[order])[:-1], np.cumsum(h[order])[:-1]
        gain = cg**2 / (ch + ridge) + (total_g - cg) ** 2 / (total_h - ch + ridge) - total_g**2 / (total_h + ridge)
        gain[(v[1:] == v[:-1])] = -1
        gain[: least - 1] = gain[len(gain) - least + 1 :] = -1
        k = int(gain.argmax())
        if gain[k] > best[0]:
            best = (float(gain[k]), f, float((v[k] + v[k + 1]) / 2))
    if best[1] < 0:
        return node
    goes = x[rows, best[1]] <= best[2]
    tree.feature[node], tree.limit[node] = best[1], best[2]
    tree.left[node] = grow(tree, x, g, h, rows[goes], depth - 1, rate, ridge, least)
    tree.right[node] = grow(tree, x, g, h, rows[~goes], depth - 1, rate, ridge, least)
    return node


@dataclass
class Boosted:
    start: float
    trees: list[Tree]

    def logits(self, x: np.ndarray) -> np.ndarray:
        return self.start + sum((t.predict(x) for t in self.trees), np.zeros(len(x)))


def boost(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, rate: float = 0.2) -> Boosted:
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model = Boosted(float(np.log(mean / (1 - mean))), [])
    z = np.full(len(y), model.start)
    for _ in range(trees):
        p = sigmoid(z)
        tree = Tree()
        grow(tree, x, p - y, p * (1 - p), np.arange(len(y)), depth, rate)
        model.trees.append(tree)
        z += tree.predict(x)
    return model
