"""Gradient-boosted trees for two classes, trained in numpy on the driver from a bounded sample, and read as a table,
as numpy, or as an expression of DataFrame functions."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

BINS = 32


@dataclass
class Tree:
    """A complete binary tree: node k has children 2k+1 (value <= threshold) and 2k+2."""

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def values(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        for _ in range(int(np.log2(len(self.leaf)))):
            node = 2 * node + 1 + (x[np.arange(len(x)), self.feature[node]] > self.threshold[node])
        return self.leaf[node - len(self.feature)]


@dataclass
class Forest:
    base: float
    trees: list[Tree] = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.base + sum((t.values(x) for t in self.trees), np.zeros(len(x)))

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -40, 40)))

    def column(self, features: list[Column]) -> Column:
        """The margin as an expression: one CASE per tree."""

        def below(tree: Tree, k: int) -> Column:
            if k >= len(tree.feature):
                return F.lit(float(tree.leaf[k - len(tree.feature)]))
            if not np.isfinite(tree.threshold[k]):
                return below(tree, 2 * k + 1)
            return F.when(features[tree.feature[k]] <= float(tree.threshold[k]), below(tree, 2 * k + 1)).otherwise(below(tree, 2 * k + 2))

        total = F.lit(float(self.base))
        for tree in self.trees:
            total = total + below(tree, 0)
        return total


def train(x: np.ndarray, y: np.ndarray, n_trees: int = 40, depth: int = 3, rate: float = 0.2, least_weight: float = 2.0, ridge: float = 1.0, weight: np.ndarray | None = None) -> Forest:
    """Second-order boosting of the logistic loss over binned features. x: (rows, features), y: 0 or 1."""
    weight = np.ones(len(y)) if weight is None else weight
    share = np.clip((y * weight).sum() / max(weight.sum(), 1e-9), 1e-3, 1 - 1e-3)
    forest = Forest(float(np.log(share / (1 - share))))
    if len(y) == 0 or y.min() == y.max():
        return forest
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in x.T]
    binned = np.stack([np.searchsorted(e, column) for e, column in zip(edges, x.T)], axis=1)
    margin, n_features = np.full(len(y), forest.base), x.shape[1]
    for _ in range(n_trees):
        p = 1 / (1 + np.exp(-np.clip(margin, -40, 40)))
        slope, bend = weight * (p - y), weight * np.maximum(p * (1 - p), 1e-6)
        inner = 2**depth - 1
        tree = Tree(np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(2**depth))
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, n = 2**level - 1, 2**level
            best = np.zeros(n)
            place = (node - first) * (BINS + 1)
            for f in range(n_features):
                if not len(edges[f]):
                    continue
                g = np.bincount(place + binned[:, f], slope, n * (BINS + 1)).reshape(n, -1).cumsum(axis=1)
                h = np.bincount(place + binned[:, f], bend, n * (BINS + 1)).reshape(n, -1).cumsum(axis=1)
                left, right, all_g, all_h = g[:, :-1], g[:, -1:] - g[:, :-1], g[:, -1:], h[:, -1:]
                gain = left**2 / (h[:, :-1] + ridge) + right**2 / (all_h - h[:, :-1] + ridge) - all_g**2 / (all_h + ridge)
                gain[(h[:, :-1] * 4 < least_weight) | ((all_h - h[:, :-1]) * 4 < least_weight)] = 0
                gain[:, len(edges[f]) :] = 0
                top = gain.argmax(axis=1)
                for k in np.flatnonzero(gain[np.arange(n), top] > best + 1e-9):
                    best[k] = gain[k, top[k]]
                    tree.feature[first + k], tree.threshold[first + k] = f, edges[f][top[k]]
            node = 2 * node + 1 + (x[np.arange(len(y)), tree.feature[node]] > tree.threshold[node])
        at = node - inner
        tree.leaf = -rate * np.bincount(at, slope, 2**depth) / (np.bincount(at, bend, 2**depth) + ridge)
        margin = margin + tree.leaf[at]
        forest.trees.append(tree)
    return forest


def cut_for_precision(p: np.ndarray, y: np.ndarray, precision: float) -> float:
    """The least threshold at which the share of true ones among those at or above it reaches precision, on rows not trained
    on; above 1 if there is none."""
    order = np.argsort(-p, kind="stable")
    p, y = p[order], y[order]
    right = np.cumsum(y) / np.arange(1, len(y) + 1)
    ends = np.flatnonzero(np.append(p[:-1] != p[1:], True)) if len(p) else np.empty(0, int)
    good = [k for k in ends if right[k] >= precision]
    return float(p[good[-1]]) if good else 1.1
