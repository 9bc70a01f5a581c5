"""Gradient-boosted trees for two classes and isotonic calibration, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Tree:
    """A full binary tree by level: node k has children 2k+1 and 2k+2; the last level has leaves."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        inner = len(self.feature)
        rows = np.arange(len(x))
        while inner and node.size and node[0] < inner:
            node = 2 * node + 1 + (x[rows, self.feature[node]] > self.threshold[node])
        return self.value[node - inner]


@dataclass(frozen=True)
class Model:
    """Log odds as the sum of trees, then a monotone piecewise linear map to a probability."""

    prior: float
    rate: float
    trees: tuple[Tree, ...]
    knots: np.ndarray
    levels: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.prior)
        for tree in self.trees:
            out += self.rate * tree.predict(x)
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.empty(0)
        if not self.trees:
            return np.full(len(x), float(self.levels[0]))
        return np.interp(self.margin(x), self.knots, self.levels)


def _tree(
    binned: np.ndarray,
    edges: list[np.ndarray],
    gradient: np.ndarray,
    hessian: np.ndarray,
    depth: int,
    least_hessian: float,
    ridge: float,
) -> tuple[Tree, np.ndarray]:
    """The tree and the leaf of each row."""
    inner = 2**depth - 1
    feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
    node = np.zeros(len(binned), np.int64)
    columns, bins = binned.shape[1], max(len(e) for e in edges) + 1
    for level in range(depth):
        first, count = 2**level - 1, 2**level
        slot = (node - first)[:, None] * bins + binned
        gain, cut = np.zeros((columns, count)), np.zeros((columns, count), np.int64)
        for c in range(columns):
            g = np.bincount(slot[:, c], gradient, count * bins).reshape(count, bins).cumsum(axis=1)
            h = np.bincount(slot[:, c], hessian, count * bins).reshape(count, bins).cumsum(axis=1)
            total_g, total_h = g[:, -1:], h[:, -1:]
            score = (
                g**2 / (h + ridge)
                + (total_g - g) ** 2 / (total_h - h + ridge)
                - total_g**2 / (total_h + ridge)
            )
            score[(h < least_hessian) | (total_h - h < least_hessian)] = 0
            cut[c] = score.argmax(axis=1)
            gain[c] = score[np.arange(count), cut[c]]
        best = gain.argmax(axis=0)
        for k in range(count):
            c, b = best[k], cut[best[k], k]
            if gain[c, k] > 1e-9 and b < len(edges[c]):
                feature[first + k], threshold[first + k] = c, edges[c][b]
        bound = np.full(inner, bins, np.int64)
        for k in range(count):
            if np.isfinite(threshold[first + k]):
                bound[first + k] = cut[best[k], k]
        node = 2 * node + 1 + (binned[np.arange(len(binned)), feature[node]] > bound[node])
    leaf = node - inner
    g, h = np.bincount(leaf, gradient, 2**depth), np.bincount(leaf, hessian, 2**depth)
    return Tree(feature, threshold, -g / (h + ridge)), leaf


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots and non-decreasing levels by pooling adjacent violators.

    Each pool gives its mean at its middle. Counts are smoothed by half a row of either class, so
    that no level is 0 or 1 for lack of rows.
    """
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []
    for at, label in zip(x[order], y[order], strict=True):
        pools.append([float(label), 1.0, float(at), float(at)])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            s, n, low, high = pools.pop()
            pools[-1] = [pools[-1][0] + s, pools[-1][1] + n, pools[-1][2], high]
    knots = np.array([(p[2] + p[3]) / 2 for p in pools])
    levels = np.maximum.accumulate([(p[0] + 0.5) / (p[1] + 1) for p in pools])
    return knots, levels


def constant(probability: float) -> Model:
    return Model(0.0, 0.0, (), np.array([0.0]), np.array([probability]))


def fit(
    x: np.ndarray,
    y: np.ndarray,
    calibration: np.ndarray,
    *,
    rounds: int = 120,
    depth: int = 3,
    rate: float = 0.1,
    bins: int = 64,
    least_hessian: float = 2.0,
    ridge: float = 1.0,
) -> Model:
    """Trees from the rows outside ``calibration``, the monotone map from the rows inside."""
    own, held = ~calibration, calibration
    if not len(y) or y[own].min(initial=1) == y[own].max(initial=0) or not held.any():
        return constant(float(y.mean()) if len(y) else 0.0)
    features, labels = x[own], y[own].astype(float)
    edges = [
        np.unique(np.quantile(features[:, c], np.linspace(0, 1, bins + 1)[1:-1]))
        for c in range(x.shape[1])
    ]
    binned = np.column_stack(
        [np.searchsorted(e, features[:, c], "left") for c, e in enumerate(edges)]
    )
    rate_of_ones = labels.mean()
    prior = float(np.log(rate_of_ones / (1 - rate_of_ones)))
    margin, trees = np.full(len(labels), prior), []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        tree, leaf = _tree(binned, edges, p - labels, p * (1 - p), depth, least_hessian, ridge)
        trees.append(tree)
        margin += rate * tree.value[leaf]
    model = Model(prior, rate, tuple(trees), np.zeros(1), np.zeros(1))
    knots, levels = isotonic(model.margin(x[held]), y[held].astype(float))
    return Model(prior, rate, tuple(trees), knots, levels)
