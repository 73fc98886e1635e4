"""Boosted trees, fitted on the driver from a bounded sample and applied as column expressions."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass
class Node:
    value: float = 0.0
    feature: int = -1
    least: float = 0.0  # the right branch takes values over this
    left: "Node | None" = None
    right: "Node | None" = None


@dataclass
class Boosted:
    """The log-odds of a row: bias plus the leaf of each tree."""

    bias: float = 0.0
    trees: list[Node] = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.bias)
        for tree in self.trees:
            out += _leaf(tree, x)
        return out

    def column(self, features: list[Column]) -> Column:
        """The same margin over columns."""

        def expr(n: Node) -> Column:
            if n.left is None:
                return F.lit(float(n.value))
            return F.when(features[n.feature] > F.lit(float(n.least)), expr(n.right)).otherwise(expr(n.left))

        out = F.lit(float(self.bias))
        for tree in self.trees:
            out = out + expr(tree)
        return out


def _leaf(n: Node, x: np.ndarray) -> np.ndarray:
    if n.left is None:
        return np.full(len(x), n.value)
    over = x[:, n.feature] > n.least
    out = np.empty(len(x))
    out[over], out[~over] = _leaf(n.right, x[over]), _leaf(n.left, x[~over])
    return out


def fit(x: np.ndarray, y: np.ndarray, trees: int = 30, depth: int = 3, rate: float = 0.3, ridge: float = 1.0, least_rows: int = 5) -> Boosted:
    """Newton boosting of the logistic loss with exact splits; features of few distinct values are fast."""
    p0 = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model = Boosted(float(np.log(p0 / (1 - p0))))
    margin = np.full(len(x), model.bias)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        tree = _grow(x, p - y, p * (1 - p), np.arange(len(x)), depth, rate, ridge, least_rows)
        model.trees.append(tree)
        margin += _leaf(tree, x)
    return model


def _grow(x, grad, hess, rows, depth, rate, ridge, least_rows) -> Node:
    g, h = grad[rows].sum(), hess[rows].sum()
    leaf = Node(value=float(-rate * g / (h + ridge)))
    if depth == 0 or len(rows) < 2 * least_rows:
        return leaf
    best = (1e-6, -1, 0.0)
    for f in range(x.shape[1]):
        values, at = np.unique(x[rows, f], return_inverse=True)
        if len(values) < 2:
            continue
        gs, hs, ns = (np.cumsum(np.bincount(at, w, len(values)))[:-1] for w in (grad[rows], hess[rows], np.ones(len(rows))))
        gain = gs**2 / (hs + ridge) + (g - gs) ** 2 / (h - hs + ridge) - g**2 / (h + ridge)
        gain[(ns < least_rows) | (len(rows) - ns < least_rows)] = -1
        k = int(gain.argmax())
        if gain[k] > best[0]:
            best = (float(gain[k]), f, float(values[k] + values[k + 1]) / 2)
    if best[1] < 0:
        return leaf
    over = x[rows, best[1]] > best[2]
    return Node(feature=best[1], least=best[2], left=_grow(x, grad, hess, rows[~over], depth - 1, rate, ridge, least_rows), right=_grow(x, grad, hess, rows[over], depth - 1, rate, ridge, least_rows))


def threshold(margin: np.ndarray, y: np.ndarray, precision: float) -> float:
    """The least margin from which on the share of positives is at least `precision`; none: infinity."""
    order = np.argsort(-margin, kind="stable")
    share = np.cumsum(y[order]) / np.arange(1, len(y) + 1)
    ends = np.append(margin[order][1:] < margin[order][:-1], True)
    good = np.flatnonzero((share >= precision) & ends)
    return float(margin[order][good[-1]]) if len(good) else float("inf")
