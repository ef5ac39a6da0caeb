"""Small gradient-boosted trees and isotonic calibration in numpy, for bounded training samples."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np


class Tree(NamedTuple):
    """A full binary tree in heap order: a node sends x[feature] > threshold to the right."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray  # of the leaves

    def predict(self, x: np.ndarray) -> np.ndarray:
        node, inner = np.zeros(len(x), np.int64), len(self.feature)
        while len(node) and node[0] < inner:
            node = 2 * node + 1 + (x[np.arange(len(x)), self.feature[node]] > self.threshold[node])
        return self.value[node - inner]


class Boosted(NamedTuple):
    base: float
    rate: float
    trees: list[Tree]

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for tree in self.trees:
            out += self.rate * tree.predict(x)
        return out


def _grow(codes: np.ndarray, edges: list[np.ndarray], g: np.ndarray, h: np.ndarray, depth: int, least: float) -> Tree:
    n, width = codes.shape
    bins = max(len(e) for e in edges) + 1
    inner = (1 << depth) - 1
    feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
    node = np.zeros(n, np.int64)
    for level in range(depth):
        first, count = (1 << level) - 1, 1 << level
        local = node - first
        best = np.full(count, 1e-9)
        for f in range(width):
            if not len(edges[f]):
                continue
            at = local * bins + codes[:, f]
            gs = np.bincount(at, g, count * bins).reshape(count, bins).cumsum(1)
            hs = np.bincount(at, h, count * bins).reshape(count, bins).cumsum(1)
            gl, hl, gt, ht = gs[:, : len(edges[f])], hs[:, : len(edges[f])], gs[:, -1:], hs[:, -1:]
            gain = gl**2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt**2 / (ht + 1)
            gain[(hl < least) | (ht - hl < least)] = 0
            at_best = gain.argmax(1)
            won = gain[np.arange(count), at_best]
            for k in np.flatnonzero(won > best):
                best[k], feature[first + k], threshold[first + k] = won[k], f, edges[f][at_best[k]]
        cut = np.array([np.searchsorted(edges[f], t) if np.isfinite(t) else bins for f, t in zip(feature[first : first + count], threshold[first : first + count], strict=True)])
        node = 2 * node + 1 + (codes[np.arange(n), feature[node]] > cut[local])
    leaf = node - inner
    value = -np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + 1)
    return Tree(feature, threshold, value)


def boost(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 3, rate: float = 0.2, bins: int = 48, least: float = 1.5) -> Boosted:
    """Logistic boosting on quantile bins.  Features without spread are never split."""
    p = float(np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3))
    model = Boosted(float(np.log(p / (1 - p))), rate, [])
    if not len(y) or y.min() == y.max():
        return model
    edges = []
    for column in x.T:
        quantiles = np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1]))
        edges.append(quantiles[quantiles < column.max()])
    codes = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T, strict=True)], 1)
    margin = np.full(len(y), model.base)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        tree = _grow(codes, edges, p - y, p * (1 - p), depth, least)
        model.trees.append(tree)
        margin += rate * tree.predict(x)
    return model


class Isotonic(NamedTuple):
    """A non-decreasing map from margin to probability, linear between its knots."""

    knots: np.ndarray
    values: np.ndarray

    def __call__(self, margin: np.ndarray) -> np.ndarray:
        return np.interp(margin, self.knots, self.values)


def isotonic(margin: np.ndarray, y: np.ndarray) -> Isotonic:
    """Pool adjacent violators; block means are drawn in by one half row of either label."""
    if not len(y):
        return Isotonic(np.array([-8.0, 8.0]), 1 / (1 + np.exp([8.0, -8.0])))
    order = np.argsort(margin, kind="stable")
    blocks: list[list[float]] = []  # sum of labels, rows, sum of margins
    for m, label in zip(margin[order], y[order], strict=True):
        blocks.append([float(label), 1.0, float(m)])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    values = np.maximum.accumulate([(s + 0.5) / (n + 1) for s, n, _ in blocks])
    return Isotonic(np.array([m / n for _, n, m in blocks]), values)
