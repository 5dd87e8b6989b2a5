"""Boosted trees in numpy: trained on a bounded table, flattened into node arrays."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np

BINS = 64


@dataclass(frozen=True)
class Tree:
    """Node arrays; a row goes left if its feature is below the threshold. Leaves have feature -1."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Values of all rows at once: every row steps down one level at a time."""
        node, rows = np.zeros(len(x), dtype=np.int64), np.arange(len(x))
        while True:
            feature = self.feature[node]
            inner = feature >= 0
            if not inner.any():
                return self.value[node]
            low = x[rows, np.maximum(feature, 0)] < self.threshold[node]
            node = np.where(inner, np.where(low, self.left[node], self.right[node]), node)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _edges(column: np.ndarray) -> np.ndarray:
    values = np.unique(column)
    if len(values) > BINS:
        values = np.unique(np.quantile(values, np.linspace(0, 1, BINS)))
    return (values[1:] + values[:-1]) / 2


def _grow(bins, edges, grad, hess, depth, least, ridge, signs) -> Tree:
    feature, threshold, left, right, value = [], [], [], [], []

    def node(rows: np.ndarray, level: int, low: float, high: float) -> int:
        me = len(feature)
        for array in (feature, threshold, left, right, value):
            array.append(0)
        g, h = grad[rows].sum(), hess[rows].sum()
        mean = float(np.clip(-g / (h + ridge), low, high))
        feature[me], threshold[me], left[me], right[me], value[me] = -1, 0.0, me, me, mean
        if level == depth or len(rows) < 2 * least:
            return me
        best = (1e-6, -1, 0, 0.0, 0.0)
        for f, cuts in enumerate(edges):
            if not len(cuts):
                continue
            at = bins[rows, f]
            n = np.cumsum(np.bincount(at, minlength=len(cuts) + 1))[:-1]
            gl = np.cumsum(np.bincount(at, grad[rows], len(cuts) + 1))[:-1]
            hl = np.cumsum(np.bincount(at, hess[rows], len(cuts) + 1))[:-1]
            gr, hr = g - gl, h - hl
            lv, rv = np.clip(-gl / (hl + ridge), low, high), np.clip(-gr / (hr + ridge), low, high)
            gain = gl**2 / (hl + ridge) + gr**2 / (hr + ridge) - g**2 / (h + ridge)
            ok = (n >= least) & (len(rows) - n >= least) & (signs.get(f, 0) * (rv - lv) >= 0)
            gain = np.where(ok, gain, 0)
            cut = int(gain.argmax())
            if gain[cut] > best[0]:
                best = (gain[cut], f, cut, lv[cut], rv[cut])
        _, f, cut, lv, rv = best
        if f < 0:
            return me
        goes = bins[rows, f] <= cut
        middle, sign = (lv + rv) / 2, signs.get(f, 0)
        bounds = {0: ((low, high), (low, high)), 1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}
        (ll, lh), (rl, rh) = bounds[sign]
        feature[me], threshold[me] = f, float(edges[f][cut])
        left[me] = node(rows[goes], level + 1, ll, lh)
        right[me] = node(rows[~goes], level + 1, rl, rh)
        return me

    node(np.arange(len(grad)), 0, -np.inf, np.inf)
    return Tree(np.array(feature), np.array(threshold), np.array(left), np.array(right), np.array(value))


def boost(
    x: np.ndarray,
    y: np.ndarray,
    rounds: int,
    depth: int,
    rate: float = 0.2,
    least: int = 10,
    ridge: float = 1.0,
    signs: Mapping[int, int] | None = None,
    sample: float = 1.0,
    seed: int = 0,
) -> tuple[float, list[Tree]]:
    """Gradient-boosted trees for a logistic loss: base value and trees (values times ``rate``).

    ``signs`` holds features along which the score may only rise (1) or fall (-1): a split
    against the sign is not taken, and the children's values are kept on their side of the
    middle, so that no later split can cross it. Each tree sees a seeded share of the rows.
    """
    rng = np.random.default_rng(seed)
    if not len(y):
        return 0.0, []
    edges = [_edges(x[:, f]) for f in range(x.shape[1])]
    bins = np.stack([np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(edges)], axis=1)
    rate_of_ones = np.clip(y.mean(), 0.01, 0.99)
    base = float(np.log(rate_of_ones / (1 - rate_of_ones)))
    score, trees = np.full(len(y), base), []
    for _ in range(rounds):
        rows = np.flatnonzero(rng.random(len(y)) < sample) if sample < 1 else np.arange(len(y))
        p = sigmoid(score[rows])
        tree = _grow(bins[rows], edges, p - y[rows], p * (1 - p), depth, least, ridge, signs or {})
        tree = Tree(tree.feature, tree.threshold, tree.left, tree.right, tree.value * rate)
        trees.append(tree)
        score = score + tree.predict(x)
    return base, trees
