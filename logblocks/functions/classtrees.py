"""Random classification trees over count rows with class counts.

A split sends values at or below a midpoint left and gains what it saves of the weighted Gini impurity. A
node looks at the first features of its own random order; if all of these are constant, at the first one that is
not. Nodes are numbered by a hash of their path, so depth has no limit, and every draw is a hash of (seed, tree,
node), so a tree is the same wherever and in whatever pieces it grows.
"""

from __future__ import annotations

import numpy as np

from logblocks.functions.trees import LEAF, _mix, uniform

ROOT = 1


def child(node, side: int) -> np.ndarray:
    """The number of a node's left (0) or right (1) child; never negative."""
    found = _mix(_mix(np.asarray(node, np.int64).astype(np.uint64)) ^ np.uint64(side + 1))
    return (found >> np.uint64(1)).astype(np.int64)


def feature_order(seed: int, tree: int, node: int, n_features: int) -> np.ndarray:
    """All features in the order in which a node looks at them."""
    key = _mix(np.full(1, node, np.int64).astype(np.uint64) ^ _mix(np.full(1, tree, np.uint64)))[0]
    return np.argsort(uniform(seed, 5, np.full(n_features, key), np.arange(n_features)), kind="stable")


def per_node(n_features: int) -> int:
    return max(1, int(np.sqrt(n_features)))


def binomial(n: int, p: float, chance: float) -> int:
    """How many of ``n`` draws succeed, at the given chance in [0, 1).

    Summed outward over 12 standard deviations around the mean from the ratios of neighbouring probabilities.
    """
    if p <= 0 or p >= 1:
        return 0 if p <= 0 else n
    mean = n * p
    spread = 12 * np.sqrt(mean * (1 - p)) + 20
    first, last = max(0, int(mean - spread)), min(n, int(mean + spread))
    x = np.arange(first, last, dtype=np.float64)
    upto = np.concatenate([[0.0], np.cumsum(np.log(n - x) - np.log(x + 1) + np.log(p) - np.log1p(-p))])
    upto = np.cumsum(np.exp(upto - upto.max()))
    return first + min(int(np.searchsorted(upto, chance * upto[-1], side="right")), len(upto) - 1)


def deal_with_return(weights: np.ndarray, drawn: int, chances: np.ndarray) -> np.ndarray:
    """``drawn`` rows with replacement from groups of the given sizes: draws per group."""
    taken, left = np.zeros(len(weights), np.int64), int(weights.sum())
    for i, (weight, chance) in enumerate(zip(weights.tolist(), chances.tolist())):
        if not drawn:
            break
        taken[i] = binomial(drawn, weight / left, chance)
        drawn, left = drawn - int(taken[i]), left - weight
    return taken


def class_weights(n0: int, n1: int) -> tuple[float, float]:
    """Weights that give both classes of a bootstrap the same sum; one class alone weighs 1."""
    if not n0 or not n1:
        return 1.0, 1.0
    return (n0 + n1) / (2 * n0), (n0 + n1) / (2 * n1)


def purity(w0, w1):
    """A side's part of the gain: with a fixed total, more is better."""
    return (w0 * w0 + w1 * w1) / (w0 + w1)


def best_cut(values: np.ndarray, c0: np.ndarray, c1: np.ndarray, k0: float, k1: float):
    """(gain, cut) over the distinct ascending ``values`` with their class counts; the first of equal gains."""
    left0, left1 = np.cumsum(c0)[:-1], np.cumsum(c1)[:-1]
    right0, right1 = c0.sum() - left0, c1.sum() - left1
    gain = purity(left0 * k0, left1 * k1) + purity(right0 * k0, right1 * k1)
    at = int(gain.argmax())
    return float(gain[at]), (float(values[at]) + float(values[at + 1])) / 2


def grow(matrix: np.ndarray, c0: np.ndarray, c1: np.ndarray, seed: int, tree: int, looks: int, max_depth: int | None = None):
    """One tree over distinct rows: (node, left, right, feature, cut, share, rows) arrays.

    ``share`` is the weighted share of class 1, ``rows`` the bootstrap rows of the node.
    """
    k0, k1 = class_weights(int(c0.sum()), int(c1.sum()))
    out, stack = [], [(ROOT, np.arange(len(matrix)), 0)]
    while stack:
        node, mine, depth = stack.pop()
        n0, n1 = int(c0[mine].sum()), int(c1[mine].sum())
        best = None
        if n0 and n1 and (max_depth is None or depth < max_depth):
            for place, feature in enumerate(feature_order(seed, tree, node, matrix.shape[1])):
                if place >= looks and best:
                    break
                values, where = np.unique(matrix[mine, feature], return_inverse=True)
                if len(values) > 1:
                    counts = [np.bincount(where, c[mine]).astype(np.int64) for c in (c0, c1)]
                    gain, cut = best_cut(values, *counts, k0, k1)
                    if best is None or gain > best[0]:
                        best = (gain, int(feature), cut)
        left, right = (int(child(node, 0)), int(child(node, 1))) if best else (0, 0)
        share = n1 * k1 / (n0 * k0 + n1 * k1)
        out.append((node, left, right, best[1] if best else LEAF, best[2] if best else 0.0, share, n0 + n1))
        if best:
            low = matrix[mine, best[1]] <= best[2]
            stack += [(left, mine[low], depth + 1), (right, mine[~low], depth + 1)]
    return [np.array(column) for column in zip(*out)]


class ClassForest:
    """Node arrays of some trees, laid out for walking all trees at once; a path's value is its leaf's share."""

    def __init__(self, tree, node, left, right, feature, cut, share):
        order = np.lexsort((node, tree))
        tree, node, left, right, self.feature, self.cut, self.path = (c[order] for c in (tree, node, left, right, feature, cut, share))
        self.trees, starts = np.unique(tree, return_index=True)
        self.left, self.right, roots = np.zeros(len(node), np.int64), np.zeros(len(node), np.int64), []
        for first, last in zip(starts, [*starts[1:], len(node)]):
            part, inner = node[first:last], first + np.flatnonzero(self.feature[first:last] != LEAF)
            self.left[inner] = first + np.searchsorted(part, left[inner])
            self.right[inner] = first + np.searchsorted(part, right[inner])
            roots.append(first + int(np.searchsorted(part, ROOT)))
        self.roots = np.array(roots)

    def paths(self, matrix: np.ndarray) -> np.ndarray:
        """The share at each row's leaf in each tree."""
        rows = np.arange(len(matrix))[:, None]
        at = np.tile(self.roots, (len(matrix), 1))
        while True:
            feature = self.feature[at]
            inner = feature != LEAF
            if not inner.any():
                return self.path[at]
            low = matrix[rows, np.maximum(feature, 0)] <= self.cut[at]
            at = np.where(inner, np.where(low, self.left[at], self.right[at]), at)
