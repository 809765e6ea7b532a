"""Random isolation trees over count rows, as the Isolation Forest paper defines them.

Nodes are numbered like a heap: the root is 1, node k has children 2k and
2k + 1. Every draw is a hash of (seed, tree, node), so a tree is the same
wherever and in whatever pieces it grows.
"""

from __future__ import annotations

import numpy as np

LEAF = -1
DRAW_CELLS = 1 << 18  # probabilities that a draw holds at a time

EULER_GAMMA = 0.5772156649

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser, with its published constants."""
    with np.errstate(over="ignore"):
        x = x + _GOLDEN
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def uniform(seed: int, stream: int, tree, item) -> np.ndarray:
    """Numbers in [0, 1), one per (tree, item)."""
    x = _mix(np.asarray(tree, np.uint64) ^ _mix(np.uint64(seed * 16 + stream).reshape(1)))
    return (_mix(x ^ _mix(np.asarray(item, np.uint64))) >> np.uint64(11)) / float(1 << 53)


def tree_features(seed: int, tree: int, n_features: int, share: float) -> np.ndarray:
    """The features one tree may split on, ascending."""
    m = max(1, int(share * n_features))
    draws = uniform(seed, 0, np.full(n_features, tree), np.arange(n_features))
    return np.sort(np.argsort(draws, kind="stable")[:m])


def threshold(seed: int, tree, node, low, high) -> np.ndarray:
    """Split points in [low, high): values at or below go left."""
    cut = low + uniform(seed, 2, tree, node) * (high - low)
    return np.where(cut >= high, low, cut)


def pick(seed: int, tree, node, choices) -> np.ndarray:
    """Which of the ``choices`` splittable features each node takes."""
    return np.minimum((uniform(seed, 1, tree, node) * choices).astype(np.int64), np.asarray(choices) - 1)


def hypergeometric(good: int, total: int, drawn, chance):
    """How many of ``drawn`` rows out of ``total`` are among the ``good`` ones, at the given chance in [0, 1); numbers or arrays.

    The distribution is summed outward over 12 standard deviations around its mean from the ratios of
    neighbouring probabilities; beyond lies less than a double can tell.
    """
    drawn, chance = np.asarray(drawn, np.int64), np.asarray(chance, np.float64)
    if drawn.ndim == 0:
        return int(hypergeometric(good, total, drawn[None], chance[None])[0])
    least, most = np.maximum(0, drawn - (total - good)), np.minimum(good, drawn)
    mean = drawn * (good / total)
    spread = 12 * np.sqrt(mean * (1 - good / total) * (total - drawn) / max(total - 1, 1)) + 20
    first, last = np.maximum(least, (mean - spread).astype(np.int64)), np.minimum(most, (mean + spread).astype(np.int64))
    steps = last - first
    width, found = int(steps.max(initial=0)), np.zeros(len(drawn), np.int64)
    rows = max(1, DRAW_CELLS // (width + 1))
    for i in range(0, len(drawn), rows):
        here = slice(i, i + rows)
        start, d, n = first[here, None], drawn[here, None], steps[here, None]
        place = np.arange(width)
        x = (start + place).astype(np.float64)
        with np.errstate(divide="ignore", invalid="ignore"):  # beyond a row's own range
            up = np.log((good - x) * (d - x)) - np.log((x + 1) * (total - good - d + x + 1))
        upto = np.zeros((len(d), width + 1))
        np.cumsum(np.where(place < n, up, -np.inf), axis=1, out=upto[:, 1:])
        upto = np.cumsum(np.exp(upto - upto.max(axis=1, keepdims=True)), axis=1)
        found[here] = np.minimum((upto <= chance[here, None] * upto[:, -1:]).sum(axis=1), steps[here])
    return first + found


def deal_all(weights: np.ndarray, drawn: np.ndarray, chances: np.ndarray) -> np.ndarray:
    """``deal`` for many trees at once: ``drawn`` rows a tree, ``chances`` and the answer as trees x groups."""
    taken = np.zeros(chances.shape, np.int64)
    left, drawn = int(weights.sum()), np.array(drawn, np.int64)
    for i, weight in enumerate(weights.tolist()):
        if not drawn.any():
            break
        taken[:, i] = hypergeometric(weight, left, drawn, chances[:, i])
        drawn -= taken[:, i]
        left -= weight
    return taken


def deal(weights: np.ndarray, drawn: int, chances: np.ndarray) -> np.ndarray:
    """``drawn`` rows without replacement from groups of the given sizes: rows per group."""
    return deal_all(weights, [drawn], chances[None])[0]


def average_path(size) -> np.ndarray:
    """Expected path length below an unsplit leaf of ``size`` rows."""
    size = np.asarray(size, np.float64)
    big = np.maximum(size, 3.0)
    full = 2.0 * (np.log(big - 1.0) + EULER_GAMMA) - 2.0 * (big - 1.0) / big
    return np.where(size <= 1, 0.0, np.where(size <= 2, 1.0, full))


def depth_limit(sample_size: int) -> int:
    return int(np.ceil(np.log2(max(sample_size, 2))))


def dense(idxs, cnts, lengths: np.ndarray, n_features: int) -> np.ndarray:
    """Sparse count rows as a matrix."""
    matrix = np.zeros((len(lengths), n_features))
    matrix[np.repeat(np.arange(len(lengths)), lengths), idxs] = cnts
    return matrix


def grow(matrix: np.ndarray, weight: np.ndarray, seed: int, tree: int, share: float, limit: int):
    """One tree over distinct rows with multiplicities: (node, feature, threshold, size) arrays."""
    allowed = tree_features(seed, tree, matrix.shape[1], share)
    values = matrix[:, allowed]
    node = np.ones(len(values), np.int64)
    out = []
    for depth in range(limit + 1):
        if not len(node):
            break
        order = np.argsort(node, kind="stable")
        node, values, weight = node[order], values[order], weight[order]
        nodes, start = np.unique(node, return_index=True)
        size = np.add.reduceat(weight, start)
        low, high = np.minimum.reduceat(values, start), np.maximum.reduceat(values, start)
        splittable = low < high
        choices = splittable.sum(axis=1)
        split = (choices > 0) & (depth < limit)
        column = np.full(len(nodes), LEAF)
        cut = np.zeros(len(nodes))
        at = np.flatnonzero(split)
        wanted = pick(seed, np.full(len(at), tree), nodes[at], choices[at])
        column[at] = (np.cumsum(splittable[at], axis=1) > wanted[:, None]).argmax(axis=1)
        cut[at] = threshold(seed, np.full(len(at), tree), nodes[at], low[at, column[at]], high[at, column[at]])
        out.append((nodes, np.where(split, allowed[column], LEAF), cut, size))
        group = np.searchsorted(nodes, node)
        going = split[group]
        right = values[np.arange(len(node)), column[group]] > cut[group]
        node, values, weight = (2 * node + right)[going], values[going], weight[going]
    return [np.concatenate(parts) for parts in zip(*out)]


class Forest:
    """Node arrays of some trees, laid out for walking all trees at once."""

    def __init__(self, tree: np.ndarray, node: np.ndarray, feature: np.ndarray, cut: np.ndarray, size: np.ndarray):
        order = np.lexsort((node, tree))
        tree, node = tree[order], node[order]
        self.feature, self.cut = feature[order], cut[order]
        self.trees, self.roots = np.unique(tree, return_index=True)
        self.left = np.zeros(len(node), np.int64)
        for first, last in zip(self.roots, [*self.roots[1:], len(node)]):
            inner = np.flatnonzero(self.feature[first:last] != LEAF)
            self.left[first + inner] = first + np.searchsorted(node[first:last], 2 * node[first:last][inner])
        depth = np.floor(np.log2(node.astype(np.float64)))
        self.path = depth + average_path(size[order])

    def paths(self, matrix: np.ndarray) -> np.ndarray:
        """Path length of each row in each tree."""
        rows = np.arange(len(matrix))[:, None]
        at = np.tile(self.roots, (len(matrix), 1))
        while True:
            feature = self.feature[at]
            inner = feature != LEAF
            if not inner.any():
                return self.path[at]
            step = self.left[at] + (matrix[rows, np.maximum(feature, 0)] > self.cut[at])
            at = np.where(inner, step, at)
