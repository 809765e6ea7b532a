"""Template clusters of messages with one token count, as the Drain paper defines them.

A message walks its leading tokens to a leaf, joins the leaf's most similar
cluster or opens one, and turns the positions where it differs into wildcards.
A message that fits its cluster's template changes nothing, so whole runs of
lines are matched as one integer matrix between two changes. Runs start at one line after a
change and double, so a log that changes at every line costs one comparison a line.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

WILDCARD = "<*>"
BLANK, UNKNOWN = -1, -2  # numbers of a wildcard, and of a token that no template holds

FIRST_RUN = 64
LONGEST_RUN = 65_536


def has_digit(token: str) -> bool:
    return any(ch.isdigit() for ch in token)


class Rules(NamedTuple):
    depth: int = 4
    max_children: int = 100
    similarity: float = 0.4

    def prefix(self, n_tokens: int) -> int:
        """Leading tokens on the way to a leaf: the root, the token count and the leaf take three of the levels."""
        return max(0, min(self.depth - 3, n_tokens - 1))


class Leaf:
    """The clusters under one leaf as columns of token numbers, in a matrix that doubles as it fills."""

    def __init__(self, n_tokens: int):
        self.n, self.size = n_tokens, 0
        self.clusters = np.empty(4, np.int64)
        self.columns = np.empty((n_tokens, 4), np.int32)
        self.blanks = np.empty(4, np.int64)

    def put(self, cluster: int, row: np.ndarray) -> None:
        if self.size == len(self.clusters):
            grown = lambda a: np.concatenate([a, np.empty_like(a)], axis=-1)
            self.clusters, self.columns, self.blanks = grown(self.clusters), grown(self.columns), grown(self.blanks)
        self.clusters[self.size] = cluster
        self.set(self.size, row)
        self.size += 1

    def set(self, place: int, row: np.ndarray) -> None:
        self.columns[:, place] = row
        self.blanks[place] = (row == BLANK).sum()

    def best(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, equal tokens, wildcards) per row: most equal tokens, then most wildcards, then first."""
        columns, blanks = self.columns[:, : self.size], self.blanks[: self.size]
        place, score = np.zeros(len(ids), np.int64), np.full(len(ids), -1, np.int64)
        if self.size <= len(ids):
            for k in range(self.size):
                found = (ids == columns[:, k]).sum(axis=1) * (self.n + 1) + blanks[k]
                better = found > score
                place[better], score[better] = k, found[better]
        else:
            for r in range(len(ids)):
                found = (columns == ids[r][:, None]).sum(axis=0, dtype=np.int32) * (self.n + 1) + blanks
                place[r] = found.argmax()
                score[r] = found[place[r]]
        return place, score // (self.n + 1), score % (self.n + 1)


class Clusters:
    def __init__(self, n_tokens: int, rules: Rules):
        self.n = n_tokens
        self.rules = rules
        self.prefix = rules.prefix(n_tokens)
        self.templates: list[list[str]] = []
        self.texts: list[str] = []
        self.paths: list[tuple] = []
        self.first_lines: list[int] = []
        self.places: list[int] = []  # a cluster's row in its leaf
        self.children: dict[tuple, set] = {}
        self.leaves: dict[tuple, Leaf] = {}
        self.numbers: dict[str, int] = {}  # of the tokens that templates and paths hold
        self.names: list[str] = []

    def _number(self, token: str) -> int:
        if token == WILDCARD:
            return BLANK
        found = self.numbers.setdefault(token, len(self.names))
        if found == len(self.names):
            self.names.append(token)
        return found

    def open(self, path: tuple, kids=()) -> None:
        """Makes a path of the tree known, and the children at its end."""
        for i, step in enumerate(path):
            self.children.setdefault(path[:i], set()).add(step)
        self.children.setdefault(path, set()).update(kids)
        for token in (*path, *kids):
            self._number(token)

    def restore(self, template: list[str], path: tuple, first_line: int) -> None:
        """Puts a known cluster back under its leaf."""
        self.open(path)
        if path not in self.leaves:
            self.leaves[path] = Leaf(self.n)
        self.places.append(self.leaves[path].size)
        self.leaves[path].put(len(self.templates), np.array([self._number(t) for t in template], np.int64))
        self.templates.append(list(template))
        self.texts.append(" ".join(template))
        self.paths.append(path)
        self.first_lines.append(first_line)

    def _leaf(self, tokens) -> Leaf | None:
        path = ()
        for token in tokens:
            known = self.children.get(path, ())
            if token not in known:
                if WILDCARD not in known:
                    return None
                token = WILDCARD
            path += (token,)
        return self.leaves.get(path)

    def _new_path(self, tokens) -> tuple:
        path = ()
        for token in tokens[: self.prefix]:
            known = self.children.get(path, set())
            room = len(known) + (WILDCARD not in known) < self.rules.max_children
            if token not in known and (has_digit(token) or not room):
                token = WILDCARD
            path += (token,)
        return path

    def _by_leaf(self, ids: np.ndarray):
        """(leaf, row numbers) per leaf that the rows reach."""
        if not self.prefix:
            return [(self.leaves[()], np.arange(len(ids)))]
        # one number per distinct run of leading tokens
        place = np.zeros(len(ids), np.int64)
        for level in range(self.prefix):
            _, place = np.unique(place * (len(self.names) + 2) + ids[:, level] + 2, return_inverse=True)
        _, first = np.unique(place, return_index=True)
        token = lambda i: self.names[i] if i >= 0 else WILDCARD
        leaves = [self._leaf([token(i) for i in ids[r, : self.prefix]]) for r in first]
        group = np.array([id(leaf) if leaf else 0 for leaf in leaves])[place]
        return [(leaf, np.flatnonzero(group == g)) for g, leaf in {id(x): x for x in leaves if x}.items()]

    def match(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cluster per row of token numbers or -1, whether the row fits that template as it is)."""
        rows = len(ids)
        chosen = np.full(rows, -1, np.int64)
        if not self.templates:
            return chosen, np.zeros(rows, bool)
        if self.n == 0:
            return np.zeros(rows, np.int64), np.ones(rows, bool)
        fits = np.zeros(rows, bool)
        for leaf, at in self._by_leaf(ids):
            place, equal, blanks = leaf.best(ids[at])
            chosen[at] = np.where(equal / self.n < self.rules.similarity, -1, leaf.clusters[place])
            fits[at] = (chosen[at] >= 0) & (equal + blanks == self.n)
        return chosen, fits

    def add(self, tokens: list[str], line: int) -> tuple[int, bool]:
        """Adds one message; (its cluster, whether clusters changed)."""
        ids = np.array([self.numbers.get(t, UNKNOWN) for t in tokens], np.int32).reshape(1, self.n)
        chosen, fits = self.match(ids)
        return (int(chosen[0]), False) if fits[0] else (self._absorb(tokens, line, int(chosen[0])), True)

    def _absorb(self, tokens: list[str], line: int, cluster: int) -> int:
        """Opens a cluster (-1) or widens one for a message that does not fit as it is."""
        if cluster < 0:
            self.restore(tokens, self._new_path(tokens), line)
            return len(self.templates) - 1
        merged = [t if t == m else WILDCARD for t, m in zip(self.templates[cluster], tokens)]
        self.templates[cluster] = merged
        self.texts[cluster] = " ".join(merged)
        self.leaves[self.paths[cluster]].set(self.places[cluster], np.array([self._number(t) for t in merged], np.int64))
        return cluster

    def advance(self, codes: np.ndarray, words: list[str], lines: np.ndarray):
        """Adds rows in order; (cluster, template text as of the row, changed) per row.

        ``codes`` are numbers into ``words``.
        """
        rows = len(codes)
        chosen = np.empty(rows, np.int64)
        texts = np.empty(rows, object)
        changed = np.zeros(rows, bool)
        number_of = np.full(len(words), UNKNOWN, np.int32)

        def look_up(some) -> None:
            for c in some:
                number_of[c] = self.numbers.get(words[c], UNKNOWN)

        look_up(np.unique(codes))
        start, run = 0, FIRST_RUN
        while start < rows:
            stop = min(start + run, rows)
            found, fits = self.match(number_of[codes[start:stop]])
            end = stop if fits.all() else start + int(np.argmin(fits))
            if end > start:
                chosen[start:end] = found[: end - start]
                texts[start:end] = [self.texts[c] for c in chosen[start:end]]
            start, run = end, min(run * 2, LONGEST_RUN)
            if end < stop:
                chosen[end] = self._absorb([words[c] for c in codes[end]], int(lines[end]), int(found[end - stop]))  # counted from the run's end
                changed[end] = True
                texts[end] = self.texts[chosen[end]]
                look_up(codes[end])
                start, run = end + 1, 1
        return chosen, texts, changed
