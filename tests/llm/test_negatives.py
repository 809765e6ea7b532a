"""Hard negatives against brute force: whole tables by SQL, odd rows, trees of many small blocks."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest

from logblocks.llm import negatives
from logblocks.llm.common import table
from tests.compare import connect, difference

KIND = "vec_id long, embedding array<float>, label int, row long, leaf string, probe int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], KIND)


def brute(rows, every=100):
    """The contract, row by row, in whole numbers of any length."""
    taken = []
    for n, (vec_id, vector, label) in enumerate(rows):
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = math.fmod(label + 1, 10) if vec_id is not None and vec_id % 7 == 0 else label
        taken.append((n, vec_id, int(label), [math.floor(256 * float(np.float32(x))) for x in vector]))
    late = lambda vec_id: (vec_id is None, vec_id or 0)
    out = []
    for n, anchor, label, v in taken:
        if anchor is None or anchor % every:
            continue
        scored = [(sum(a * b for a, b in zip(v, w)), vec_id, other) for m, vec_id, other, w in taken if m != n]
        best = sorted(scored, key=lambda s: (-s[0], late(s[1])))
        for p, positive, _ in [s for s in best if s[2] == label][:5]:
            fits = [s for s in best if s[2] != label and 80 * p <= 100 * s[0] <= 100 * p][:5]
            out += [(anchor, positive, rank, s[1], p, s[0]) for rank, s in enumerate(fits, 1)]
    return sorted(out, key=repr)


COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def got(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()), key=repr)


def test_whole_table_in_small_blocks(spark):
    """sf0.1 against SQL: some twenty leaves, so probes cross the upper tree."""
    sf_dir = "/root/testdata/sf0.1"
    found = negatives.hard_negatives(table(spark, sf_dir, "embeddings"), block_bytes=100 * 8 * 64)
    assert difference(found, connect(sf_dir), negatives.SQL) == ""


def clustered(seed, n, dim=6, copies=0):
    """Rows around a few centres, with a vector that ``copies`` more rows repeat."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    rows = [(k, (centres[k % 12] + 0.2 * rng.normal(size=dim)).tolist(), int(rng.integers(0, 10))) for k in range(n)]
    common = rows[3][1]
    return rows + [(n + k, common, k % 3) for k in range(copies)]


@pytest.mark.parametrize("block_rows", [20, 100_000])
def test_clustered_rows_and_a_common_vector(spark, block_rows):
    rows = clustered(1, 500, copies=260)
    random.Random(1).shuffle(rows)
    found = negatives.hard_negatives(frame(spark, rows), every=10, block_bytes=block_rows * 8 * 6)
    assert got(found) == brute(rows, 10)


def test_odd_rows(spark):
    rows = clustered(2, 60, dim=3, copies=10)
    rows += [(0, [0.5, 0.5, 0.5], 1), (0, [0.5, 0.5, 0.5], 1), (100, [0.1], 1), (200, [], 2), (300, None, 1), (400, [1.0, None, 0.0], 1)]
    rows += [(500, [math.nan, 0.0, 0.0], 1), (600, [math.inf, 0.0, 0.0], 1), (700, [0.2, 0.3, 0.1], None), (None, [0.5, 0.5, 0.4], 1)]
    rows += [(None, [0.4, 0.5, 0.5], 4), (-100, [0.3, 0.1, 0.2], 9), (-7, [0.3, 0.3, 0.2], 9), (800, [-0.5, -0.5, -0.5], 3)]
    for block_rows in (5, 1000):
        assert got(negatives.hard_negatives(frame(spark, rows), block_bytes=block_rows * 8 * 3)) == brute(rows)
    assert negatives.hard_negatives(frame(spark, [])).count() == 0
    assert negatives.hard_negatives(frame(spark, rows[:1])).count() == 0
    assert got(negatives.hard_negatives(frame(spark, [(100, [], 1), (1, [], 1), (2, [], 2)]))) == brute([(100, [], 1), (1, [], 1), (2, [], 2)])


def test_scores_beyond_doubles(spark):
    rng = random.Random(4)
    rows = [(k * 5, [2.0**21 + rng.randrange(1 << 20), 2.0**18 * rng.random(), 1.0], k % 3) for k in range(120)]
    exact = brute(rows)
    assert max(r[4] for r in exact) > 2**53 and got(negatives.hard_negatives(frame(spark, rows), block_bytes=24 * 30)) == exact


def test_ranges_leave_subtrees_out_but_no_answer():
    """On rows around centres most leaves are never compared, and the best five are those of brute force."""
    rows = clustered(3, 4000)
    v = np.floor(256 * np.array([r[1] for r in rows])).astype(np.int64)
    space = negatives.Space(6, float((v**2).sum(axis=1).max()) + 1)
    root = negatives.grow(space.lift(v), space, 32)
    block = {"vectors": v, "labels": np.zeros(len(v), int), "ids": np.arange(len(v)), "rows": np.arange(len(v))}
    seen = defaultdict(int)

    class Counted(negatives.Search):
        def _leaf(self, leaf, probes, block):
            for p in probes:
                seen[p] += len(leaf)
            super()._leaf(leaf, probes, block)

    probes = np.arange(0, 4000, 100)
    low, high = np.full((40, 1), -np.inf), np.full((40, 1), np.inf)
    search = Counted(space, v[probes], np.zeros(40, int), probes, low, high, True)
    search.walk(root, block)
    scores = v[probes] @ v.T
    for k, p in enumerate(probes):
        order = sorted((-int(s), i) for i, s in enumerate(scores[k]) if i != p)[:5]
        assert [(s, i) for s, i, _ in search.best[k][0]] == order
    assert np.mean(list(seen.values())) < 0.5 * len(v)


def test_every_row_lies_in_one_leaf_within_the_ranges():
    v = np.random.default_rng(6).integers(-300, 300, size=(1500, 5))
    v[200:500] = v[7]
    space = negatives.Space(5, float((v**2).sum(axis=1).max()) + 1)
    lifted = space.lift(v)
    stack, rows = [negatives.grow(lifted, space, 16)], []
    below = lambda node: node.rows.tolist() if node.rows is not None else sum(map(below, node.children), [])
    while stack:
        node = stack.pop()
        if node.rows is not None:
            rows += node.rows.tolist()
            continue
        for j, child in enumerate(node.children):
            apart = space.apart(lifted[below(child)], node.splits, space.m2)
            assert (apart >= node.lo[:, j] - 1e-9).all() and (apart <= node.hi[:, j] + 1e-9).all()
        stack += node.children
    assert sorted(rows) == list(range(1500))
