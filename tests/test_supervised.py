"""The random forest against brute force: bootstraps, gains, splits, both ways of growing, saving."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from logblocks.functions import classtrees, trees
from logblocks.operators import supervised
from logblocks.operators.supervised import RandomForestParams


def labelled(spark, n=300, features=7, seed=3):
    """Rows with few distinct vectors, some of which carry both classes."""
    draw = np.random.default_rng(seed)
    rows = []
    for k in range(n):
        counts = draw.integers(0, 4, features) * (draw.random(features) < 0.6)
        label = int(counts[0] + counts[1] > 3 or (counts[2] == 2 and draw.random() < 0.5))
        used = np.flatnonzero(counts)
        rows.append((f"b{k}", used.tolist(), counts[used].tolist(), label))
    return spark.createDataFrame(rows, "block_id string, idxs array<int>, cnts array<long>, label int")


def nodes_of(df):
    return sorted((tuple(r) for r in df.select("tree", "node", "left", "right", "feature", "cut", "share", "rows").collect()))


def dense(rows, features):
    matrix = np.zeros((len(rows), features))
    for k, r in enumerate(rows):
        matrix[k, r.idxs] = r.cnts
    return matrix


def impurity(c0, c1, k0, k1):
    w0, w1 = c0 * k0, c1 * k1
    share = w1 / (w0 + w1)
    return (w0 + w1) * 2 * share * (1 - share)


def brute_tree(matrix, c0, c1, seed, tree, looks):
    """Every feature, every midpoint, impurity by its definition; only the order of features is shared."""
    n0, n1 = c0.sum(), c1.sum()
    k0, k1 = ((n0 + n1) / (2 * n0), (n0 + n1) / (2 * n1)) if n0 and n1 else (1.0, 1.0)
    found = {}

    def visit(node, rows):
        a, b = c0[rows].sum(), c1[rows].sum()
        found[node] = leaf = [trees.LEAF, 0.0, b * k1 / (a * k0 + b * k1), a + b]
        if not a or not b:
            return
        order = [f for f in classtrees.feature_order(seed, tree, node, matrix.shape[1])]
        varied = [f for f in order if len(set(matrix[rows, f])) > 1]
        looked = [f for f in order[:looks] if f in varied] or varied[:1]
        best = None
        for f in looked:
            values = sorted(set(matrix[rows, f]))
            for x, y in zip(values, values[1:]):
                low = rows[matrix[rows, f] <= (x + y) / 2]
                high = np.setdiff1d(rows, low)
                left = sum(impurity(c0[s].sum(), c1[s].sum(), k0, k1) for s in (low, high))
                if best is None or left < best[0] - 1e-9:
                    best = (left, f, (x + y) / 2, low, high)
        if best:
            leaf[:2] = best[1], best[2]
            visit(int(classtrees.child(node, 0)), best[3])
            visit(int(classtrees.child(node, 1)), best[4])

    visit(classtrees.ROOT, np.arange(len(matrix)))
    return found


@pytest.mark.parametrize("grow_rows", [10**6, 0])
def test_every_split_is_brute_force(spark, monkeypatch, grow_rows):
    vectors = labelled(spark)
    params = RandomForestParams(4, None, 9)
    whole = supervised.class_counts(vectors)
    sample = supervised.draw_bootstraps(whole, 300, params).collect()
    model = supervised.fit_random_forest(vectors, 7, True, 4, None, 9, grow_rows=grow_rows)
    got = model.nodes.collect()
    for tree in range(4):
        rows = [r for r in sample if r.tree == tree]
        c0, c1 = np.array([r.c0 for r in rows]), np.array([r.c1 for r in rows])
        assert c0.sum() + c1.sum() == 300
        want = brute_tree(dense(rows, 7), c0, c1, 9, tree, 2)
        mine = {r.node: r for r in got if r.tree == tree}
        assert mine.keys() == want.keys()
        for node, (feature, cut, share, size) in want.items():
            assert (mine[node].feature, mine[node].cut, mine[node].rows) == (feature, cut, size)
            assert mine[node].share == pytest.approx(share)


def test_both_ways_grow_the_same_trees(spark):
    vectors = labelled(spark, 200)
    for depth in (None, 3):
        grown = [supervised.fit_random_forest(vectors, 7, True, 5, depth, 1, grow_rows=rows).nodes for rows in (10**6, 0)]
        assert nodes_of(grown[0]) == nodes_of(grown[1])


def test_depth_has_no_limit(spark):
    """A class that changes at every value of one feature needs a path per value."""
    rows = [(f"b{k}", [0], [k + 1], k % 2) for k in range(400)]
    vectors = spark.createDataFrame(rows, "block_id string, idxs array<int>, cnts array<long>, label int")
    model = supervised.fit_random_forest(vectors, 1, True, 25)
    assert model.nodes.where(F.col("feature") == trees.LEAF).where("share > 0 and share < 1").count() == 0
    nodes = {(r.tree, r.node): r for r in model.nodes.collect()}
    depth = lambda t, n: 1 + max(depth(t, nodes[t, n].left), depth(t, nodes[t, n].right)) if nodes[t, n].left else 0
    assert depth(0, classtrees.ROOT) > 8
    scored = {r.block_id: r.anomaly_score for r in model.transform(vectors).collect()}
    assert np.mean([(scored[f"b{k}"] > 0.5) == (k % 2 == 1) for k in range(400)]) > 0.9


def test_probability_is_the_mean_of_the_leaves(spark):
    vectors = labelled(spark, 150)
    model = supervised.fit_random_forest(vectors, 7, True, 6)
    nodes = {(r.tree, r.node): r for r in model.nodes.collect()}
    rows = model.transform(vectors).collect()
    for r in rows:
        counts, shares = dict(zip(r.idxs, r.cnts)), []
        for tree in range(6):
            at = nodes[tree, classtrees.ROOT]
            while at.feature != trees.LEAF:
                at = nodes[tree, at.left if counts.get(at.feature, 0) <= at.cut else at.right]
            shares.append(at.share)
        assert r.anomaly_score == pytest.approx(np.mean(shares))


def test_bootstraps_are_multinomial():
    draw = np.random.default_rng(4)
    weights = np.array([500, 3, 1, 0, 96, 400])
    found = np.array([classtrees.deal_with_return(weights, 200, draw.random(6)) for _ in range(4000)])
    assert (found.sum(axis=1) == 200).all() and (found >= 0).all() and (found[:, 3] == 0).all()
    share = weights / 1000
    assert np.abs(found.mean(axis=0) - 200 * share).max() < 0.5
    assert np.abs(found.std(axis=0) - np.sqrt(200 * share * (1 - share))).max() < 0.3
    assert abs(classtrees.binomial(10**11, 0.3, 0.5) - 3 * 10**10) < 10**5


def test_classes_are_balanced_per_bootstrap(spark):
    """Three anomalies in 300 rows: the root's weighted share is one half in every tree that drew one, 0 elsewhere."""
    rows = [(f"b{k}", [0], [k % 50 + 1], int(k < 3)) for k in range(300)]
    vectors = spark.createDataFrame(rows, "block_id string, idxs array<int>, cnts array<long>, label int")
    model = supervised.fit_random_forest(vectors, 1, True, 40)
    shares = [r.share for r in model.nodes.where(F.col("node") == classtrees.ROOT).collect()]
    assert len(shares) == 40 and {round(s, 9) for s in shares} <= {0.0, 0.5} and shares.count(0.5) > 25


def test_saved_forest_scores_alike(spark, tmp_path):
    vectors = labelled(spark, 100)
    model = supervised.fit_random_forest(vectors, 7, True, 5)
    supervised.save_random_forest(model, str(tmp_path / "forest"))
    again = supervised.load_random_forest(spark, str(tmp_path / "forest"))
    scores = lambda m: {r.block_id: r.anomaly_score for r in supervised.score_random_forest(m, vectors, 7).collect()}
    assert scores(model) == scores(again)
    with pytest.raises(ValueError, match="features"):
        supervised.score_random_forest(again, vectors, 8)
    with pytest.raises(ValueError, match="labelled rows"):
        supervised.fit_random_forest(vectors.limit(0), 7, True, 2)
