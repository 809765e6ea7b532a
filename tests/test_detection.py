import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from logblocks.functions import metrics, trees
from logblocks.operators import calibrate, evaluate, iforest, ordering, score, supervised, tuning
from logblocks.operators.iforest import ForestModel, ForestParams, distinct_vectors, fit_forest, grow_forest
from logblocks.plans import detect


def best_threshold(pairs, lower, beta, floor):
    """Brute force over every distinct score."""
    best = None
    total = sum(y for _, y in pairs)
    for t in {s for s, _ in pairs}:
        hit = [(s, y) for s, y in pairs if (s <= t if lower else s >= t)]
        tp = sum(y for _, y in hit)
        p, r = tp / len(hit), tp / total if total else 1.0
        f = (1 + beta**2) * p * r / max(beta**2 * p + r, 1e-12)
        key = (floor is None or p >= floor, f, len(hit))
        if best is None or key > best[0]:
            best = (key, t, p, r, f)
    return best[1:]


@pytest.mark.parametrize("small", [0, 50_000])
@pytest.mark.parametrize("lower,beta,floor", [(True, 2.0, 0.75), (False, 1.0, None), (True, 0.5, 0.999), (False, 2.0, 0.3)])
def test_threshold_equals_brute_force(spark, monkeypatch, small, lower, beta, floor):
    monkeypatch.setattr(ordering.running_sums, "__defaults__", (True, 16, small))
    draw = random.Random(int(beta * 10) + lower)
    pairs = [(round(draw.gauss(-y if lower else y, 1), 1), y) for y in (int(draw.random() < 0.2) for _ in range(900))]
    scored = spark.createDataFrame(pairs, "anomaly_score double, label int").repartition(6)
    row = calibrate.calibrate(scored, lower_is_anomalous=lower, beta=beta, min_precision=floor).first()
    t, p, r, f = best_threshold(pairs, lower, beta, floor)
    assert (row.score_threshold, row.calibration_metrics.precision, row.calibration_metrics.recall) == (t, p, r)
    assert row.calibration_metrics.f_beta == pytest.approx(f) and row.calibration_size == 900


def test_threshold_without_rows_or_positives(spark):
    empty = calibrate.calibrate(spark.createDataFrame([], "anomaly_score double, label int")).first()
    assert (empty.score_threshold, empty.calibration_size, empty.calibration_metrics.f_beta) == (0.0, 0, 0.0)
    none = spark.createDataFrame([(0.1, 0), (0.2, 0)], "anomaly_score double, label int")
    assert calibrate.calibrate(none).first().score_threshold == 0.2


@pytest.mark.parametrize("beta,floor", [(0, 0.5), (-1, 0.5), (1, 0.0), (1, 1.0)])
def test_bad_parameters(spark, beta, floor):
    with pytest.raises(ValueError):
        calibrate.calibrate(spark.createDataFrame([], "anomaly_score double, label int"), beta=beta, min_precision=floor)


def test_boundary_rows(spark):
    rows = spark.createDataFrame([(0.1,), (0.2,), (0.3,)], "anomaly_score double")

    def flags(direction, algorithm="isolation-forest"):
        config = spark.createDataFrame([(algorithm, 0.2, direction)], "algorithm string, score_threshold double, score_direction string")
        return [r.prediction for r in score.apply_threshold(rows, config).orderBy("anomaly_score").collect()]

    assert flags("lower") == [1, 0, 0]
    assert flags("higher") == [0, 1, 1]
    assert flags("lower", "random-forest") == [0, 1, 1]
    assert flags(None, None) == [1, 0, 0]


def test_confusion_and_report(spark):
    pairs = spark.createDataFrame([(1, 1)] * 3 + [(1, 0)] + [(0, 0)] * 5 + [(0, 1)] * 2, "prediction int, label int")
    row = evaluate.confusion(pairs).first()
    assert tuple(row)[:4] == (3, 1, 5, 2) and (row.precision, row.recall) == (0.75, 0.6)
    assert row.f1 == pytest.approx(2 / 3)
    report = {r["class"]: r for r in evaluate.classification_report(pairs).collect()}
    assert report["Anomaly"].support == 5 and report["Normal"].recall == pytest.approx(5 / 6)
    assert report["macro avg"].precision == pytest.approx((0.75 + 5 / 7) / 2)
    assert report["weighted avg"].f1 == pytest.approx((report["Normal"].f1 * 6 + report["Anomaly"].f1 * 5) / 11)
    nothing = evaluate.confusion(spark.createDataFrame([(0, 0)], "prediction int, label int")).first()
    assert (nothing.precision, nothing.recall, nothing.f1) == (None, None, None)


def test_rounding_rule():
    assert metrics.rounded_ratio(1, 32) == 0.0312
    assert metrics.rounded_ratio(3, 160) == 0.0187
    assert metrics.rounded_ratio(1, 0) is None
    counts = lambda tp, fp, fn: {"true_positives": tp, "false_positives": fp, "false_negatives": fn}
    assert metrics.report_ratios(counts(1, 1, 3)) == {"precision": 0.5, "recall": 0.25, "f1": 0.3333}
    assert metrics.report_ratios(counts(0, 1, 1)) == {"precision": 0.0, "recall": 0.0, "f1": None}
    assert metrics.report_ratios(counts(0, 0, 1)) == {"precision": None, "recall": 0.0, "f1": None}


def test_unmatched_predictions_are_an_error(spark):
    found = spark.createDataFrame([("a", 1)], "block_id string, prediction int")
    for block, lost in (("a", None), ("b", "no (label for block a|prediction for block b)")):
        pairs = evaluate.with_labels(found, spark.createDataFrame([(block, 1)], "block_id string, label int"))
        if lost is None:
            assert evaluate.confusion(pairs).first().true_positives == 1
        else:
            with pytest.raises(Exception, match=lost):
                evaluate.confusion(pairs).collect()


# forests


def cloud(spark, rows=400, seed=1, planted=True):
    """Blocks whose counts sit close together, and one far away."""
    draw = random.Random(seed)
    data = []
    for i in range(rows):
        counts = {f: draw.randrange(1, 5) for f in range(5) if draw.random() < 0.8}
        data.append((f"blk_{i}", sorted(counts), [counts[f] for f in sorted(counts)], 0))
    if planted:
        data.append(("blk_odd", [0, 5], [60, 40], 1))
    return spark.createDataFrame(data, "block_id string, idxs array<int>, cnts array<long>, label int")


def nodes_of(nodes):
    return {(r.tree, r.node): (r.feature, r.cut, r.size) for r in nodes.collect()}


def test_planted_block_scores_lowest_and_scores_are_in_range(spark):
    vectors = cloud(spark)
    model = fit_forest(vectors, 6, ForestParams(40, 1.0, 0.75, 0.05))
    scored = model.transform(vectors).orderBy("anomaly_score").collect()
    assert scored[0].block_id == "blk_odd" and scored[0].if_class == -1
    assert all(-1 <= r.anomaly_score + model.offset <= 0 for r in scored)
    assert abs(sum(r.if_class == -1 for r in scored) / len(scored) - 0.05) < 0.02


def test_same_forest_for_any_partitioning_and_any_growth(spark):
    vectors, params = cloud(spark), ForestParams(6, 1.0, 0.75, None)
    one, _ = grow_forest(vectors.coalesce(1), 6, params)
    many, _ = grow_forest(vectors.repartition(9), 6, params)
    by_level, _ = grow_forest(vectors, 6, params, grow_rows=10)
    assert nodes_of(one) == nodes_of(many) == nodes_of(by_level)
    sizes = {r.node: r["size"] for r in one.where("tree = 0").collect()}
    inner = [r.node for r in one.where("tree = 0 and feature >= 0").collect()]
    assert sizes[1] == 401 and all(sizes[n] == sizes[2 * n] + sizes[2 * n + 1] for n in inner)


def test_repeated_rows_count_as_their_multiplicity(spark):
    vectors = cloud(spark, 60)
    matrix = np.zeros((61, 6))
    rows = vectors.orderBy("block_id").collect()
    for i, r in enumerate(rows):
        matrix[i, r.idxs] = r.cnts
    weight = np.arange(1, 62)
    a = trees.grow(matrix, weight, 3, 0, 1.0, 12)
    b = trees.grow(np.repeat(matrix, weight, axis=0), np.ones(weight.sum(), np.int64), 3, 0, 1.0, 12)
    assert all((x == y).all() for x, y in zip(a, b))


@pytest.mark.parametrize("samples,size", [("auto", 256), (32, 32), (0.8, 320), (1.0, 401)])
def test_every_tree_draws_its_exact_sample(spark, samples, size):
    vectors = cloud(spark)
    nodes, drawn = grow_forest(vectors, 6, ForestParams(5, samples, 1.0, None))
    assert drawn == size and {r["size"] for r in nodes.where("node = 1").collect()} == {size}


def test_draws_follow_the_multiplicities():
    draw = np.random.default_rng(4)
    weights = np.array([500, 3, 1, 0, 96, 400])
    found = np.array([trees.deal(weights, 200, draw.random(6)) for _ in range(4000)])
    assert (found.sum(axis=1) == 200).all() and (found <= weights).all() and (found >= 0).all()
    assert np.abs(found.mean(axis=0) - weights / 5).max() < 0.5
    spread = np.sqrt(200 * (weights / 1000) * (1 - weights / 1000) * 800 / 999)
    assert np.abs(found.std(axis=0) - spread).max() < 0.3
    assert (trees.deal(weights, 1000, draw.random(6)) == weights).all()
    assert abs(trees.hypergeometric(10**11, 3 * 10**11, 6 * 10**10, 0.5) - 2 * 10**10) < 10**4


def test_walks_agree(spark, monkeypatch):
    vectors = cloud(spark)
    nodes, size = grow_forest(vectors, 6, ForestParams(6, 64, 0.75, None))
    model = ForestModel(nodes, 6, size, ForestParams(6, 64, 0.75, None))
    paths = lambda: {r.block_id: list(r.paths) for r in model.path_lengths(vectors, [2, 6]).collect()}
    whole = paths()
    most = nodes.groupBy("tree").count().agg(F.max("count")).first()[0]
    monkeypatch.setattr(iforest, "BROADCAST_NODES", most)
    in_runs = paths()
    monkeypatch.setattr(iforest, "BROADCAST_NODES", 1)
    by_join = paths()
    assert whole.keys() == in_runs.keys() == by_join.keys()
    for block in whole:
        assert in_runs[block] == pytest.approx(whole[block]) and by_join[block] == pytest.approx(whole[block])


def test_many_runs_of_trees_are_not_chained_in_a_task(spark, monkeypatch):
    vectors = cloud(spark).unionByName(cloud(spark))  # rows that come twice
    nodes, size = grow_forest(vectors, 6, ForestParams(6, 64, 0.75, None))
    model = ForestModel(nodes, 6, size, ForestParams(6, 64, 0.75, None))
    rows = lambda df: sorted((r.block_id, r.label, [round(p, 9) for p in r.paths]) for r in df.collect())
    whole = model.path_lengths(vectors, [2, 6])
    monkeypatch.setattr(iforest, "BROADCAST_NODES", nodes.groupBy("tree").count().agg(F.max("count")).first()[0])
    in_runs = model.path_lengths(vectors, [2, 6])
    assert in_runs._jdf.queryExecution().executedPlan().toString().count("MapInArrow") <= 1
    assert in_runs.columns == whole.columns and rows(in_runs) == rows(whole)


def test_draws_of_all_trees_equal_those_of_each(monkeypatch):
    draw = np.random.default_rng(6)
    weights, drawn, chances = draw.integers(1, 5000, 40), draw.integers(0, 60_000, 30), draw.random((30, 40))
    drawn = np.minimum(drawn, weights.sum())
    each = [trees.deal(weights, n, c) for n, c in zip(drawn, chances)]
    assert (trees.deal_all(weights, drawn, chances) == each).all()
    monkeypatch.setattr(trees, "DRAW_CELLS", 1)  # one tree at a time
    assert (trees.deal_all(weights, drawn, chances) == each).all()


def test_a_draw_moves_vectors_once_and_not_by_tree(spark):
    whole = distinct_vectors(cloud(spark))
    sample = iforest.draw_samples(whole, 401, 300, ForestParams(5, 300, 1.0, None))
    assert "CoGroup" in sample._jdf.queryExecution().executedPlan().toString()
    weights = {(tuple(r.idxs), tuple(r.cnts)): r.weight for r in whole.collect()}
    rows = sample.collect()
    assert all(0 < r.weight <= weights[tuple(r.idxs), tuple(r.cnts)] for r in rows)
    assert [sum(r.weight for r in rows if r.tree == t) for t in range(5)] == [300] * 5


def test_fit_with_trees_too_large_to_broadcast(spark, monkeypatch):
    vectors = cloud(spark)
    params = ForestParams(4, 64, 1.0, 0.1)
    fitted = lambda: {r.block_id: (round(r.anomaly_score, 9), r.if_class) for r in iforest.fit_forest(vectors, 6, params).transform(vectors).collect()}
    whole = fitted()
    monkeypatch.setattr(iforest, "BROADCAST_NODES", 1)
    assert fitted() == whole


def test_average_path():
    assert list(trees.average_path([0, 1, 2])) == [0, 0, 1]
    assert float(trees.average_path(256)) == pytest.approx(2 * (math.log(255) + 0.5772156649) - 2 * 255 / 256)


@pytest.mark.parametrize("small", [0, 50_000])
def test_weighted_quantiles(spark, monkeypatch, small):
    monkeypatch.setattr(ordering.running_sums, "__defaults__", (True, 16, small))
    draw = random.Random(8)
    data = [(round(draw.random(), 2), draw.randrange(1, 6)) for _ in range(300)]
    shares = [0.0, 0.03, 0.3, 0.5, 1.0]
    frame = spark.createDataFrame(data, "s double, n long")
    found = iforest.weighted_quantiles(frame, [F.col("s"), -F.col("s")], "n", shares)
    flat = np.repeat([s for s, _ in data], [n for _, n in data])
    assert found[0] == pytest.approx(list(np.quantile(flat, shares)))
    assert found[1] == pytest.approx(list(np.quantile(-flat, shares)))


def test_saved_model_scores_alike(spark, tmp_path):
    vectors = cloud(spark)
    model = fit_forest(vectors, 6, ForestParams(5, 1.0, 0.75, 0.1))
    model.save(str(tmp_path / "forest"))
    again = ForestModel.load(spark, str(tmp_path / "forest"))
    scores = lambda m: {r.block_id: r.anomaly_score for r in m.transform(vectors).collect()}
    assert scores(model) == scores(again)


def test_supervised_is_opt_in(spark):
    vectors = cloud(spark, 60).withColumn("label", (F.size("idxs") > 3).cast("int"))
    with pytest.raises(ValueError, match="supervised"):
        supervised.fit_random_forest(vectors, 6)
    with pytest.raises(ValueError, match="unsupported"):
        detect.train(vectors, 6, "nearest-neighbour")
    found = detect.train(vectors, 6, score.RANDOM_FOREST, allow_supervised=True, random_forest={"n_trees": 10, "max_depth": 5})
    assert found.threshold.first().score_direction == "higher"
    rows = found.predictions.collect()
    assert len(rows) == 61 and all(r.prediction == (r.anomaly_score >= r.decision_threshold) for r in rows)
    mean = lambda y: np.mean([r.anomaly_score for r in rows if r.label == y])
    assert mean(1) > mean(0) + 0.3


def test_training_smoke(spark):
    data = [("E1", "E2"), ("E2", "E3"), ("E1", "E3"), ("E4",), ("E4", "E2"), ("E5",)]
    rows = [(f"b{i}", sorted(int(e[1]) - 1 for e in events), [1] * len(events), y) for i, (events, y) in enumerate(zip(data, [0, 0, 0, 1, 1, 0]))]
    vectors = spark.createDataFrame(rows, "block_id string, idxs array<int>, cnts array<long>, label int")
    found = detect.train(vectors, 5)
    assert found.predictions.count() == 6
    assert set(found.predictions.columns) >= {"prediction", "anomaly_score", "decision_threshold", "score_direction", "algorithm"}


def test_grid_search(spark):
    vectors = cloud(spark, 150)
    grid = {"n_trees": [4, 8], "max_samples": ["auto", 1.0], "max_features": [1.0]}
    table, best = tuning.grid_search(vectors, 6, [0.01, 0.1], grid)
    rows = table.collect()
    assert len(rows) == 8 and sorted(r.rank for r in rows) == list(range(1, 9))
    top = next(r for r in rows if r.rank == 1)
    assert top.mean_f1 == max(r.mean_f1 for r in rows)
    assert (best.n_trees, str(best.max_samples), best.contamination) == (top.n_trees, top.max_samples, top.contamination)


@pytest.mark.parametrize("rows", [0, 1, 2, 3, 4, 10, 11])
def test_folds_are_contiguous(spark, rows):
    frame = spark.range(rows).selectExpr("id * 7 % 11 as place", "id").repartition(5)
    got = [r.fold for r in tuning.with_folds(frame, "place").orderBy("place").collect()]
    assert got == [k for k, part in enumerate(np.array_split(np.arange(rows), 3)) for _ in part]


def test_grid_search_is_brute_force(spark):
    """Every setting again, row by row: forests of the fit folds, cuts by numpy's quantiles, F1 on the fold left out."""
    vectors = cloud(spark, 90).withColumn("label", F.coalesce((F.get("cnts", F.lit(0)) > 3).cast("int"), F.lit(0)))
    rows = sorted(vectors.collect(), key=lambda r: r.block_id)
    matrix = np.zeros((len(rows), 6))
    for k, r in enumerate(rows):
        matrix[k, r.idxs] = r.cnts
    labels = np.array([r.label for r in rows])
    assert labels.sum() > 5
    grid = {"n_trees": [3, 6], "max_samples": [1.0], "max_features": [0.5, 1.0]}
    got = {(r.contamination, r.max_features, r.n_trees): r.mean_f1 for r in tuning.grid_search(vectors, 6, [0.05, 0.2], grid)[0].collect()}
    folds = np.array_split(np.arange(len(rows)), 3)
    for (share, features, n), mean in got.items():
        f1 = []
        for held in folds:
            fit = np.setdiff1d(np.arange(len(rows)), held)
            distinct, weight = np.unique(matrix[fit], axis=0, return_counts=True)
            paths = np.zeros(len(rows))
            for tree in range(n):
                node, feature, cut, size = trees.grow(distinct, weight, 42, tree, features, trees.depth_limit(len(fit)))
                paths += trees.Forest(np.full(len(node), tree), node, feature, cut, size).paths(matrix)[:, 0]
            scores = -(2.0 ** (-paths / (n * float(trees.average_path(len(fit))))))
            flagged = scores[held] < np.quantile(scores[fit], share)
            hit = (flagged & (labels[held] == 1)).sum()
            f1.append(2 * hit / (flagged.sum() + labels[held].sum()) if flagged.sum() + labels[held].sum() else 0.0)
        assert mean == pytest.approx(np.mean(f1))


def test_prefix_of_a_forest_is_the_smaller_forest(spark):
    vectors = cloud(spark, 100)
    large, _ = grow_forest(vectors, 6, ForestParams(5, 32, 0.75, None))
    small, _ = grow_forest(vectors, 6, ForestParams(3, 32, 0.75, None))
    assert nodes_of(large.where("tree < 3")) == nodes_of(small)


def test_features_must_match_the_vocabulary(spark):
    vocab = spark.createDataFrame([("E1", 0), ("E2", 1)], "event string, idx int")
    score.check_features(2, vocab)
    with pytest.raises(ValueError, match="3 features"):
        score.check_features(3, vocab)


def test_native_classes_and_default_cuts(spark):
    rows = spark.createDataFrame([(-1, -0.1), (1, 0.0), (1, 0.6)], "if_class int, anomaly_score double")
    assert [r[0] for r in rows.select(metrics.class_flag(F.col("if_class"))).collect()] == [1, 0, 0]
    assert [r.prediction for r in score.apply_default(rows).collect()] == [1, 0, 0]
    upward = score.apply_default(rows, score.RANDOM_FOREST).collect()
    assert [(r.prediction, r.score_direction) for r in upward] == [(0, "higher"), (0, "higher"), (1, "higher")]


def test_contamination_candidates():
    assert tuning.reduced_contamination_grid(0.03) == [0.03, 0.045, 0.05]
    assert tuning.reduced_contamination_grid(0.08) == [0.08, 0.1]
    assert tuning.reduced_contamination_grid(0.2) == [0.2]
