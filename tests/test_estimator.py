"""The detector as pipeline stages, JVM scoring and the one-pass split."""

import random

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from logblocks.operators import estimator, iforest, parse, tuning
from logblocks.operators.iforest import ForestModel, ForestParams, grow_forest
from tests.conftest import lines_of


def blocks(spark, n=120):
    draw = random.Random(4)
    rows = []
    for k in range(n):
        odd = k % 12 == 0
        events = draw.choices(["E1", "E2", "E10", "E3"], k=draw.randint(3, 8)) + (["E7"] * draw.randint(4, 9) if odd else [])
        rows.append((f"b{k:03}", events, int(odd), k % 4 == 1))
    rows += [("none", None, 0, False), ("empty", [], 0, False)]
    return spark.createDataFrame(rows, "block_id string, events array<string>, label int, is_calibration boolean")


def pipeline():
    return Pipeline(stages=[estimator.EventVocabulary(), estimator.IsolationForest(numTrees=10), estimator.ScoreThreshold(beta=1.0)])


def test_saved_pipeline_flags_alike(spark, tmp_path):
    rows = blocks(spark)
    fitted = pipeline().fit(rows)
    fitted.write().save(str(tmp_path / "detector"))
    again = PipelineModel.load(str(tmp_path / "detector"))
    flags = lambda m: {r.block_id: (r.anomaly_score, r.if_class, r.prediction, r.decision_threshold) for r in m.transform(rows).collect()}
    assert flags(fitted) == flags(again) and len(flags(again)) == 122
    assert again.stages[0].events == ["E1", "E10", "E2", "E3", "E7"] and again.stages[1].getOrDefault("numTrees") == 10
    assert again.stages[1].uid == fitted.stages[1].uid and again.stages[2].getOrDefault("beta") == 1.0
    pipeline().write().save(str(tmp_path / "unfitted"))
    assert Pipeline.load(str(tmp_path / "unfitted")).getStages()[2].getOrDefault("beta") == 1.0


def test_vocabulary_counts_known_events(spark):
    model = estimator.EventVocabulary().fit(blocks(spark))
    odd = spark.createDataFrame([("x", ["E3", "new", "E1", "E3"]), ("y", None), ("z", ["new"])], "block_id string, events array<string>")
    got = {r.block_id: (r.idxs, r.cnts) for r in model.transform(odd).collect()}
    assert got == {"x": ([0, 3], [1, 2]), "y": ([], []), "z": ([], [])}


def test_rows_for_calibration_do_not_grow_the_forest(spark):
    rows = blocks(spark)
    vocab = estimator.EventVocabulary().fit(rows).transform(rows)
    forest = estimator.IsolationForest(numTrees=3).fit(vocab).forest
    assert forest.sample_size == rows.where(~F.col("is_calibration")).count()
    share = rows.where(~F.col("is_calibration")).agg(F.avg("label")).first()[0]
    assert forest.params.contamination == pytest.approx(share)
    with pytest.raises(ValueError, match="features"):
        other = estimator.EventVocabulary().fit(rows.where("label = 0")).transform(rows)
        estimator.IsolationForestModel(forest).transform(other)


def test_params_copy(spark):
    stage = estimator.IsolationForest(maxSamples="auto", contamination=0.1)
    other = stage.copy({stage.numTrees: 7})
    assert (other.getOrDefault("numTrees"), stage.getOrDefault("numTrees")) == (7, 100)
    assert other.params_for(None) == ForestParams(7, "auto", 0.75, 0.1, 42)
    assert estimator.IsolationForest(maxSamples="32", contamination=0.1).params_for(None).max_samples == 32


def test_cross_validation_on_contiguous_folds(spark):
    rows = tuning.with_folds(estimator.EventVocabulary().fit(blocks(spark)).transform(blocks(spark)), "block_id")
    stage = estimator.IsolationForest(numTrees=5)
    grid = ParamGridBuilder().addGrid(stage.maxFeatures, [0.5, 1.0]).build()
    # a CrossValidator's evaluators see each fold; the metadata of the index column carries the feature count
    found = CrossValidator(estimator=stage, estimatorParamMaps=grid, evaluator=estimator.AnomalyF1(), numFolds=3, foldCol="fold").fit(rows)
    assert len(found.avgMetrics) == 2 and all(0 <= m <= 1 for m in found.avgMetrics) and max(found.avgMetrics) > 0


def test_evaluator(spark):
    rows = spark.createDataFrame([(-1, 1), (-1, 0), (1, 1), (1, 0)], "if_class int, label int")
    assert estimator.AnomalyF1().evaluate(rows) == 0.5
    assert estimator.AnomalyF1().evaluate(rows.limit(0)) == 0.0


@pytest.mark.parametrize("packed", [200_000, 0])
def test_scores_on_the_jvm(spark, monkeypatch, packed):
    vectors = estimator.EventVocabulary().fit(blocks(spark)).transform(blocks(spark)).select("block_id", "idxs", "cnts")
    params = ForestParams(8, 40, 0.75, None)
    nodes, size = grow_forest(vectors, 5, params)
    model = ForestModel(nodes, 5, size, params)
    scores = lambda df: {r.block_id: (round(r.anomaly_score, 9), r.if_class) for r in df.collect()}
    monkeypatch.setattr(iforest, "PACKED_NODES", packed)
    on_jvm = model.transform_on_jvm(vectors)
    assert scores(on_jvm) == scores(model.transform(vectors))
    plan = on_jvm._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "InArrow", "InPandas", "ArrowEval"))


def test_one_pass_split_equals_the_parts(spark):
    lines = lines_of(spark, [
        "081109 203518 143 INFO dfs.DataNode$X: Receiving block blk_1", "too short", "990230 000000 1 INFO a: b",
        "081109 203519 x INFO a: b", "", "081109 203520 7 WARN dfs.FSNamesystem: ok", None,
    ])
    whole = parse.split_lines(lines)
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(whole.good) == rows(parse.parse_lines(lines)) and whole.good.columns == parse.parse_lines(lines).columns
    assert sorted(map(tuple, whole.rejected.collect()), key=str) == sorted(map(tuple, parse.rejected_lines(lines).collect()), key=str)
    counts = {r.reason: r["lines"] for r in parse.reject_counts(lines).collect()}
    assert {k: n for k, n in whole.counts.items() if n} == counts | {parse.GOOD: rows(whole.good).__len__()}
    assert whole.without_block == 1  # the good line that names none
    assert "PartitionFilters" in whole.good._jdf.queryExecution().toString()
    empty = parse.split_lines(lines.limit(0))
    assert empty.good.count() == 0 and set(empty.counts.values()) == {0} and empty.without_block == 0
