"""Train, calibrate, score and evaluate a detector over labelled count vectors."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logblocks.operators import calibrate, evaluate, score, splits, supervised, tuning
from logblocks.operators.iforest import ForestParams, fit_forest
from logblocks.operators.staging import materialize


@dataclass
class Detector:
    """A scoring function ``vectors -> vectors + anomaly_score``, its threshold and its test report."""

    model: object
    scored: DataFrame
    threshold: DataFrame
    predictions: DataFrame
    test_report: DataFrame


def train(
    vectors: DataFrame,
    n_features: int,
    algorithm: str = score.ISOLATION_FOREST,
    params: ForestParams | None = None,
    tune: bool = False,
    allow_supervised: bool = False,
    beta: float = 2.0,
    min_precision: float | None = 0.75,
    random_forest: dict | None = None,
) -> Detector:
    """70/30 stratified split, 20% of training held for calibration, flags on all rows.

    ``vectors``: block_id, idxs, cnts, label and, once split, is_test.
    """
    calibrate.check_parameters(beta, min_precision)
    if "is_test" not in vectors.columns:
        vectors = materialize(splits.stratified_split(vectors, "block_id", "label", 0.3, 42), "split")
    fit_rows, held = splits.calibration_split(vectors.where(~F.col("is_test")), "block_id", "label")
    if algorithm == score.ISOLATION_FOREST:
        ratio = splits.contamination(fit_rows).first()[0]
        if tune:
            _, params = tuning.grid_search(fit_rows, n_features, tuning.contamination_grid(ratio))
        model = fit_forest(fit_rows, n_features, params or ForestParams(contamination=ratio))
        scored = materialize(model.transform(vectors), "scored")
    elif algorithm == score.RANDOM_FOREST:
        model = supervised.fit_random_forest(fit_rows, n_features, allow_supervised, **(random_forest or {}))
        scored = materialize(supervised.score_random_forest(model, vectors, n_features), "scored")
    else:
        raise ValueError(f"unsupported algorithm: {algorithm}")
    held_scores = scored.join(held.select("block_id"), "block_id", "left_semi")
    threshold = materialize(
        calibrate.calibrate(
            held_scores, lower_is_anomalous=algorithm == score.ISOLATION_FOREST, beta=beta, min_precision=min_precision, algorithm=algorithm
        ),
        "threshold",
    )
    predictions = score.apply_threshold(scored, threshold)
    report = evaluate.classification_report(predictions.where("is_test"))
    return Detector(model, scored, threshold, predictions, report)
