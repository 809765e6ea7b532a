"""Anomaly flags from scores and a threshold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logblocks.functions.metrics import flagged

ISOLATION_FOREST = "isolation-forest"
RANDOM_FOREST = "random-forest"

# Fixed values: (direction, threshold) when no calibrated threshold is given.
DEFAULTS = {ISOLATION_FOREST: ("lower", 0.0), RANDOM_FOREST: ("higher", 0.5)}


def apply_threshold(scored: DataFrame, threshold: DataFrame, score: str = "anomaly_score") -> DataFrame:
    """Adds prediction, threshold, direction and algorithm from a threshold table of exactly one row.

    ``lower`` flags strictly below the threshold, so the boundary rows that
    calibration counted are left out; random-forest scores always flag upward.
    """
    config = threshold.select(
        F.col("score_threshold").cast("double").alias("decision_threshold"),
        F.coalesce("score_direction", F.lit("lower")).alias("score_direction"),
        F.coalesce("algorithm", F.lit(ISOLATION_FOREST)).alias("algorithm"),
    )
    if (rows := config.limit(2).count()) != 1:
        raise ValueError(f"a threshold table needs exactly one row, found {'none' if not rows else 'more'}")
    acting = F.when(F.col("algorithm") == RANDOM_FOREST, "higher").otherwise(F.col("score_direction"))
    return scored.crossJoin(F.broadcast(config)).withColumn(
        "prediction", flagged(F.col(score), F.col("decision_threshold"), acting)
    )


def apply_default(scored: DataFrame, algorithm: str = ISOLATION_FOREST, score: str = "anomaly_score") -> DataFrame:
    """Flags with the algorithm's default cut."""
    direction, cut = DEFAULTS[algorithm]
    return scored.withColumns(
        {
            "decision_threshold": F.lit(cut),
            "score_direction": F.lit(direction),
            "algorithm": F.lit(algorithm),
            "prediction": flagged(F.col(score), F.lit(cut), F.lit(direction)),
        }
    )


def check_features(model_features: int, vocab: DataFrame) -> None:
    size = vocab.count()
    if size != model_features:
        raise ValueError(f"the model has {model_features} features but the vocabulary has {size}")
