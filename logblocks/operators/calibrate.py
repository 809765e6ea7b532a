"""Decision threshold that maximises F-beta under a precision floor."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logblocks.functions.metrics import f_beta
from logblocks.operators.ordering import running_sums
from logblocks.operators.staging import materialize


def check_parameters(beta: float, min_precision: float | None) -> None:
    if beta <= 0:
        raise ValueError("beta must be positive")
    if min_precision is not None and not 0.0 < min_precision < 1.0:
        raise ValueError("the precision floor must lie between 0 and 1")


def threshold_curve(scored: DataFrame, score: str, label: str, lower_is_anomalous: bool = True) -> DataFrame:
    """``(score, tp, n_flagged, precision, recall)`` per distinct score.

    Rows at the threshold count as flagged. Equal scores are summed before
    the shuffle, so a score that many rows share is one row here.
    """
    by_score = materialize(
        scored.groupBy(F.col(score).alias("score")).agg(
            F.sum(F.col(label).cast("bigint")).alias("pos"), F.count("*").alias("n")
        ),
        "scores",
    )
    positives = by_score.agg(F.sum("pos").alias("_p"))
    curve = running_sums(by_score, "score", {"tp": "pos", "n_flagged": "n"}, ascending=lower_is_anomalous)
    return curve.crossJoin(F.broadcast(positives)).select(
        "score",
        "tp",
        "n_flagged",
        (F.col("tp") / F.col("n_flagged")).alias("precision"),
        F.when(F.col("_p") > 0, F.col("tp") / F.when(F.col("_p") > 0, F.col("_p"))).otherwise(1.0).alias("recall"),
    )


def calibrate(
    scored: DataFrame,
    score: str = "anomaly_score",
    label: str = "label",
    lower_is_anomalous: bool = True,
    beta: float = 2.0,
    min_precision: float | None = 0.75,
    algorithm: str = "isolation-forest",
) -> DataFrame:
    """One row: the threshold, its direction and its calibration metrics.

    Equal F-beta: the threshold that flags more rows wins. No threshold at the
    floor: the best of all. No rows: threshold 0 and zero metrics.
    """
    check_parameters(beta, min_precision)
    curve = threshold_curve(scored, score, label, lower_is_anomalous)
    floor = F.lit(True) if min_precision is None else F.col("precision") >= min_precision
    best = F.max(
        F.struct(
            floor.alias("feasible"),
            f_beta(F.col("precision"), F.col("recall"), beta).alias("f_beta"),
            F.col("n_flagged"),
            F.col("score"),
            F.col("precision"),
            F.col("recall"),
            f_beta(F.col("precision"), F.col("recall"), 1.0).alias("f1"),
        )
    )
    row = curve.agg(best.alias("b"), F.coalesce(F.max("n_flagged"), F.lit(0)).alias("size"))
    value = lambda name: F.coalesce(F.col(f"b.{name}"), F.lit(0.0))
    return row.select(
        F.lit(algorithm).alias("algorithm"),
        value("score").alias("score_threshold"),
        F.lit("lower" if lower_is_anomalous else "higher").alias("score_direction"),
        F.struct(*[value(n).alias(n) for n in ("precision", "recall", "f1", "f_beta")]).alias("calibration_metrics"),
        F.col("size").alias("calibration_size"),
        F.lit(float(beta)).alias("calibration_beta"),
        F.lit(min_precision).cast("double").alias("min_calibration_precision"),
    )
