"""Counts, confusion matrix and per-class report over predictions and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logblocks.functions.metrics import ratio
from logblocks.operators.staging import require_columns


def _count(condition) -> "F.Column":
    return F.coalesce(F.sum(condition.cast("bigint")), F.lit(0))


def label_stats(blocks: DataFrame) -> DataFrame:
    """Total, normal and anomalous sequences; the last two are null when unlabelled."""
    total = F.count("*").alias("total_sequences")
    if "label" not in blocks.columns:
        none = F.lit(None).cast("bigint")
        return blocks.agg(total).select("*", none.alias("labeled_normals"), none.alias("labeled_anomalies"))
    return blocks.agg(
        total,
        _count(F.col("label") == 0).alias("labeled_normals"),
        _count(F.col("label") == 1).alias("labeled_anomalies"),
    )


def prediction_stats(predictions: DataFrame) -> DataFrame:
    return predictions.agg(
        F.count("*").alias("total_predictions"),
        _count(F.col("prediction") == 1).alias("anomalies_flagged"),
    )


def score_direction(predictions: DataFrame) -> str:
    """The one direction of the table, ``lower`` when it names none."""
    require_columns(predictions, ["prediction", "anomaly_score"], "predictions")
    if "score_direction" not in predictions.columns:
        return "lower"
    found = predictions.agg(F.min("score_direction"), F.max("score_direction")).first()
    if found[0] != found[1]:
        raise ValueError(f"predictions mix score directions {found[0]!r} and {found[1]!r}")
    return found[0] or "lower"


def top_anomalies(predictions: DataFrame, k: int, direction: str = "lower", tie: str = "block_id") -> DataFrame:
    """The ``k`` most extreme flagged rows by raw score."""
    score = F.col("anomaly_score")
    order = score.desc() if direction == "higher" else score.asc()
    return predictions.where(F.col("prediction") == 1).orderBy(order, tie).limit(k)


def with_labels(predictions: DataFrame, labelled: DataFrame) -> DataFrame:
    """Predictions joined to labels by block; a row without its partner fails the job."""
    pairs = predictions.join(labelled.select("block_id", "label"), "block_id", "full")

    def present(name: str, what: str):
        lost = F.raise_error(F.concat(F.lit(f"no {what} for block "), F.col("block_id"))).cast("int")
        return F.coalesce(F.col(name).cast("int"), lost)

    return pairs.withColumns({"label": present("label", "label"), "prediction": present("prediction", "prediction")})


def confusion(pairs: DataFrame) -> DataFrame:
    """tp, fp, tn, fn and their unrounded ratios, in one aggregation."""
    hit = lambda p, y: _count((F.col("prediction") == p) & (F.col("label") == y))
    counts = pairs.agg(
        hit(1, 1).alias("true_positives"),
        hit(1, 0).alias("false_positives"),
        hit(0, 0).alias("true_negatives"),
        hit(0, 1).alias("false_negatives"),
    )
    tp, fp, fn = F.col("true_positives"), F.col("false_positives"), F.col("false_negatives")
    return counts.select(
        "*",
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        F.when((tp + fp > 0) & (tp + fn > 0), ratio(2 * tp, 2 * tp + fp + fn)).alias("f1"),
    )


def classification_report(pairs: DataFrame) -> DataFrame:
    """Per class, and as macro and weighted averages: precision, recall, F1, support.

    A ratio without a denominator counts as 0. One aggregation yields the four
    counts; the rows of the report are arithmetic on them.
    """
    hit = lambda p, y: _count((F.col("prediction") == p) & (F.col("label") == y))
    counts = pairs.agg(hit(0, 0).alias("tn"), hit(0, 1).alias("fn"), hit(1, 0).alias("fp"), hit(1, 1).alias("tp"))
    tn, fn, fp, tp = (F.col(c) for c in ("tn", "fn", "fp", "tp"))
    safe = lambda a, b: F.coalesce(ratio(a, b), F.lit(0.0))

    def metrics(right, predicted, support):
        return [safe(right, predicted), safe(right, support), safe(2 * right, predicted + support)]

    normal, anomaly = metrics(tn, tn + fn, tn + fp), metrics(tp, tp + fp, tp + fn)
    total = tn + fn + fp + tp
    macro = [(n + a) / 2 for n, a in zip(normal, anomaly)]
    weighted = [safe(n * (tn + fp) + a * (tp + fn), total) for n, a in zip(normal, anomaly)]
    lines = {
        "Normal": (normal, tn + fp),
        "Anomaly": (anomaly, tp + fn),
        "accuracy": ([safe(tn + tp, total)] * 3, total),
        "macro avg": (macro, total),
        "weighted avg": (weighted, total),
    }
    rows = [
        F.struct(F.lit(name).alias("class"), *[v.alias(m) for v, m in zip(values, ("precision", "recall", "f1"))], support.alias("support"))
        for name, (values, support) in lines.items()
    ]
    return counts.select(F.inline(F.array(*rows)))
