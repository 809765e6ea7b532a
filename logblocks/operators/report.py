"""Run summary and metrics history."""

from __future__ import annotations

import json
import re
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from logblocks.functions.metrics import report_ratios, rounded_ratio
from logblocks.operators import evaluate, guardrails

# The columns of the history and, below, the keys of the summary.
HISTORY = (
    "generated_at string, data_csv string, predictions_csv string, algorithm string, "
    "precision double, recall double, f1 double, "
    "true_positives long, false_positives long, true_negatives long, false_negatives long, "
    "anomalies_flagged long, total_sequences long, labeled_anomalies long, labeled_normals long, "
    "contamination double, guardrails_status string"
)


def run_counts(blocks: DataFrame, predictions: DataFrame) -> DataFrame:
    """One row of sequence, prediction and (when labelled) confusion counts."""
    row = evaluate.label_stats(blocks).crossJoin(evaluate.prediction_stats(predictions))
    if "label" in blocks.columns:
        row = row.crossJoin(evaluate.confusion(evaluate.with_labels(predictions, blocks)))
    return row


def run_summary(
    spark: SparkSession,
    blocks: DataFrame,
    predictions: DataFrame,
    checks: DataFrame,
    artifacts: dict[str, str],
    top_k: int = 5,
    generated_at: str | None = None,
) -> tuple[DataFrame, DataFrame | None, str | None]:
    """(summary row as JSON text, history row or None, guardrail failure or None).

    Only counts, ``top_k`` rows and the check rows reach the driver. Ratios are
    rounded there on their exact binary value.
    """
    direction = evaluate.score_direction(predictions)
    counts = run_counts(blocks, predictions).first().asDict()
    top = [r.asDict() for r in evaluate.top_anomalies(predictions, top_k, direction).collect()]
    rails, failure = guardrails.guardrail_report(checks.collect())
    labelled = "label" in blocks.columns
    stats = {k: counts[k] for k in ("total_sequences", "labeled_normals", "labeled_anomalies")}
    evaluation = None
    if labelled:
        cells = {k: counts[k] for k in ("true_positives", "false_positives", "true_negatives", "false_negatives")}
        evaluation = {**cells, **report_ratios(cells)}
    summary = {
        "generated_at": generated_at or datetime.now(timezone.utc).isoformat(),
        "artifacts": artifacts,
        "sequence_stats": stats,
        "prediction_stats": {
            "total_predictions": counts["total_predictions"],
            "anomalies_flagged": counts["anomalies_flagged"],
            "top_anomalies": top,
            "score_direction": direction,
        },
        "evaluation": evaluation,
        "guardrails": rails,
    }
    report = spark.createDataFrame([(json.dumps(summary),)], "value string")
    if not labelled:
        return report, None, failure
    algorithm = predictions.select("algorithm").first() if "algorithm" in predictions.columns else None
    row = {
        "generated_at": summary["generated_at"],
        "data_csv": artifacts.get("sequences"),
        "predictions_csv": artifacts.get("predictions"),
        "algorithm": algorithm[0] if algorithm else None,
        **evaluation,
        "anomalies_flagged": counts["anomalies_flagged"],
        **stats,
        "contamination": rounded_ratio(stats["labeled_anomalies"], stats["total_sequences"], 6),
        "guardrails_status": "fail" if failure else "ok",
    }
    names = [part.split()[0] for part in HISTORY.split(", ")]
    return report, spark.createDataFrame([tuple(row[n] for n in names)], HISTORY), failure


def write_run(
    report: DataFrame, history: DataFrame | None, failure: str | None, summary_path: str, history_path: str, run_id: str | None = None
) -> None:
    """Writes the summary, adds the history row, and only then raises a guardrail failure.

    With a ``run_id`` the row has a folder of its own, so a run that is written again replaces its row; without one it is appended.
    """
    report.coalesce(1).write.mode("overwrite").text(summary_path)
    if history is not None:
        keyed = history_path if run_id is None else f"{history_path}/run-{re.sub(r'[^0-9A-Za-z_.-]', '_', run_id)}"
        history.coalesce(1).write.mode("append" if run_id is None else "overwrite").option("header", True).csv(keyed)
    if failure:
        raise guardrails.GuardrailError(failure)
