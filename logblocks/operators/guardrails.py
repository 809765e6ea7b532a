"""Data-quality checks on the sequence, index and vocabulary tables."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logblocks.operators.staging import materialize

SAMPLE_EVENTS = 10


class GuardrailError(RuntimeError):
    """One or more checks failed."""


def _check(facts: DataFrame, name: str, issues: list, details: dict, list_none: bool = True) -> DataFrame:
    """One check row; ``issues`` are texts that are null when the rule holds.

    ``details`` is a JSON object with numbers and booleans as such; it lists the issues, an empty
    list only if ``list_none``.
    """
    listed = F.col("issues") if list_none else F.when(F.size("issues") > 0, F.col("issues"))
    return facts.withColumn("issues", F.array_compact(F.array(*issues))).select(
        F.lit(name).alias("name"),
        F.when(F.size("issues") > 0, "fail").otherwise("ok").alias("status"),
        "issues",
        F.to_json(F.struct(*[value.alias(key) for key, value in details.items()], listed.alias("issues"))).alias("details"),
    )


def check_sequences(sequences: DataFrame) -> DataFrame:
    """Sequence table: event lists of text, at least one row, a label on every row or none."""
    field = sequences.schema["events"].dataType
    is_list = isinstance(field, T.ArrayType) and isinstance(field.elementType, T.StringType)
    labelled = "label" in sequences.columns
    facts = sequences.agg(
        F.count("*").alias("rows"),
        F.count("events").alias("lists"),
        F.count("label" if labelled else F.lit(1)).alias("labels"),
    )
    bad_list = F.lit(True) if not is_list else F.col("lists") < F.col("rows")
    # The texts of the issues.
    issues = [
        F.when(F.col("rows") == 0, "x_data is empty"),
        F.when((F.col("rows") > 0) & bad_list, "x_data entries must be iterable sequences of events"),
        F.when(
            F.col("labels") != F.col("rows"),
            F.format_string("y_data length %d does not match x_data length %d", "labels", "rows"),
        ),
    ]
    return _check(facts, "npz_schema", issues, {"num_sequences": F.col("rows"), "has_labels": F.lit(labelled)})


def check_block_index(index: DataFrame | None, expected: DataFrame, path: str = "") -> DataFrame:
    """Block index, read from ``path``, against the 1-row ``expected_rows`` table; a missing index only warns."""
    # Fixed values, here and below: the texts of the message and of the issues.
    if index is None:
        return expected.select(
            F.lit("block_index").alias("name"),
            F.lit("warn").alias("status"),
            F.array().cast("array<string>").alias("issues"),
            F.to_json(
                F.struct(F.lit(f"Block index not found at {path}; skipping length validation.").alias("message"), "expected_rows")
            ).alias("details"),
        )
    facts = index.agg(F.count("*").alias("rows")).crossJoin(expected)
    issues = [
        F.lit(None if "BlockId" in index.columns else "BlockId column missing from block index").cast("string"),
        F.when(
            F.col("rows") != F.col("expected_rows"),
            F.format_string("Block index row count %d does not match expected %d", "rows", "expected_rows"),
        ),
    ]
    return _check(facts, "block_index", issues, {"path": F.lit(path), "rows": F.col("rows")})


def check_vocabulary(events: DataFrame, vocab: DataFrame, drift_tolerance: float = 0.25, max_unknown_events: int = 0) -> DataFrame:
    """Observed events against the vocabulary: size drift and unknown events."""
    if vocab.isEmpty():
        raise GuardrailError("Event vocabulary is empty; retrain the model.")
    known = vocab.select(F.col("event").alias("event_id"), F.lit(True).alias("_known"))
    seen = materialize(events.select("event_id").distinct().join(known, "event_id", "left"), "events-seen")
    unknown = F.when(F.col("_known").isNull(), F.col("event_id"))
    observed = seen.agg(F.count("*").alias("observed"), F.count(unknown).alias("unknown"))
    samples = (
        seen.where(F.col("_known").isNull())
        .orderBy("event_id")
        .limit(SAMPLE_EVENTS)
        .agg(F.array_sort(F.collect_list("event_id")).alias("samples"))
    )
    size = vocab.agg(F.count("*").alias("vocab_size"))
    facts = observed.crossJoin(samples).crossJoin(size).withColumn(
        "drift", F.abs(F.col("observed") - F.col("vocab_size")) / F.col("vocab_size")
    )
    # The texts of the issues.
    quoted = F.concat(F.lit("['"), F.array_join("samples", "', '"), F.lit("']"))
    issues = [
        F.when(
            F.col("drift") > drift_tolerance,
            F.format_string(
                "Observed event count %d deviates from vocab size %d by %.2f%%", "observed", "vocab_size", F.col("drift") * 100
            ),
        ),
        F.when(
            F.col("unknown") > max_unknown_events,
            F.format_string("Encountered %d events not present in vocabulary (samples: %s)", F.col("unknown"), quoted),
        ),
    ]
    return _check(
        facts,
        "vocabulary",
        issues,
        {
            "vocab_size": F.col("vocab_size"),
            "observed_event_count": F.col("observed"),
            "drift": F.col("drift"),
            "unknown_event_count": F.col("unknown"),
        },
        list_none=False,
    )


def guardrail_report(checks: list[Row]) -> tuple[dict, str | None]:
    """The report section of collected check rows, and the failure text if any failed."""
    failed = [c for c in checks if c.status == "fail"]
    if failed:
        # Fixed value: the text of a failure.
        error = "Guardrail checks failed: " + ", ".join(f"{c.name}: {list(c.issues)}" for c in failed)
        return {"status": "fail", "error": error}, error
    return {c.name: {"status": c.status, **json.loads(c.details)} for c in checks}, None


def run_guardrails(
    sequences: DataFrame,
    events: DataFrame,
    vocab: DataFrame,
    index: DataFrame | None,
    drift_tolerance: float = 0.25,
    max_unknown_events: int = 0,
    index_path: str = "",
) -> DataFrame:
    """All checks as one three-row table."""
    expected = sequences.agg(F.count("*").alias("expected_rows"))
    return (
        check_sequences(sequences)
        .unionByName(check_block_index(index, expected, index_path))
        .unionByName(check_vocabulary(events, vocab, drift_tolerance, max_unknown_events))
    )


def raise_on_failure(checks: DataFrame) -> DataFrame:
    """Raises once with every failing check."""
    _, error = guardrail_report(checks.collect())  # one row per check
    if error:
        raise GuardrailError(error)
    return checks
