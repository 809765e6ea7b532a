"""Readers for the tables that pass between the stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logblocks.functions.text import strip
from logblocks.operators.features import check_vocabulary_index
from logblocks.operators.report import HISTORY
from logblocks.operators.staging import require_columns
from logblocks.sources import schemas
from logblocks.sources.lines import number_file_rows


def _csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.option("header", True).option("escape", '"')
    return (reader.schema(schema) if schema else reader).csv(path)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a metrics history, appended ones and those of keyed runs."""
    return spark.read.option("header", True).option("escape", '"').option("recursiveFileLookup", True).schema(HISTORY).csv(path)


def read_parsed(spark: SparkSession, path: str, message: str = "message", csv: bool = False) -> DataFrame:
    """Parsed log with ``line_no``; a CSV file gets its numbers from the file order."""
    if not csv:
        return require_columns(spark.read.parquet(path), [message], "parsed log")
    raw = _csv(spark, path)
    require_columns(raw, [message], "parsed log")
    numbered = number_file_rows(raw)
    typed = {"timestamp": "bigint", "pid": "int"}
    return numbered.withColumns({c: F.col(c).try_cast(t) for c, t in typed.items() if c in raw.columns})


def read_structured(spark: SparkSession, path: str, message: str = "message", event: str = "event_id") -> DataFrame:
    """``(line_no, message, event)`` only; Parquet reads no other column."""
    table = spark.read.parquet(path)
    require_columns(table, ["line_no", message, event], "structured log")
    return table.select("line_no", message, event)


def read_labels(spark: SparkSession, path: str | None) -> DataFrame | None:
    """``(label_row, BlockId, Label)`` in file order; no path means unlabelled."""
    if not path:
        return None
    raw = _csv(spark, path)
    require_columns(raw, ["BlockId", "Label"], "label table")
    return number_file_rows(raw, "label_row").select("label_row", "BlockId", "Label")


def read_sequences(spark: SparkSession, path: str, labels_required: bool = False) -> DataFrame:
    table = spark.read.parquet(path)
    return require_columns(table, ["events", *(["label"] if labels_required else [])], "sequence table")


def with_sequence_ids(sequences: DataFrame, order: str = "row_idx") -> DataFrame:
    """Sequences without block ids get ``sequence_{i}`` as ``SequenceId``."""
    if "block_id" in sequences.columns:
        return sequences
    return sequences.withColumn("SequenceId", F.concat(F.lit("sequence_"), F.col(order).cast("string")))


def read_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """``(event, idx)`` from one JSON object of event -> index, indices checked."""
    raw = spark.read.text(path, wholetext=True)
    pairs = F.explode(F.from_json("value", "map<string, int>")).alias("event", "idx")
    return check_vocabulary_index(raw.select(pairs))


def read_threshold(spark: SparkSession, path: str | None) -> DataFrame | None:
    """The 1-row threshold table; raises when it names no threshold."""
    if not path:
        return None
    table = spark.read.option("multiLine", True).schema(schemas.THRESHOLD).json(path)
    if table.where(F.col("score_threshold").isNull()).limit(1).count():
        raise ValueError("the threshold file has no score_threshold; train again")
    return table


def read_block_index(spark: SparkSession, path: str, expected_rows: int) -> DataFrame:
    index = require_columns(_csv(spark, path), ["BlockId"], "block index")
    rows = index.count()
    if rows != expected_rows:
        raise ValueError(f"block index has {rows} rows, expected {expected_rows}")
    return index


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Predictions for evaluation, with numbers as numbers."""
    raw = _csv(spark, path)
    require_columns(raw, ["prediction", "anomaly_score"], "predictions")
    numbers = {"prediction": "int", "anomaly_score": "double", "decision_threshold": "double"}
    return raw.withColumns({c: F.col(c).cast(t) for c, t in numbers.items() if c in raw.columns})


def read_run(spark: SparkSession, summary: str, history: str) -> tuple[DataFrame, DataFrame]:
    """(summary with numbers and booleans as such, metrics history)."""
    return spark.read.json(summary), read_history(spark, history)


def read_anomalies(spark: SparkSession, path: str) -> DataFrame:
    """Flagged predictions ``(row_idx, block_id, prediction, anomaly_score, decision_threshold, score_direction)``.

    Header names match in any case. A blank prediction skips the row; a blank
    score or threshold is 0; any other text that is not a number fails the job.
    """
    raw = spark.read.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", True).csv(path)
    numbered = number_file_rows(raw, "row_idx")
    lowered = numbered.toDF(*[c.lower() for c in numbered.columns])
    require_columns(lowered, ["blockid", "prediction"], "predictions")
    return flagged_rows(lowered)


def flagged_rows(rows: DataFrame) -> DataFrame:
    """The flagged rows of a lower-cased text table, optional columns defaulted."""

    def text(name: str):
        return strip(F.coalesce(F.col(name), F.lit("")))

    def number(name: str, sql_type: str, digits: str):
        bad = F.raise_error(F.format_string(f"{name} is not a number: %s", F.col(name)))
        return F.when(text(name).rlike(digits), text(name).try_cast(sql_type)).otherwise(bad.cast(sql_type))

    def value(name: str):
        if name not in rows.columns:
            return F.lit(0.0)
        real = "^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?$|^(?i)[+-]?(inf|infinity|nan)$"
        return F.when(text(name) == "", 0.0).otherwise(number(name, "double", real))

    direction = F.lower(text("score_direction")) if "score_direction" in rows.columns else F.lit("lower")
    flag = F.when(text("prediction") != "", number("prediction", "bigint", "^[+-]?[0-9]+$"))
    return rows.where(flag == 1).select(
        "row_idx",
        F.col("blockid").alias("block_id"),
        F.lit(1).alias("prediction"),
        value("anomaly_score").alias("anomaly_score"),
        value("decision_threshold").alias("decision_threshold"),
        F.when(direction == "", "lower").otherwise(direction).alias("score_direction"),
    )
