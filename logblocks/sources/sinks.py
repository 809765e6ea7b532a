"""Writers for the tables that pass between the stages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logblocks.operators.ordering import number_rows
from logblocks.operators.parse import PARSED
from logblocks.sources import schemas


def write_table(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def write_parsed_csv(parsed: DataFrame, path: str) -> None:
    """Parsed rows in line order, one header per part file."""
    write_csv(parsed.orderBy("line_no").select(*PARSED), path)


def _published(df: DataFrame, schema: str, optional: tuple[str, ...] = ()) -> DataFrame:
    """The columns of a published schema, in its order and types."""
    fields = [part.split(" ", 1) for part in schema.split(", ")]
    return df.select(*[F.col(name).cast(kind) for name, kind in fields if name in df.columns or name not in optional])


def write_structured(parsed: DataFrame, assigned: DataFrame, path: str) -> None:
    """Parsed lines with the event and template that mining gave them."""
    found = assigned.select("line_no", "event_id", "template_at_line")
    write_table(_published(parsed.join(found, "line_no"), schemas.STRUCTURED), path)


def write_sequences(sequences: DataFrame, path: str, order: str = "label_row") -> None:
    """Sequences numbered in the given order, with labels and block ids where they have them."""
    numbered = number_rows(sequences, order, name="row_idx")
    write_table(_published(numbered, schemas.SEQUENCES, optional=("block_id", "label")), path)


def write_catalog(catalog: DataFrame, metadata: DataFrame, path: str) -> None:
    """Template catalog and its totals; the catalog is also the state to resume from."""
    write_table(catalog, f"{path}/templates")
    metadata.write.json(f"{path}/metadata")


def read_catalog(spark, path: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{path}/templates"), spark.read.json(f"{path}/metadata")


def write_block_index(index: DataFrame, path: str) -> None:
    write_csv(index.orderBy("Index"), path)


def write_vocabulary(vocab: DataFrame, path: str) -> None:
    """One JSON object of event -> index; the vocabulary has one row per template."""
    pairs = F.map_from_entries(F.array_sort(F.collect_list(F.struct("event", "idx"))))
    vocab.agg(F.to_json(pairs).alias("value")).coalesce(1).write.text(path)


def write_threshold(threshold: DataFrame, path: str) -> None:
    threshold.coalesce(1).write.option("ignoreNullFields", False).json(path)


def write_predictions(predictions: DataFrame, path: str, order: str = "row_idx") -> None:
    """Predictions in row order, under the block id's published name."""
    columns = ["prediction", "anomaly_score", "decision_threshold", "score_direction", "algorithm"]
    key = F.col("block_id").alias("BlockId") if "block_id" in predictions.columns else F.col("SequenceId")
    write_csv(predictions.orderBy(order).select(key, *columns), path)


def write_prompt(rows: DataFrame, path: str) -> None:
    """Prompt rows as text, in reading order over the part files."""
    rows.orderBy("section", "line_no").select(F.col("text").alias("value")).write.text(path)


def write_summary(summary: DataFrame, path: str) -> None:
    summary.coalesce(1).select(F.col("summary").alias("value")).write.mode("overwrite").text(path)
