"""Ordered event sequences per block, and their labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logblocks.functions.text import label_flag
from logblocks.operators.ordering import number_rows, rank_within
from logblocks.operators.staging import require_columns


def block_totals(rows: DataFrame) -> DataFrame:
    """``(block_id, n_events, first_line)``, pre-aggregated before the shuffle."""
    return rows.groupBy("block_id").agg(F.count("*").alias("n_events"), F.min("line_no").alias("first_line"))


def ordered_events(rows: DataFrame) -> DataFrame:
    """``(block_id, pos, line_no, event_id)``: every event with its 0-based place in its block.

    The base form of a sequence. It stays distributed however long a block is: positions come from
    line ranges and their offsets.
    """
    ranked = rank_within(rows.select("block_id", "line_no", "event_id"), "block_id", "line_no", "pos")
    return ranked.select("block_id", (F.col("pos") - 1).alias("pos"), "line_no", "event_id")


def block_sequences(rows: DataFrame) -> DataFrame:
    """``(block_id, first_line, n_events, events)``: one row per block, its events in line order.

    The published form. A row holds one block's whole list; where a block may not fit
    one row, read ``ordered_events`` instead.
    """
    return (
        rows.groupBy("block_id")
        .agg(F.array_sort(F.collect_list(F.struct("line_no", "event_id"))).alias("_e"))
        .select(
            "block_id",
            F.col("_e")[0]["line_no"].alias("first_line"),
            F.size("_e").cast("bigint").alias("n_events"),
            F.col("_e.event_id").alias("events"),
        )
    )


def sequence_events(sequences: DataFrame) -> DataFrame:
    """``(block_id, event_id)`` back out of the sequence table."""
    return sequences.select("block_id", F.explode("events").alias("event_id"))


def first_labels(labels: DataFrame) -> DataFrame:
    """``(block_id, label_row, label)``: the first label row of each block wins."""
    require_columns(labels, ["BlockId", "Label", "label_row"], "label table")
    return (
        labels.select(F.col("BlockId").cast("string").alias("block_id"), "Label", "label_row")
        .groupBy("block_id")
        .agg(F.min("label_row").alias("label_row"), F.min_by("Label", "label_row").alias("Label"))
        .select("block_id", "label_row", label_flag(F.col("Label")).alias("label"))
    )


def labelled_blocks(totals: DataFrame, labels: DataFrame) -> DataFrame:
    """Logged blocks that have a label; ``label_row`` is their order."""
    return first_labels(labels).join(totals, "block_id")


def labelled_sequences(sequences: DataFrame, labels: DataFrame) -> DataFrame:
    """Sequences of labelled blocks; ``label_row`` is their order."""
    return with_first_labels(sequences, first_labels(labels))


def with_first_labels(sequences: DataFrame, first: DataFrame) -> DataFrame:
    """As ``labelled_sequences`` with ``first_labels`` at hand; without an exchange if both are bucketed by block."""
    return sequences.join(first, "block_id")


def missing_blocks(totals: DataFrame, labels: DataFrame) -> DataFrame:
    """Label rows that matched nothing: absent blocks and repeated label rows.

    The anti join runs on the unique row number, so a block that fills the
    label table with repeats does not gather in one task.
    """
    used = labelled_blocks(totals, labels).select("label_row")
    return labels.join(used, "label_row", "left_anti").select(
        "label_row", F.col("BlockId").cast("string").alias("block_id")
    )


def unused_blocks(totals: DataFrame, labels: DataFrame) -> DataFrame:
    """Logged blocks without a label."""
    labelled = labels.select(F.col("BlockId").cast("string").alias("block_id")).distinct()
    return totals.join(labelled, "block_id", "left_anti")


def block_index(blocks: DataFrame, order: str) -> DataFrame:
    """``(Index, BlockId[, Label])``: a dense number per block in the given order."""
    numbered = number_rows(blocks, order, name="Index")
    columns = ["Index", F.col("block_id").alias("BlockId")]
    if "label" in blocks.columns:
        columns.append(F.col("label").alias("Label"))
    return numbered.select(*columns)
