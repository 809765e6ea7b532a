"""Event vocabulary and event-count vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logblocks.operators.staging import broadcast_if_small


def vocabulary(rows: DataFrame) -> DataFrame:
    """``(event, idx)``: distinct events, numbered from 0 in text order.

    The window sees one row per template, never the log.
    """
    distinct = rows.select(F.col("event_id").alias("event")).distinct()
    return distinct.select("event", (F.row_number().over(Window.orderBy("event")) - 1).alias("idx"))


def check_vocabulary_index(vocab: DataFrame) -> DataFrame:
    """Raises unless the indices run from 0 without gaps or repeats."""
    low, high, rows, distinct = vocab.agg(
        F.min("idx"), F.max("idx"), F.count("*"), F.count_distinct("idx")
    ).first()
    if rows and (low != 0 or high != rows - 1 or distinct != rows):
        raise ValueError("vocabulary indices must run from 0 without gaps")
    return vocab


def event_counts(rows: DataFrame) -> DataFrame:
    """``(block_id, event_id, cnt)``; counted on the map side first."""
    return rows.groupBy("block_id", "event_id").agg(F.count("*").alias("cnt"))


def known_event_counts(rows: DataFrame, vocab: DataFrame) -> DataFrame:
    """``(block_id, idx, cnt)``: events outside the vocabulary are dropped."""
    return (
        event_counts(rows)
        .join(broadcast_if_small(vocab), F.col("event_id") == F.col("event"))
        .select("block_id", "idx", "cnt")
    )


def unseen_events(rows: DataFrame, vocab: DataFrame) -> DataFrame:
    """Distinct events that the vocabulary lacks."""
    return rows.select("event_id").distinct().join(vocab, F.col("event_id") == F.col("event"), "left_anti")


def count_vectors(rows: DataFrame, vocab: DataFrame) -> DataFrame:
    """``(block_id, idxs, cnts)``: sparse counts in index order, one row per block.

    A block whose events are all unknown keeps a row with empty arrays.
    """
    entry = F.when(F.col("idx").isNotNull(), F.struct("idx", "cnt"))
    return (
        event_counts(rows)
        .join(broadcast_if_small(vocab), F.col("event_id") == F.col("event"), "left")
        .groupBy("block_id")
        .agg(F.array_sort(F.collect_list(entry)).alias("_v"))
        .select("block_id", F.col("_v.idx").alias("idxs"), F.col("_v.cnt").alias("cnts"))
    )


def shape(vectors: DataFrame, vocab: DataFrame) -> DataFrame:
    """Blocks and features of the count matrix."""
    return vectors.agg(F.count("*").alias("blocks")).crossJoin(vocab.agg(F.count("*").alias("features")))
