"""Which lines belong to which block."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logblocks.functions import text


def first_references(lines: DataFrame, message: str = "message") -> DataFrame:
    """Each line under the first block its message names; lines that name none go."""
    return lines.withColumn("block_id", text.first_block_id(F.col(message))).where(F.col("block_id").isNotNull())


def all_references(lines: DataFrame, line: str = "line") -> DataFrame:
    """One row per line and distinct block in the whole raw line."""
    return lines.select("*", F.explode(text.all_block_ids(F.col(line))).alias("block_id"))


def skipped_messages(lines: DataFrame, message: str = "message") -> DataFrame:
    """How many messages name no block, out of how many."""
    none = text.first_block_id(F.col(message)).isNull()
    return lines.agg(
        F.count("*").alias("messages"),
        F.coalesce(F.sum(none.cast("bigint")), F.lit(0)).alias("without_block"),
    )
