"""Raw text files as lines with dense numbers in file order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logblocks.operators.staging import broadcast_if_small, materialize

SPLIT_ROWS = 4_000_000


def number_file_rows(rows: DataFrame, name: str = "line_no") -> DataFrame:
    """Adds a dense 0-based number over all files of a file-based table, in path and file order.

    Rows of one file split are read in order by one task, so a row's place in
    its split is its task-local id less the split's smallest. The split table,
    one small row per split, holds the counts of the splits before. A row that
    does not fit its split's recorded range fails the job instead of getting a
    wrong number; where executors come and go between the two reads, fix
    ``spark.sql.files.minPartitionNum`` for the session.
    """
    placed = rows.select(
        "*",
        F.xxhash64("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_id"),
    )
    splits = rows.select(
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_id"),
    ).groupBy("_path", "_start").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    before = Window.orderBy("_path", "_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialize(
        splits.select(
            F.xxhash64("_path").alias("_file"), "_start", "_first", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
        ),
        "splits",
    )
    at = F.col("_id") - F.col("_first")
    number = F.when((at >= 0) & (at < F.col("_n")), F.col("_offset") + at).otherwise(
        F.raise_error(F.lit("file splits changed between two reads; fix spark.sql.files.minPartitionNum")).cast("bigint")
    )
    return (
        placed.join(broadcast_if_small(offsets, SPLIT_ROWS), ["_file", "_start"], "left")
        .withColumn(name, number)
        .drop("_file", "_start", "_id", "_first", "_n", "_offset")
    )


def read_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """``(line_no, line)``. Only a newline ends a line; one carriage return before it goes."""
    raw = spark.read.option("lineSep", "\n").text(list(paths))
    line = F.regexp_replace("value", "\\r\\z", "")
    plain = F.when(F.col("value").endswith("\r"), line).otherwise(F.col("value"))
    return number_file_rows(raw).select("line_no", plain.alias("line"))
