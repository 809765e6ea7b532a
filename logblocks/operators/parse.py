"""Raw lines to the typed log table, with malformed lines set apart."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from logblocks.functions import logline, text
from logblocks.operators.staging import staging_path

PARSED = ("timestamp", "pid", "severity", "component", "message")
GOOD = "good"
REASONS = (logline.TOO_FEW_PARTS, logline.BAD_TIMESTAMP, logline.BAD_PID)


def _part(i: int):
    return F.get(F.col("_p"), F.lit(i))


def _fields(lines: DataFrame, line: str) -> DataFrame:
    # Each generator yields one row. Filters do not move below a generator, so
    # the split and the time stamp are computed once and not again per filter.
    parts = lines.select("*", F.explode(F.array(text.words(F.col(line)))).alias("_p"))
    typed = F.struct(
        logline.epoch_seconds(_part(0), _part(1)).alias("timestamp"),
        logline.process_id(_part(2)).alias("pid"),
    )
    return parts.select("*", F.inline(F.array(typed))).withColumn(
        "_reason",
        F.when(F.size("_p") < 5, logline.TOO_FEW_PARTS)
        .when(F.col("timestamp").isNull(), logline.BAD_TIMESTAMP)
        .when(F.col("pid").isNull(), logline.BAD_PID),
    )


def parse_lines(lines: DataFrame, line: str = "line", order: str = "line_no") -> DataFrame:
    """Well-formed lines as ``(line_no, timestamp, pid, severity, component, message)``."""
    good = _fields(lines, line).where(F.col("_reason").isNull())
    return good.select(
        order,
        "timestamp",
        "pid",
        logline.severity_name(_part(3)).alias("severity"),
        logline.component_name(_part(4)).alias("component"),
        logline.message_text(F.col("_p")).alias("message"),
    )


def rejected_lines(lines: DataFrame, line: str = "line", order: str = "line_no") -> DataFrame:
    """Malformed lines with the first rule they break; never a failed job."""
    bad = _fields(lines, line).where(F.col("_reason").isNotNull())
    return bad.select(order, F.col(line).alias("line"), F.col("_reason").alias("reason"))


def reject_counts(lines: DataFrame, line: str = "line", order: str = "line_no") -> DataFrame:
    return rejected_lines(lines, line, order).groupBy("reason").agg(F.count("*").alias("lines"))


@dataclass
class SplitLog:
    """One written pass over a log: ``good`` as ``parse_lines`` gives them, ``rejected`` with their reason, lines by verdict.

    ``without_block`` counts the good lines whose message names no block.
    """

    good: DataFrame
    rejected: DataFrame
    counts: dict[str, int]
    without_block: int


def split_lines(lines: DataFrame, line: str = "line", order: str = "line_no") -> SplitLog:
    """Parses every line once: good and rejected lines go to their own partition of one table and are counted on the way.

    The counts are observed by the job that writes; a read of either side touches its own files only.
    """
    spark = lines.sparkSession
    verdict = F.coalesce("_reason", F.lit(GOOD))
    fields = _fields(lines, line).select(
        order,
        "timestamp",
        "pid",
        logline.severity_name(_part(3)).alias("severity"),
        logline.component_name(_part(4)).alias("component"),
        F.when(F.col("_reason").isNull(), logline.message_text(F.col("_p"))).alias("message"),
        F.when(F.col("_reason").isNotNull(), F.col(line)).alias("line"),
        verdict.alias("verdict"),
    )
    seen, path = Observation(), staging_path(spark, "split-log")
    lost = F.sum((F.col("message").isNotNull() & text.first_block_id(F.col("message")).isNull()).cast("int")).alias("lost")
    counts = [F.sum((F.col("verdict") == name).cast("int")).alias(f"n{k}") for k, name in enumerate((GOOD, *REASONS))]
    # files keep the order of their lines, as the writer needs them by verdict
    fields.observe(seen, *counts, lost).sortWithinPartitions("verdict", order).write.partitionBy("verdict").parquet(path)
    table = spark.read.schema(fields.schema).parquet(path)
    found = {name: seen.get[f"n{k}"] or 0 for k, name in enumerate((GOOD, *REASONS))}
    good = table.where(F.col("verdict") == GOOD).select(order, *PARSED)
    rejected = table.where(F.col("verdict") != GOOD).select(order, "line", F.col("verdict").alias("reason"))
    return SplitLog(good, rejected, found, seen.get["lost"] or 0)
