"""Worst blocks, their log excerpts, and the incident prompt."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logblocks.functions.metrics import severity
from logblocks.operators.blocks import all_references
from logblocks.operators.ordering import number_rows, rank_within
from logblocks.operators.staging import broadcast_if_small, materialize
from logblocks.shipping import ship

# Spark prunes `row_number() <= n` before the shuffle up to this n.
GROUP_LIMIT = 1000

# The sentences of the prompt.
INSTRUCTION = (
    "Analyze the following anomalous Hadoop Distributed File System (HDFS) blocks "
    "and provide a concise incident-oriented summary for an on-call site reliability engineer. "
    "Highlight root causes, impacted components, and any remediation suggestions."
)
CLOSING = "Summarize the most critical issues, probable causes, and recommended next steps."
NO_LINES = "(No log lines found for this block)"
BULLET = "  • "


def rank_anomalies(flagged: DataFrame, top_n: int = 20, order: str = "row_idx") -> DataFrame:
    """Flagged rows by falling severity, ties in row order; ``top_n <= 0`` keeps all.

    Adds ``severity`` and the 1-based ``rank``.
    """
    rated = flagged.withColumn(
        "severity", severity(F.col("anomaly_score"), F.col("decision_threshold"), F.col("score_direction"))
    )
    keys = [F.col("severity").desc(), F.col(order).asc()]
    if top_n <= 0:
        return number_rows(rated, *keys, name="rank").withColumn("rank", F.col("rank") + 1)
    # the window numbers the top_n rows the limit left
    return rated.orderBy(*keys).limit(top_n).withColumn("rank", F.row_number().over(Window.orderBy(*keys)).cast("bigint"))


def block_excerpts(lines: DataFrame, blocks: DataFrame, max_lines: int = 0) -> DataFrame:
    """``(block_id, line_rank, line_no, line)``: first ``max_lines`` lines per wanted block.

    Whole raw lines count, malformed ones too, once per distinct block they
    name. ``max_lines <= 0`` keeps every line.
    """
    wanted = broadcast_if_small(materialize(blocks.select("block_id").distinct(), "wanted"))
    found = all_references(lines).select("block_id", "line_no", "line").join(wanted, "block_id", "left_semi")
    if 0 < max_lines <= GROUP_LIMIT:
        first = Window.partitionBy("block_id").orderBy("line_no")
        ranked = found.withColumn("line_rank", F.row_number().over(first)).where(F.col("line_rank") <= max_lines)
    else:
        ranked = rank_within(found, "block_id", "line_no", "line_rank")
        if max_lines > 0:
            ranked = ranked.where(F.col("line_rank") <= max_lines)
    return ranked.select("block_id", F.col("line_rank").cast("bigint").alias("line_rank"), "line_no", "line")


def prompt_lines(ranked: DataFrame, excerpts: DataFrame, system_prompt: str = "") -> DataFrame:
    """The prompt as rows ``(section, line_no, text)`` that read in that order.

    Section 0 is the head, section r the block of rank r, the last the closing.
    Stays distributed, so it holds every line of every block.
    """
    spark = ranked.sparkSession
    head = []
    if system_prompt:
        head += (system_prompt[:-1] if system_prompt.endswith("\n") else system_prompt).split("\n") + [""]
    head += [INSTRUCTION, ""]
    opening = spark.createDataFrame([(0, i - len(head), t) for i, t in enumerate(head)], "section long, line_no long, text string")
    sections = ranked.select(F.col("rank").alias("section"), "block_id")
    titles = sections.select(
        "section", F.lit(-1).cast("bigint").alias("line_no"), F.format_string("Block %d: %s", "section", "block_id").alias("text")
    )
    body = sections.join(excerpts, "block_id", "left").select(
        "section",
        F.coalesce("line_no", F.lit(0)).alias("line_no"),
        F.coalesce(F.concat(F.lit(BULLET), F.col("line")), F.lit(NO_LINES)).alias("text"),
    )
    last = F.lit(2**62)
    gaps = sections.select("section", last.alias("line_no"), F.lit("").alias("text"))
    closing = spark.createDataFrame([(2**62, 0, CLOSING)], "section long, line_no long, text string")
    return opening.unionByName(titles).unionByName(body).unionByName(gaps).unionByName(closing)


def prompt_text(rows: DataFrame) -> DataFrame:
    """One row ``(prompt)``, as one text; the rows themselves stay distributed in ``prompt_lines``."""
    parts = F.array_sort(F.collect_list(F.struct("section", "line_no", "text")))
    return rows.agg(F.concat(F.array_join(F.transform(parts, lambda p: p["text"]), "\n"), F.lit("\n")).alias("prompt"))


def incident_prompt(
    flagged: DataFrame, lines: DataFrame, top_n: int = 20, max_lines: int = 0, system_prompt: str = "", order: str = "row_idx"
) -> DataFrame:
    """Flagged rows and raw lines to prompt rows; raises when nothing is flagged."""
    ranked = materialize(rank_anomalies(flagged, top_n, order).select("rank", "block_id"), "ranked")
    if ranked.isEmpty():
        raise ValueError("no anomalies detected in predictions")
    return prompt_lines(ranked, block_excerpts(lines, ranked, max_lines), system_prompt)


class StaticClient:
    """Answers every prompt with the same text."""

    def __init__(self, response: str):
        self.response = response

    def summarize(self, prompt: str) -> str:
        return self.response


def summarize(prompts: DataFrame, client: Callable[[str], str] | StaticClient) -> DataFrame:
    """``(summary)`` per prompt row from any callable or ``summarize`` method, stripped."""
    ship(prompts.sparkSession)
    call = getattr(client, "summarize", client)

    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"summary": [call(p).strip() for p in batch["prompt"]]})

    return prompts.select("prompt").mapInPandas(answer, "summary string")
