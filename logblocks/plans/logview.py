"""A block log, its labels and a plain score, rendered from the ``events`` table.

The driver's tables hold no block log, so every ``events`` row becomes one raw
line: six message kinds, three kinds of malformed line, lines that name two
blocks, one block twice, or none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logblocks.functions import text
from logblocks.operators.parse import parse_lines
from logblocks.operators.staging import spread

_LINES = """
with e as (select *, {stamp} as tsx,
   concat('blk_', case when user_id % 2 = 0 then '-' else '' end,
          cast(user_id*1000 + day(ts) % 10 as varchar(20))) as b,
   concat('blk_', cast(user_id*1000 + 999 as varchar(20))) as b2,
   concat('10.0.', cast(user_id % 250 as varchar(20)), '.', cast(event_id % 250 as varchar(20))) as ip
 from {events})
select event_id as line_no,
 case when event_id % 97 = 0 then concat(tsx,' 148 INFO')
      when event_id % 101 = 0 then concat(tsx,' not-a-pid INFO dfs.DataNode: message')
      when event_id % 103 = 0 then concat('080230 000000 ', cast(event_id as varchar(20)),' INFO dfs.DataNode: message')
      when event_id % 53 = 0 then concat(tsx,' ',cast(event_id % 3000 as varchar(20)),' INFO dfs.DataNode: Starting periodic heartbeat')
 else concat(tsx,' ',cast(event_id % 3000 as varchar(20)),' ',
   case event_type when 'error' then 'WARN' when 'signup' then 'ERROR' else 'INFO' end,' ',
   case event_type
    when 'click' then concat('dfs.DataNode$DataXceiver: Receiving block ',b,' src: /',ip,':50010 dest: /10.0.1.1:50010')
    when 'view' then concat('dfs.DataNode$PacketResponder: PacketResponder ',cast(event_id % 3 as varchar(20)),' for block ',b,' terminating')
    when 'purchase' then concat('dfs.FSNamesystem: BLOCK* NameSystem.addStoredBlock: blockMap updated: ',ip,':50010 is added to ',b,' size ',cast(cast(floor(value*100) as bigint) as varchar(20)))
    when 'signup' then concat('dfs.FSNamesystem: BLOCK* ask ',ip,':50010 to replicate ',b,' and ',b2,' and ',b)
    else concat('dfs.DataNode$DataXceiver: ',ip,':50010:Got exception while serving ',b,' to /10.0.1.1:') end) end as line
from e
"""


def lines_sql(stamp: str, events: str) -> str:
    """The rendering as SQL text, for either engine's time-stamp format call."""
    return _LINES.format(stamp=stamp, events=events)


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(line_no, line)``, one line per ``events`` row."""
    events = spread(spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id", "event_type", "value"))
    return spark.sql(lines_sql("date_format(ts,'yyMMdd HHmmss')", "{events}"), events=events)


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_lines(log_lines(spark, sf_dir))


def block_warns(parsed_lines: DataFrame) -> DataFrame:
    """Lines, warnings and first line of each block."""
    return (
        parsed_lines.withColumn("block_id", text.first_block_id("message"))
        .where(F.col("block_id").isNotNull())
        .groupBy("block_id")
        .agg(
            F.count("*").alias("lines"),
            F.sum((F.col("severity") == "WARN").cast("int")).alias("warns"),
            F.min("line_no").alias("first_line"),
        )
    )


def labels(blocks: DataFrame) -> DataFrame:
    """``(label_row, BlockId, Label)`` in a fixed row order.

    A block is an anomaly when more than half of its lines are warnings. Blocks
    of every tenth user have no label; the second row of each block whose first
    line is a multiple of 500 repeats its key, and ``blk_0`` is not in the log.
    """
    user = (F.abs(F.regexp_extract("block_id", "(-?[0-9]+)$", 1).cast("bigint")) / 1000).cast("bigint")
    label = F.when(F.col("warns") * 2 > F.col("lines"), " Anomaly").otherwise("Normal")
    known = blocks.where(user % 10 != 9).select(
        (F.col("first_line") * 2).alias("label_row"), F.col("block_id").alias("BlockId"), label.alias("Label")
    )
    again = known.where(F.col("label_row") % 1000 == 0).select(
        (F.col("label_row") + 1).alias("label_row"), "BlockId", F.lit("ANOMALY").alias("Label")
    )
    absent = known.agg((F.max("label_row") + 2).alias("label_row")).select(
        "label_row", F.lit("blk_0").alias("BlockId"), F.lit("Anomaly").alias("Label")
    )
    return known.unionByName(again).unionByName(absent)


def warn_scores(blocks: DataFrame) -> DataFrame:
    """``(block_id, row_idx, anomaly_score)`` with score ``1 - warns / lines``; low is bad."""
    return blocks.select(
        "block_id",
        F.col("first_line").alias("row_idx"),
        (1 - F.col("warns") / F.col("lines")).alias("anomaly_score"),
    )
