"""Numbering and running sums in a total order, without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logblocks.operators.staging import broadcast_if_small, fits, materialize

ORDER_BUCKETS = 512
SMALL_ROWS = 50_000
LINE_BUCKET = 1_000_000


def number_rows(df: DataFrame, *order, name: str = "row_idx") -> DataFrame:
    """Adds a dense 0-based number in the given order.

    Rows are range-partitioned on the whole sort key, so a key that many rows
    share is still split by the columns after it. The partition tag is written
    out before it is used twice; only one small row per partition is summed.
    """
    tagged = materialize(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumns({"_part": F.spark_partition_id(), "_mid": F.monotonically_increasing_id()}),
        "numbered",
    )
    parts = tagged.groupBy("_part").agg(F.min("_mid").alias("_first"), F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return (
        tagged.join(broadcast_if_small(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_mid") - F.col("_first"))
        .drop("_part", "_mid", "_first", "_offset")
    )


def running_sums(
    df: DataFrame, order: str, sums: dict[str, str], ascending: bool = True, buckets: int = ORDER_BUCKETS, small: int = SMALL_ROWS
) -> DataFrame:
    """Adds inclusive running sums of ``sums`` (new name -> column) in the order of a unique number.

    Up to ``small`` rows, counted first, are summed in one window. Beyond, the
    order column is cut at approximate quantiles. Each bucket sums up its own
    rows; the buckets' totals, at most ``buckets`` rows, give the offsets. The
    cuts only balance the work: any cuts give the same sums.
    """
    if fits(df, small):
        upto = Window.orderBy(F.col(order).asc() if ascending else F.col(order).desc()).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumns({new: F.sum(c).over(upto) for new, c in sums.items()})
    shares = ", ".join(f"{i / buckets}D" for i in range(1, buckets))
    cuts = df.agg(F.expr(f"percentile_approx(`{order}`, array({shares}), 10000)").alias("_cuts"))
    bucket = F.size(F.filter("_cuts", lambda cut: cut < F.col(order)))
    placed = df.crossJoin(F.broadcast(cuts)).withColumn("_bucket", bucket).drop("_cuts")
    direction = (lambda c: F.col(c).asc()) if ascending else (lambda c: F.col(c).desc())
    before = Window.orderBy(direction("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("_bucket").agg(*[F.sum(c).alias(f"_t_{c}") for c in sums.values()])
    offsets = totals.select(
        "_bucket", *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_o_{c}") for c in sums.values()]
    )
    inside = Window.partitionBy("_bucket").orderBy(direction(order)).rowsBetween(Window.unboundedPreceding, 0)
    return (
        placed.join(F.broadcast(offsets), "_bucket")
        .withColumns({new: F.sum(c).over(inside) + F.col(f"_o_{c}") for new, c in sums.items()})
        .drop("_bucket", *[f"_o_{c}" for c in sums.values()])
    )


def rank_within(df: DataFrame, key: str, line: str, name: str, width: int = LINE_BUCKET) -> DataFrame:
    """Adds the 1-based rank of each row within ``key`` by ``line``, for keys of any size.

    Rows are ranked inside (key, line range) cells, which hold at most
    ``width`` lines; the cells before them in the same key add the offset.
    """
    celled = df.withColumn("_cell", F.floor(F.col(line) / width))
    before = Window.partitionBy(key).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        celled.groupBy(key, "_cell")
        .agg(F.count("*").alias("_n"))
        .select(key, "_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy(key, "_cell").orderBy(line)
    return (
        celled.join(offsets, [key, "_cell"])
        .withColumn(name, F.row_number().over(inside) + F.col("_offset"))
        .drop("_cell", "_offset")
    )
