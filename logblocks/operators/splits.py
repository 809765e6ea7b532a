"""Stratified splits of exact size, and class ratios."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logblocks.operators.staging import materialize

MIN_CONTAMINATION = 1e-6


def contamination(labelled: DataFrame) -> DataFrame:
    """Share of anomalies, never below the smallest ratio a forest accepts."""
    ratio = F.coalesce(F.sum("label") / F.count("label"), F.lit(0.0))
    return labelled.agg(F.greatest(ratio, F.lit(MIN_CONTAMINATION)).alias("contamination"))


def _train_sizes(df: DataFrame, label: str, test_fraction: float) -> DataFrame:
    """Rows per class that stay in training: proportional, largest remainders first."""
    classes = df.groupBy(label).agg(F.count("*").alias("n_c"))
    every = Window.partitionBy()
    n = F.sum("n_c").over(every)
    sized = classes.withColumn("n", n).withColumn("n_train", F.col("n") - F.ceil(F.lit(test_fraction) * F.col("n")))
    share = sized.withColumns(
        {
            "base": F.floor((F.col("n_c") * F.col("n_train")).cast("decimal(38,0)") / F.col("n")).cast("bigint"),
            "rest": ((F.col("n_c") * F.col("n_train")) % F.col("n")),
        }
    )
    spare = F.col("n_train") - F.sum("base").over(every)
    turn = F.row_number().over(Window.orderBy(F.col("rest").desc(), F.col(label)))
    return share.select(label, (F.col("base") + F.when(turn <= spare, 1).otherwise(0)).alias("_train"))


def stratified_split(df: DataFrame, key: str, label: str, test_fraction: float, seed: int) -> DataFrame:
    """Adds ``is_test``; each class keeps its share of both sides, to the row.

    Rows are drawn in the order of a seeded hash of the key, so the split does
    not depend on the partitioning. A class that holds nearly all rows is
    ranked in 4,096 hash cells plus the cells' offsets, not in one task.
    """
    hashed = df.withColumn("_h", F.md5(F.concat(F.lit(f"{seed}:"), F.col(key)))).withColumn(
        "_cell", F.substring("_h", 1, 3)
    )
    before = Window.partitionBy(label).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = (
        hashed.groupBy(label, "_cell")
        .agg(F.count("*").alias("_n"))
        .select(label, "_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
        .join(F.broadcast(_train_sizes(df, label, test_fraction)), label)
    )
    inside = Window.partitionBy(label, "_cell").orderBy("_h", key)
    return (
        hashed.join(cells, [label, "_cell"])
        .withColumn("is_test", F.row_number().over(inside) + F.col("_offset") > F.col("_train"))
        .drop("_h", "_cell", "_offset", "_train")
    )


def calibration_split(train: DataFrame, key: str, label: str, fraction: float = 0.2, seed: int = 43) -> tuple[DataFrame, DataFrame]:
    """(fit rows, calibration rows); both are all rows when a class is too small to split."""
    counts = train.groupBy(label).agg(F.count("*").alias("n")).agg(F.count("*"), F.min("n")).first()
    if counts[0] < 2 or counts[1] < 2:
        return train, train
    split = materialize(stratified_split(train, key, label, fraction, seed), "split")
    return split.where(~F.col("is_test")).drop("is_test"), split.where("is_test").drop("is_test")
