"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The characters that separate words: space and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def whole(text: Column) -> Column:
    """A text, a null one as empty."""
    return F.coalesce(text, F.lit(""))


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id is fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(0))


def per_row(fn, *columns: str):
    """``mapInArrow`` body: ``fn`` maps the named columns of each batch to a dict of new arrays.

    The other columns of the batch are dropped unless ``fn`` returns them.
    """
    import pyarrow as pa

    def body(batches):
        for batch in batches:
            if batch.num_rows:
                found = fn(*(batch.column(c) for c in columns))
                yield pa.RecordBatch.from_pydict(found)

    return body


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A join on ``keys`` where null equals null; the left side's keys stay."""
    right = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys]
    return left.join(right, same, how).drop(*(f"_right_{k}" for k in keys))
