"""From raw documents to a training mix: five stages, each written as Parquet and read by the next.

A stage that filters decides row by row, so null and repeated ids are no special case: of a group of copies
exactly one row stays, and only the rows that leak go. The stages on copies write the rows with a number
first. The list of numbers that go is broadcast only if it is short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logblocks.llm import decontamination, exact_dedup, language_id, mixing, simhash
from logblocks.llm.common import table
from logblocks.operators.staging import broadcast_if_small, materialize, staging_path

# A text goes if it is less than this share as near to its language as all but TYPICAL of that language's own texts.
FAR, TYPICAL = 0.5, 0.01
SHINGLE, RADIUS = 4, 4


def _free(docs: DataFrame, name: str) -> str:
    """``name``, longer if ``docs`` has a column of that name."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a unique number, written so that every read sees the same, and the number's name."""
    name = _free(docs, "row")
    return materialize(docs.withColumn(name, F.monotonically_increasing_id()), "pipeline-rows"), name


def _without(rows: DataFrame, gone: DataFrame, number: str) -> DataFrame:
    """Numbered ``rows`` without the numbers in ``gone``."""
    gone = broadcast_if_small(materialize(gone, "pipeline-gone"))
    return rows.join(gone, number, "left_anti").drop(number)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without letters go, and those far from every learned language.

    What is far is told by each language's own texts, all of them: half the score that 99 of 100 of them reach. Where nothing can be learned,
    all rows stay.
    """
    profiles = language_id.train(docs)
    if not profiles.names:
        return docs
    guess = _free(docs, "guess")
    judged = materialize(docs.withColumn(guess, language_id.predictor(profiles)(F.col("text"))), "pipeline-guesses")
    found, score = F.col(guess)["lang_pred"], F.col(guess)["score"]
    own = judged.where(F.col("lang") == found).groupBy(found.alias("l")).agg(F.percentile_approx(score, F.lit(TYPICAL)).alias("s"))
    cuts = {r["l"]: r["s"] * FAR for r in own.collect()}  # one row a language
    cut = F.lit(0.0)
    for name, value in cuts.items():
        cut = F.when(found == name, value).otherwise(cut)
    return judged.where((found != "und") & (score >= cut)).drop(guess)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, number = _numbered(docs)
    return _without(rows, exact_dedup.kept_rows(rows, number).where(~F.col("kept")).select(number), number)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component the row with the smallest id stays."""
    rows, number = _numbered(docs)
    return _without(rows, simhash.kept_rows(rows, number, SHINGLE, RADIUS).where(~F.col("kept")).select(number), number)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the mix takes of each document that is left."""
    return mixing.mix(docs)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("source_mixing", mix_sources),
]

# Rank-order profiles, SimHash and banded alignment are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = staging_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
