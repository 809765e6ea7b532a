"""The operators' queries over the given tables, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logblocks.llm import (
    bpe,
    conversations,
    decontamination,
    exact_dedup,
    language_id,
    licenses,
    mixing,
    negatives,
    preferences,
    repeats,
    simhash,
    toxicity,
    warc,
)
from logblocks.llm.common import table


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(table(spark, sf_dir, "documents"))


def op3_preference_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation against the same one with a worse last answer."""
    turns = table(spark, sf_dir, "conversations")
    pairs = preferences.format_pairs(turns, preferences.worse_answers(turns))
    return pairs.withColumns({c: preferences.spans_text(F.col(c)) for c in ("chosen_spans", "rejected_spans")})


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_dedup(table(spark, sf_dir, "documents"), shingle=4, radius=4)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"), least_bytes=0)


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document through the public 50k byte-level vocabulary and back."""
    import public_tokenizers

    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.damage_and_repair(table(spark, sf_dir, "conversations"))


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_exact_dedup,
        op2_language_id,
        op3_preference_formatting,
        op4_suffix_array_dedup,
        op5_source_mixing,
        op6_benchmark_decontamination,
        op7_simhash_near_dedup,
        op8_warc,
        op9_license_scan,
        op10_toxicity,
        op11_bpe,
        op12_hard_negatives,
        op13_conversation_repair,
    ]
    return {f.__name__: f for f in found}


def statements() -> dict[str, str]:
    return {
        "op1_exact_dedup": exact_dedup.SQL,
        "op3_preference_formatting": preferences.SQL,
        "op8_warc": warc.SQL,
        "op12_hard_negatives": negatives.SQL,
    }
