"""Ratios of detection counts, and the severity of a score."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(num: Column, den: Column) -> Column:
    """``num / den``; null when the denominator is not positive."""
    return F.when(den > 0, num / den)


def f_beta(precision: Column, recall: Column, beta: float) -> Column:
    square = float(beta) ** 2
    bottom = F.greatest(F.lit(square) * precision + recall, F.lit(1e-12))
    return F.lit(1 + square) * precision * recall / bottom


def flagged(score: Column, threshold: Column, direction: Column) -> Column:
    """1 at or above the threshold for ``higher``, strictly below it otherwise."""
    hit = F.when(direction == "higher", score >= threshold).otherwise(score < threshold)
    return F.when(hit, 1).otherwise(0).cast("int")


def class_flag(if_class: Column) -> Column:
    """1 for the forest's own anomaly class (-1), else 0."""
    return F.when(if_class == -1, 1).otherwise(0).cast("int")


def severity(score: Column, threshold: Column, direction: Column) -> Column:
    """Distance beyond the threshold on the anomalous side; 0 when both are 0."""
    distance = F.when(F.lower(direction) == "higher", score - threshold).otherwise(threshold - score)
    return F.when((threshold == 0) & (score == 0), F.lit(0.0)).otherwise(distance)


def rounded_ratio(num: int, den: int, digits: int = 4) -> float | None:
    """Report rounding of one ratio on its exact binary value, ties to even."""
    return round(num / den, digits) if den > 0 else None


def report_ratios(counts: dict[str, int]) -> dict[str, float | None]:
    """All ratios of the run report from a row of confusion counts; F1 is that of the rounded two."""
    hit, of = counts["true_positives"], lambda other: counts["true_positives"] + counts[other]
    shown = {"precision": rounded_ratio(hit, of("false_positives")), "recall": rounded_ratio(hit, of("false_negatives"))}
    if None in shown.values() or not any(shown.values()):
        return {**shown, "f1": None}
    return {**shown, "f1": round(2 * math.prod(shown.values()) / sum(shown.values()), 4)}
