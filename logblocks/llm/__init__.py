"""Operators of a training-data pipeline: dedup, language, toxicity, licenses, archives, mixing."""
