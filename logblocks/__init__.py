"""Log anomaly analytics as Spark DataFrame operators.

Raw log lines become a typed table, message templates, ordered per-block event
sequences, count vectors, calibrated anomaly flags, quality checks, a run
report and incident prompts. Every step takes and returns DataFrames.
"""
