"""Times the headline queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``; prints one JSON line.

Two queries run once untimed first, to start the Python workers and warm the
compiled code. Queries from the raw table are timed with no stage present, so a time covers their whole
work. Then each shared stage is built and timed by itself (``stage_*``), and the queries that read
stages are timed on the written tables: a query's cold time is its own plus that of its stages.
"""

from __future__ import annotations

import json
import os
import time

from logblocks.operators.staging import clear
from logblocks.plans import queries as registry
from logblocks.plans import stages
from logblocks.session import local_session

# built from the raw table each time
FROM_RAW = (
    "raw_line_scan",
    "parse_log_lines",
    "rejected_lines_by_reason",
    "block_first_reference",
    "block_all_references",
    "template_assignment",
    "template_resume",
)

# in the order in which they build on each other
STAGES = ("templates", "labels", "labelled", "sequence_table", "vocabulary", "vectors", "predictions", "detector", "supervised_detector")

# read the stage tables of the run
ON_STAGES = (
    "block_sequences",
    "labelled_sequences",
    "missing_labelled_blocks",
    "event_counts_long",
    "event_count_vectors",
    "stratified_split",
    "calibrate_threshold",
    "confusion_metrics",
    "classification_report",
    "rank_every_anomaly",
    "block_excerpts",
    "incident_prompt",
    "guardrail_vocabulary",
    "run_summary",
    "failed_run",
    "ordered_events",
    "iforest_scores",
    "forest_round_trip",
    "rforest_round_trip",
    "grid_search_best",
    "detected_incidents",
)


def seconds(spark, sf_dir: str, name: str) -> float:
    start = time.perf_counter()
    registry.registered()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    for name in ("raw_line_scan", "template_assignment"):
        seconds(spark, sf_dir, name)
    times = {}
    for name in FROM_RAW:
        stages.forget()
        times[name] = seconds(spark, sf_dir, name)
    for name in STAGES:
        start = time.perf_counter()
        getattr(stages, name)(spark, sf_dir)
        times[f"stage_{name}"] = round(time.perf_counter() - start, 3)
    for name in ON_STAGES:
        times[name] = seconds(spark, sf_dir, name)
    clear(spark)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
