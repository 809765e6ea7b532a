"""Stage tables of the log view, written once per session and data folder.

The reads after a stage share its written table, as the jobs of a deployment
would share it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logblocks.functions.text import first_block_id
from logblocks.operators import calibrate, features, parse, score, sequences, splits
from logblocks.operators.staging import hadoop_path, materialize, materialize_bucketed, materialize_counted, published
from logblocks.operators.templates import Templates, mine_templates
from logblocks.plans import detect, logview

_built: dict[tuple, object] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, build):
    """Built again when the events table has changed."""
    files, path = hadoop_path(spark, f"{sf_dir}/events.parquet")
    status, content = files.getFileStatus(path), files.getContentSummary(path)
    state = (status.getModificationTime(), content.getFileCount(), content.getLength())
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if _built.get(key, (None,))[0] != state:
        with published():
            _built[key] = (state, build())
    return _built[key][1]


def forget() -> None:
    """Drops the handles, so that the next read builds its stage again."""
    _built.clear()


def split_log(spark: SparkSession, sf_dir: str) -> parse.SplitLog:
    """The whole log, read once: parsed lines, rejected lines and their counts."""
    return _once(spark, sf_dir, "split-log", lambda: parse.split_lines(logview.log_lines(spark, sf_dir)))


def mine(spark: SparkSession, sf_dir: str) -> Templates:
    """Templates of the whole log, freshly mined; rows keep the block they first name."""
    log = logview.parsed(spark, sf_dir).withColumn("block_id", first_block_id(F.col("message")))
    return mine_templates(log, keep=("line_no", "block_id", "severity"), source=f"{sf_dir}/events.parquet")


def templates(spark: SparkSession, sf_dir: str) -> Templates:
    return _once(spark, sf_dir, "templates", lambda: mine(spark, sf_dir))


def rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(block_id, line_no, event_id, severity)`` of lines that name a block."""
    assigned = templates(spark, sf_dir).assigned
    return assigned.where(F.col("block_id").isNotNull()).select("block_id", "line_no", "event_id", "severity")


def warns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(spark, sf_dir, "warns", lambda: materialize(logview.block_warns(logview.parsed(spark, sf_dir)), "warns"))


def _labels(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, int]]:
    build = lambda: materialize_counted(logview.labels(warns(spark, sf_dir)), "labels", rows=F.count("*"))
    return _once(spark, sf_dir, "labels", build)


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labels(spark, sf_dir)[0]


def totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.block_totals(rows(spark, sf_dir))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled blocks of the log: block_id, label_row, label, n_events, first_line."""
    return _once(
        spark,
        sf_dir,
        "labelled",
        lambda: materialize_bucketed(sequences.labelled_blocks(totals(spark, sf_dir), labels(spark, sf_dir)), "labelled", "block_id"),
    )


def first_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per labelled block, in buckets of it."""
    build = lambda: materialize_bucketed(sequences.first_labels(labels(spark, sf_dir)), "block-labels", "block_id")
    return _once(spark, sf_dir, "first-labels", build)


def every_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per logged block with its events in order, in buckets of it."""
    build = lambda: materialize_bucketed(sequences.block_sequences(rows(spark, sf_dir)), "every-sequence", "block_id")
    return _once(spark, sf_dir, "every-sequence", build)


def _sequences(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, int]]:
    def build():
        found = sequences.with_first_labels(every_sequence(spark, sf_dir), first_labels(spark, sf_dir))
        return materialize_counted(found, "sequences", rows=F.count("*"), anomalies=F.sum("label"), events=F.sum("n_events"))

    return _once(spark, sf_dir, "sequences", build)


def sequence_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sequence artifact: labelled blocks with their events in order."""
    return _sequences(spark, sf_dir)[0]


def _vocabulary(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, int]]:
    build = lambda: materialize_counted(features.vocabulary(rows(spark, sf_dir)), "vocabulary", rows=F.count("*"))
    return _once(spark, sf_dir, "vocabulary", build)


def vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vocabulary(spark, sf_dir)[0]


def feature_count(spark: SparkSession, sf_dir: str) -> int:
    """The size of the vocabulary, as the job that wrote it counted."""
    return _vocabulary(spark, sf_dir)[1]["rows"]


def counters(spark: SparkSession, sf_dir: str) -> dict[str, int]:
    """What a run warns of or reports, counted by the jobs that write its tables; no table is read again for it."""
    log, (_, found) = split_log(spark, sf_dir), _sequences(spark, sf_dir)
    return {
        "messages": log.counts[parse.GOOD],
        "rejected": sum(n for verdict, n in log.counts.items() if verdict != parse.GOOD),
        "without_block": log.without_block,
        "missing_blocks": _labels(spark, sf_dir)[1]["rows"] - found["rows"],
        "blocks": found["rows"],
        "anomalies": found["anomalies"],
        "events": found["events"],
        "features": feature_count(spark, sf_dir),
    }


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count vectors of the labelled blocks, with label and split."""

    def build():
        counted = features.count_vectors(rows(spark, sf_dir), vocabulary(spark, sf_dir))
        parts = splits.stratified_split(labelled(spark, sf_dir), "block_id", "label", 0.3, 42)
        return materialize(counted.join(parts.select("block_id", "label", "is_test", "first_line"), "block_id"), "vectors")

    return _once(spark, sf_dir, "vectors", build)


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plain score of every labelled block: block_id, row_idx, anomaly_score, label."""

    def build():
        scored = logview.warn_scores(warns(spark, sf_dir))
        return materialize(scored.join(labelled(spark, sf_dir).select("block_id", "label"), "block_id"), "scores")

    return _once(spark, sf_dir, "scores", build)


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled blocks flagged at the calibrated threshold of the plain score."""
    def build():
        scored = scores(spark, sf_dir)
        flagged = score.apply_threshold(scored.drop("label"), calibrate.calibrate(scored))
        return materialize_bucketed(flagged, "predictions", "block_id")

    return _once(spark, sf_dir, "predictions", build)


def detector(spark: SparkSession, sf_dir: str) -> detect.Detector:
    """The calibrated isolation forest with its default settings."""
    build = lambda: detect.train(vectors(spark, sf_dir), feature_count(spark, sf_dir))
    return _once(spark, sf_dir, "detector", build)


def supervised_detector(spark: SparkSession, sf_dir: str) -> detect.Detector:
    """The calibrated random-forest baseline at its full size."""
    build = lambda: detect.train(
        vectors(spark, sf_dir), feature_count(spark, sf_dir), score.RANDOM_FOREST, allow_supervised=True
    )
    return _once(spark, sf_dir, "supervised-detector", build)
