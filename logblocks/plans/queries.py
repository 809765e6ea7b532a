"""Registered queries: every operator over the whole log of the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logblocks.functions.metrics import class_flag
from logblocks.functions.text import label_flag
from logblocks.operators import (
    blocks,
    calibrate,
    estimator,
    evaluate,
    features,
    guardrails,
    incidents,
    parse,
    report,
    score,
    sequences,
    splits,
    supervised,
    templates,
    tuning,
)
from logblocks.operators.iforest import ForestModel
from logblocks.operators.staging import require_columns, staging_path
from logblocks.plans import detect, logview, stages
from logblocks.sources import lines as line_source
from logblocks.sources import sinks, tables

Query = Callable[[SparkSession, str], DataFrame]

_queries: dict[str, Query] = {}

SYSTEM_PROMPT = "You are an on-call assistant."


def query(fn: Query) -> Query:
    _queries[fn.__name__] = fn
    return fn


def registered() -> dict[str, Query]:
    return dict(_queries)


def joined(column: str):
    return F.array_join(F.col(column).cast("array<string>"), " ").alias(column)


def rounded(column: str):
    """Forest scores are sums and powers, whose last bits differ between engines."""
    return F.round(column, 9).alias(column)


# sources and sinks


@query
def raw_line_scan(spark, sf_dir):
    path = staging_path(spark, "raw")
    log = logview.log_lines(spark, sf_dir)
    log.orderBy("line_no").select(F.col("line").alias("value")).write.text(path)
    return line_source.read_lines(spark, path)


@query
def parsed_csv_scan(spark, sf_dir):
    path = staging_path(spark, "parsed-csv")
    sinks.write_parsed_csv(logview.parsed(spark, sf_dir), path)
    table = tables.read_parsed(spark, path, csv=True)
    return table.select("line_no", "timestamp", "pid", "severity", "component", F.coalesce("message", F.lit("")).alias("message"))


@query
def label_scan(spark, sf_dir):
    path = staging_path(spark, "labels-csv")
    sinks.write_csv(stages.labels(spark, sf_dir).orderBy("label_row").select("BlockId", "Label"), path)
    return tables.read_labels(spark, path).select("label_row", "BlockId", label_flag(F.col("Label")).alias("label"))


@query
def flagged_prediction_scan(spark, sf_dir):
    path = staging_path(spark, "predictions-csv")
    sinks.write_predictions(stages.predictions(spark, sf_dir), path)
    return tables.read_anomalies(spark, path).select("block_id", "prediction", "anomaly_score", "decision_threshold", "score_direction")


@query
def vocabulary_scan(spark, sf_dir):
    path = staging_path(spark, "vocabulary-json")
    sinks.write_vocabulary(stages.vocabulary(spark, sf_dir), path)
    return tables.read_vocabulary(spark, path)


@query
def threshold_scan(spark, sf_dir):
    path = staging_path(spark, "threshold-json")
    sinks.write_threshold(calibrate.calibrate(stages.scores(spark, sf_dir)), path)
    return _flat_threshold(tables.read_threshold(spark, path))


@query
def structured_scan(spark, sf_dir):
    path = staging_path(spark, "structured")
    sinks.write_structured(logview.parsed(spark, sf_dir), stages.templates(spark, sf_dir).assigned, path)
    return tables.read_structured(spark, path)


@query
def sequence_scan(spark, sf_dir):
    path = staging_path(spark, "sequence-file")
    sinks.write_sequences(stages.sequence_table(spark, sf_dir), path)
    table = tables.read_sequences(spark, path, labels_required=True)
    return table.select("row_idx", "block_id", joined("events"), "label")


@query
def sequence_id_scan(spark, sf_dir):
    """Sequences written without block ids: rows are named by their number."""
    path = staging_path(spark, "sequence-file")
    sinks.write_sequences(stages.sequence_table(spark, sf_dir).drop("block_id", "label"), path)
    return tables.with_sequence_ids(tables.read_sequences(spark, path)).select("SequenceId", joined("events"))


@query
def block_index_scan(spark, sf_dir):
    path = staging_path(spark, "index-csv")
    labelled = stages.labelled(spark, sf_dir)
    sinks.write_block_index(sequences.block_index(labelled, "label_row"), path)
    index = tables.read_block_index(spark, path, labelled.count())
    return index.select(F.col("Index").cast("bigint").alias("Index"), "BlockId", F.col("Label").cast("int").alias("Label"))


@query
def prediction_scan(spark, sf_dir):
    path = staging_path(spark, "predictions-csv")
    sinks.write_predictions(stages.predictions(spark, sf_dir), path)
    return tables.read_predictions(spark, path)


@query
def catalog_metadata_scan(spark, sf_dir):
    path = staging_path(spark, "catalog")
    mined = stages.templates(spark, sf_dir)
    sinks.write_catalog(mined.catalog, mined.metadata, path)
    _, metadata = sinks.read_catalog(spark, path)
    named = F.element_at(F.split("source", "/"), -1).alias("source")
    return metadata.select(named, "total_lines", "total_templates", F.col("generated_at").isNotNull().alias("dated"))


# parsing


@query
def parse_log_lines(spark, sf_dir):
    """With the next two: one scan of the log writes what all three read."""
    return stages.split_log(spark, sf_dir).good


@query
def rejected_lines(spark, sf_dir):
    return stages.split_log(spark, sf_dir).rejected


@query
def rejected_lines_by_reason(spark, sf_dir):
    """Observed while the lines were written."""
    counts = stages.split_log(spark, sf_dir).counts
    rows = [(reason, n) for reason, n in counts.items() if n and reason != parse.GOOD]
    return spark.createDataFrame(rows, "reason string, lines long")


@query
def block_first_reference(spark, sf_dir):
    return blocks.first_references(logview.parsed(spark, sf_dir)).select("line_no", "block_id")


@query
def block_all_references(spark, sf_dir):
    return blocks.all_references(logview.log_lines(spark, sf_dir)).select("line_no", "block_id")


@query
def messages_without_block(spark, sf_dir):
    return blocks.skipped_messages(logview.parsed(spark, sf_dir))


# templates


@query
def template_assignment(spark, sf_dir):
    mined = stages.mine(spark, sf_dir)
    return templates.with_final_template(mined.assigned, mined.catalog).select(
        "line_no", "event_id", "template_at_line", "template_final"
    )


@query
def template_catalog(spark, sf_dir):
    catalog = stages.templates(spark, sf_dir).catalog
    return catalog.select("event_id", "cluster_id", "size", "template", joined("log_template_tokens"))


@query
def template_metadata(spark, sf_dir):
    return stages.templates(spark, sf_dir).metadata.select("total_lines", "total_templates")


@query
def template_resume(spark, sf_dir):
    """The log in two runs, cut at the median time; the second one starts from the first one's written catalog."""
    log = stages.split_log(spark, sf_dir).good
    cut = F.lit(log.agg(F.percentile_approx("timestamp", 0.5)).first()[0])
    first = templates.mine_templates(log.where(F.col("timestamp") < cut))
    path = staging_path(spark, "catalog")
    sinks.write_catalog(first.catalog, first.metadata, path)
    prior, _ = sinks.read_catalog(spark, path)
    second = templates.mine_templates(log.where(F.col("timestamp") >= cut), prior=prior)
    return first.assigned.unionByName(second.assigned).select("line_no", "event_id")


# sequences and labels


@query
def block_sequences(spark, sf_dir):
    built = sequences.block_sequences(stages.rows(spark, sf_dir))
    return built.select("block_id", "first_line", "n_events", joined("events"))


@query
def ordered_events(spark, sf_dir):
    return sequences.ordered_events(stages.rows(spark, sf_dir))


@query
def labelled_sequences(spark, sf_dir):
    found = sequences.with_first_labels(stages.every_sequence(spark, sf_dir), stages.first_labels(spark, sf_dir))
    return found.select("label_row", "block_id", joined("events"), "label")


@query
def missing_labelled_blocks(spark, sf_dir):
    return sequences.missing_blocks(stages.totals(spark, sf_dir), stages.labels(spark, sf_dir))


@query
def unused_blocks(spark, sf_dir):
    return sequences.unused_blocks(stages.totals(spark, sf_dir), stages.labels(spark, sf_dir))


@query
def block_index(spark, sf_dir):
    return sequences.block_index(stages.labelled(spark, sf_dir), "label_row")


@query
def unlabelled_block_index(spark, sf_dir):
    return sequences.block_index(stages.totals(spark, sf_dir), "first_line")


# features


@query
def event_vocabulary(spark, sf_dir):
    return features.vocabulary(stages.rows(spark, sf_dir))


@query
def train_vocabulary(spark, sf_dir):
    train = stages.vectors(spark, sf_dir).where(~F.col("is_test")).select("block_id")
    return features.vocabulary(stages.rows(spark, sf_dir).join(train, "block_id", "left_semi"))


@query
def event_counts_long(spark, sf_dir):
    return features.known_event_counts(stages.rows(spark, sf_dir), stages.vocabulary(spark, sf_dir))


@query
def event_count_vectors(spark, sf_dir):
    built = features.count_vectors(stages.rows(spark, sf_dir), stages.vocabulary(spark, sf_dir))
    return built.select("block_id", joined("idxs"), joined("cnts"))


@query
def unseen_events(spark, sf_dir):
    """Events outside the vocabulary of the INFO lines."""
    rows = stages.rows(spark, sf_dir)
    return features.unseen_events(rows, features.vocabulary(rows.where(F.col("severity") == "INFO")))


@query
def matrix_shape(spark, sf_dir):
    vocab = stages.vocabulary(spark, sf_dir)
    return features.shape(features.count_vectors(stages.rows(spark, sf_dir), vocab), vocab)


@query
def run_counters(spark, sf_dir):
    """Warnings and sizes of a run, as the jobs that write its tables count them on the way."""
    found = stages.counters(spark, sf_dir)
    return spark.createDataFrame([tuple(found.values())], ", ".join(f"{name} long" for name in found))


@query
def label_stats(spark, sf_dir):
    return evaluate.label_stats(stages.labelled(spark, sf_dir))


@query
def contamination(spark, sf_dir):
    return splits.contamination(stages.labelled(spark, sf_dir))


@query
def stratified_split(spark, sf_dir):
    split = splits.stratified_split(stages.labelled(spark, sf_dir), "block_id", "label", 0.3, 42)
    return split.select("block_id", "label", "is_test")


@query
def calibration_split(spark, sf_dir):
    split = splits.stratified_split(stages.labelled(spark, sf_dir), "block_id", "label", 0.3, 42)
    fit, held = splits.calibration_split(split.where(~F.col("is_test")), "block_id", "label")
    part = lambda df, name: df.select("block_id", F.lit(name).alias("part"))
    return part(fit, "fit").unionByName(part(held, "calibration"))


# thresholds and evaluation


def _flat_threshold(threshold: DataFrame) -> DataFrame:
    metrics = [F.col(f"calibration_metrics.{m}").alias(m) for m in ("precision", "recall", "f1", "f_beta")]
    return threshold.select(
        "algorithm", "score_threshold", "score_direction", *metrics, "calibration_size", "calibration_beta", "min_calibration_precision"
    )


@query
def threshold_curve(spark, sf_dir):
    return calibrate.threshold_curve(stages.scores(spark, sf_dir), "anomaly_score", "label")


@query
def calibrate_threshold(spark, sf_dir):
    return _flat_threshold(calibrate.calibrate(stages.scores(spark, sf_dir)))


@query
def calibrate_threshold_higher(spark, sf_dir):
    turned = stages.scores(spark, sf_dir).withColumn("anomaly_score", 1 - F.col("anomaly_score"))
    return _flat_threshold(
        calibrate.calibrate(turned, lower_is_anomalous=False, beta=1.0, min_precision=None, algorithm=score.RANDOM_FOREST)
    )


@query
def apply_threshold(spark, sf_dir):
    scored = stages.scores(spark, sf_dir)
    flagged = score.apply_threshold(scored, calibrate.calibrate(scored))
    return flagged.select("block_id", "prediction", "anomaly_score", "decision_threshold", "score_direction", "algorithm")


@query
def default_threshold(spark, sf_dir):
    flagged = score.apply_default(stages.scores(spark, sf_dir), score.RANDOM_FOREST)
    return flagged.select("block_id", "prediction", "decision_threshold", "score_direction", "algorithm")


@query
def default_cut_forest(spark, sf_dir):
    """The forest's own cut at 0, on the plain score moved so that it crosses 0."""
    centred = stages.scores(spark, sf_dir).withColumn("anomaly_score", F.col("anomaly_score") - 0.5)
    flagged = score.apply_default(centred)
    return flagged.select("block_id", "prediction", "anomaly_score", "decision_threshold", "score_direction", "algorithm")


@query
def confusion_metrics(spark, sf_dir):
    return evaluate.confusion(evaluate.with_labels(stages.predictions(spark, sf_dir), stages.labelled(spark, sf_dir)))


@query
def classification_report(spark, sf_dir):
    pairs = evaluate.with_labels(stages.predictions(spark, sf_dir), stages.labelled(spark, sf_dir))
    return evaluate.classification_report(pairs)


@query
def prediction_stats(spark, sf_dir):
    return evaluate.prediction_stats(stages.predictions(spark, sf_dir))


@query
def top_k_anomalies(spark, sf_dir):
    found = stages.predictions(spark, sf_dir)
    top = evaluate.top_anomalies(found, 5, evaluate.score_direction(found))
    return top.select("block_id", "anomaly_score", "prediction")


# incidents


def _flagged(spark, sf_dir):
    return stages.predictions(spark, sf_dir).where(F.col("prediction") == 1)


@query
def rank_by_severity(spark, sf_dir):
    return incidents.rank_anomalies(_flagged(spark, sf_dir), 20).select("rank", "block_id", "severity")


@query
def rank_every_anomaly(spark, sf_dir):
    return incidents.rank_anomalies(_flagged(spark, sf_dir), 0).select("rank", "block_id", "severity")


@query
def block_excerpts(spark, sf_dir):
    top = incidents.rank_anomalies(_flagged(spark, sf_dir), 20)
    return incidents.block_excerpts(logview.log_lines(spark, sf_dir), top, 5)


@query
def block_excerpts_unlimited(spark, sf_dir):
    return incidents.block_excerpts(logview.log_lines(spark, sf_dir), _flagged(spark, sf_dir))


def _prompt_rows(spark, sf_dir):
    return incidents.incident_prompt(_flagged(spark, sf_dir), logview.log_lines(spark, sf_dir), 20, 5, SYSTEM_PROMPT)


@query
def incident_prompt_rows(spark, sf_dir):
    return _prompt_rows(spark, sf_dir).where(F.col("section").between(1, 20)).select("section", "line_no", "text")


@query
def incident_prompt(spark, sf_dir):
    return incidents.prompt_text(_prompt_rows(spark, sf_dir))


@query
def summarize_static(spark, sf_dir):
    prompt = incidents.prompt_text(_prompt_rows(spark, sf_dir))
    return incidents.summarize(prompt, lambda text: f" {text.count(chr(10))} lines ")


@query
def prompt_file_scan(spark, sf_dir):
    """The prompt's lines as its text file holds them."""
    path = staging_path(spark, "prompt-text")
    sinks.write_prompt(_prompt_rows(spark, sf_dir), path)
    return line_source.read_lines(spark, path)


@query
def summary_file_scan(spark, sf_dir):
    path = staging_path(spark, "summary-text")
    prompt = incidents.prompt_text(_prompt_rows(spark, sf_dir))
    sinks.write_summary(incidents.summarize(prompt, lambda text: f" {text.count(chr(10))} lines "), path)
    return line_source.read_lines(spark, path)


# guardrails and report


def _check(checks: DataFrame) -> DataFrame:
    return checks.select("name", "status", F.array_join("issues", "; ").alias("issues"), "details")


@query
def guardrail_sequences(spark, sf_dir):
    return _check(guardrails.check_sequences(stages.sequence_table(spark, sf_dir)))


@query
def guardrail_index(spark, sf_dir):
    """The index of the labelled blocks against all logged blocks: the row counts differ."""
    index = sequences.block_index(stages.labelled(spark, sf_dir), "label_row")
    expected = stages.totals(spark, sf_dir).agg(F.count("*").alias("expected_rows"))
    return _check(guardrails.check_block_index(index, expected, "index"))


def _info_vocabulary(spark, sf_dir):
    return features.vocabulary(stages.rows(spark, sf_dir).where(F.col("severity") == "INFO"))


@query
def guardrail_vocabulary(spark, sf_dir):
    """All events against the vocabulary of the INFO lines: both rules fail."""
    return _check(guardrails.check_vocabulary(stages.rows(spark, sf_dir), _info_vocabulary(spark, sf_dir)))


@query
def observed_events(spark, sf_dir):
    return sequences.sequence_events(stages.sequence_table(spark, sf_dir)).agg(F.count_distinct("event_id").alias("observed_events"))


@query
def run_counts(spark, sf_dir):
    return report.run_counts(stages.labelled(spark, sf_dir), stages.predictions(spark, sf_dir))


def _run(spark, sf_dir, vocab) -> tuple[DataFrame, DataFrame, str | None]:
    """(summary, history) of a run, written and read back, and the failure that the writer raised."""
    labelled = stages.labelled(spark, sf_dir)
    table = stages.sequence_table(spark, sf_dir)
    index = sequences.block_index(labelled, "label_row")
    checks = guardrails.run_guardrails(table, sequences.sequence_events(table), vocab, index, index_path="index")
    artifacts = {"sequences": "sequences", "predictions": "predictions", "vocabulary": "vocabulary"}
    made = report.run_summary(spark, labelled, stages.predictions(spark, sf_dir), checks, artifacts)
    base, raised = staging_path(spark, "run"), None
    try:
        report.write_run(*made, f"{base}/summary", f"{base}/history", run_id="run")
    except guardrails.GuardrailError as failure:
        raised = str(failure)
    return *tables.read_run(spark, f"{base}/summary", f"{base}/history"), raised


@query
def run_summary(spark, sf_dir):
    summary, _, _ = _run(spark, sf_dir, stages.vocabulary(spark, sf_dir))
    rails = {
        "npz_schema": ("num_sequences", "has_labels"),
        "block_index": ("path", "rows"),
        "vocabulary": ("vocab_size", "observed_event_count", "drift", "unknown_event_count"),
    }
    return summary.select(
        "sequence_stats.*",
        *[f"prediction_stats.{c}" for c in ("total_predictions", "anomalies_flagged", "score_direction")],
        F.col("prediction_stats.top_anomalies")[0]["block_id"].alias("top_block"),
        "evaluation.*",
        *[F.col(f"guardrails.{check}.status").alias(check) for check in rails],
        *[f"guardrails.{check}.{fact}" for check, facts in rails.items() for fact in facts],
    )


@query
def failed_run(spark, sf_dir):
    """A run against the vocabulary of the INFO lines: written in full, then raised."""
    summary, history, raised = _run(spark, sf_dir, _info_vocabulary(spark, sf_dir))
    shown = summary.select("guardrails.status", "guardrails.error", F.lit(raised).alias("raised"))
    return shown.crossJoin(history.select("guardrails_status"))  # one row each


@query
def metrics_history_row(spark, sf_dir):
    _, history, _ = _run(spark, sf_dir, stages.vocabulary(spark, sf_dir))
    return history.drop("generated_at")


# detectors: draws are hashes, so SQL grows the same isolation forest; the random forest and the grids are checked in the tests


def _features(spark, sf_dir) -> int:
    return stages.feature_count(spark, sf_dir)


def _forest(spark, sf_dir):
    return stages.detector(spark, sf_dir)


def _same_scores(again, scored):
    first = scored.select("block_id", F.col("anomaly_score").alias("_first"))
    return again.join(first, "block_id").select("block_id", (F.col("anomaly_score") == F.col("_first")).alias("same_score"))


@query
def iforest_scores(spark, sf_dir):
    """Isolation scores and native classes of every labelled block."""
    found = _forest(spark, sf_dir).scored
    native = class_flag(F.col("if_class")).alias("native_prediction")
    return found.select("block_id", "label", "is_test", rounded("anomaly_score"), "if_class", native)


@query
def iforest_predictions(spark, sf_dir):
    """Flags at the calibrated threshold."""
    found = _forest(spark, sf_dir).predictions
    return found.select(
        "block_id", "prediction", rounded("anomaly_score"), rounded("decision_threshold"), "score_direction", "algorithm"
    )


@query
def iforest_test_report(spark, sf_dir):
    return _forest(spark, sf_dir).test_report.select("class", *[rounded(c) for c in ("precision", "recall", "f1")], "support")


@query
def rforest_scores(spark, sf_dir):
    """The supervised baseline, calibrated upward."""
    found = stages.supervised_detector(spark, sf_dir)
    return found.predictions.select("block_id", "label", "prediction", "anomaly_score", "score_direction")


@query
def rforest_round_trip(spark, sf_dir):
    """The saved and loaded baseline gives every labelled block the same score."""
    found, path = stages.supervised_detector(spark, sf_dir), staging_path(spark, "random-forest")
    supervised.save_random_forest(found.model, path)
    again = supervised.score_random_forest(
        supervised.load_random_forest(spark, path), stages.vectors(spark, sf_dir), _features(spark, sf_dir)
    )
    return _same_scores(again, found.scored)


@query
def iforest_scores_on_jvm(spark, sf_dir):
    """The scores of ``iforest_scores`` without a Python worker."""
    found = _forest(spark, sf_dir).model.transform_on_jvm(stages.vectors(spark, sf_dir))
    native = class_flag(F.col("if_class")).alias("native_prediction")
    return found.select("block_id", "label", "is_test", rounded("anomaly_score"), "if_class", native)


@query
def pipeline_predictions(spark, sf_dir):
    """Vocabulary, forest and threshold fitted as one ``pyspark.ml`` pipeline, saved, loaded and applied to every labelled block."""
    split = splits.stratified_split(stages.labelled(spark, sf_dir), "block_id", "label", 0.3, 42).select("block_id", "is_test")
    rows = stages.sequence_table(spark, sf_dir).select("block_id", "events", "label").join(split, "block_id")
    fit, held = splits.calibration_split(rows.where(~F.col("is_test")), "block_id", "label")
    part = lambda df, flag: df.select("block_id", "events", "label", F.lit(flag).alias("is_calibration"))
    train = part(fit, False).unionByName(part(held, True))
    path = staging_path(spark, "detector-pipeline")
    Pipeline(stages=[estimator.EventVocabulary(), estimator.IsolationForest(), estimator.ScoreThreshold()]).fit(train).write().save(path)
    return PipelineModel.load(path).transform(rows).select(
        "block_id", "prediction", rounded("anomaly_score"), rounded("decision_threshold"), "score_direction", "algorithm"
    )


@query
def grid_folds(spark, sf_dir):
    """The contiguous folds of the training rows that the grid searches use."""
    train = stages.vectors(spark, sf_dir).where(~F.col("is_test"))
    return tuning.with_folds(train.select("block_id"), "block_id").select("block_id", "fold")


@query
def input_checks(spark, sf_dir):
    """Which inputs of a run its checks accept, with the number that each looked at."""
    vocab, n = stages.vocabulary(spark, sf_dir), _features(spark, sf_dir)
    found = stages.predictions(spark, sf_dir)
    vectors = stages.vectors(spark, sf_dir)
    cases = [
        ("features match the vocabulary", n, lambda: score.check_features(n, vocab)),
        ("one feature too many", n + 1, lambda: score.check_features(n + 1, vocab)),
        ("default calibration", 2, lambda: calibrate.check_parameters(2.0, 0.75)),
        ("beta of zero", 0, lambda: calibrate.check_parameters(0.0, 0.75)),
        ("precision floor of one", 1, lambda: calibrate.check_parameters(2.0, 1.0)),
        ("predictions have their columns", found.count(), lambda: require_columns(found, ["block_id", "prediction", "anomaly_score"])),
        ("predictions lack a column", found.count(), lambda: require_columns(found, ["SequenceId"])),
        ("random forest without consent", vectors.count(), lambda: supervised.fit_random_forest(vectors, n)),
    ]

    def accepts(check) -> bool:
        try:
            check()
        except (ValueError, KeyError):
            return False
        return True

    rows = [(name, number, accepts(check)) for name, number, check in cases]
    return spark.createDataFrame(rows, "check string, looked_at long, accepted boolean")


def _grid(spark, sf_dir, contaminations, grid):
    train = stages.vectors(spark, sf_dir).where(~F.col("is_test"))
    ratio = splits.contamination(train).first()[0]
    table, _ = tuning.grid_search(train, _features(spark, sf_dir), contaminations(ratio), grid)
    return table


@query
def grid_search_best(spark, sf_dir):
    """Reduced grid over the training rows; every setting with its mean F1."""
    return _grid(spark, sf_dir, tuning.reduced_contamination_grid, tuning.REDUCED_GRID)


@query
def grid_search_full(spark, sf_dir):
    """All 81 settings over the training rows, each with its mean F1."""
    return _grid(spark, sf_dir, tuning.contamination_grid, tuning.FULL_GRID)


@query
def forest_round_trip(spark, sf_dir):
    """The saved and loaded forest gives every labelled block the same score."""
    found, path = _forest(spark, sf_dir), staging_path(spark, "forest")
    found.model.save(path)
    again = ForestModel.load(spark, path).transform(stages.vectors(spark, sf_dir))
    return _same_scores(again, found.scored)


@query
def detected_incidents(spark, sf_dir):
    """Log to incidents: the 20 most severe blocks of the forest, with their first lines."""
    flagged = _forest(spark, sf_dir).predictions.where(F.col("prediction") == 1).withColumn("row_idx", F.col("first_line"))
    top = incidents.rank_anomalies(flagged, 20).select("rank", "block_id", "severity", "anomaly_score")
    excerpts = incidents.block_excerpts(logview.log_lines(spark, sf_dir), top, 5)
    return top.join(excerpts, "block_id", "left").select(
        "rank", "block_id", rounded("severity"), rounded("anomaly_score"), "line_rank", "line"
    )
