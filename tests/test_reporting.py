import json

import pytest

from logblocks.operators import evaluate, guardrails, incidents, report, sequences
from logblocks.operators.guardrails import GuardrailError
from logblocks.sources import tables
from tests.conftest import lines_of

SEQ = "block_id string, events array<string>"


def seqs(spark, *events, labels=None):
    rows = [(f"b{i}", e) for i, e in enumerate(events)]
    frame = spark.createDataFrame(rows, SEQ)
    if labels is None:
        return frame
    tags = spark.createDataFrame([(f"b{i}", y) for i, y in enumerate(labels)], "block_id string, label int")
    return frame.join(tags, "block_id")


def vocab(spark, *events):
    return spark.createDataFrame([(e, i) for i, e in enumerate(events)], "event string, idx int")


def checks(spark, table, known, index="same", **options):
    if index == "same":
        index = sequences.block_index(table.select("block_id"), "block_id")
    return guardrails.run_guardrails(table, sequences.sequence_events(table), known, index, **options)


def by_name(frame):
    return {r.name: r for r in frame.collect()}


def test_clean_tables_pass(spark):
    table = seqs(spark, ["E1", "E2"], ["E2", "E3"], ["E1"])
    found = by_name(checks(spark, table, vocab(spark, "E1", "E2", "E3")))
    assert {n: r.status for n, r in found.items()} == {"npz_schema": "ok", "block_index": "ok", "vocabulary": "ok"}
    assert json.loads(found["npz_schema"].details) == {"num_sequences": 3, "has_labels": False, "issues": []}
    assert json.loads(found["block_index"].details) == {"path": "", "rows": 3, "issues": []}
    assert json.loads(found["vocabulary"].details) == {
        "vocab_size": 3, "observed_event_count": 3, "drift": 0.0, "unknown_event_count": 0
    }


def test_unknown_event_raises_with_samples(spark):
    table = seqs(spark, ["E1"], ["E4"])
    with pytest.raises(GuardrailError, match=r"Encountered 1 events not present in vocabulary \(samples: \['E4'\]\)"):
        guardrails.raise_on_failure(checks(spark, table, vocab(spark, "E1", "E2")))
    assert by_name(checks(spark, table, vocab(spark, "E1", "E2"), max_unknown_events=1))["vocabulary"].status == "ok"


def test_drift(spark):
    table = seqs(spark, ["E1"], ["E2"])
    row = by_name(checks(spark, table, vocab(spark, "E1", "E2", "E3", "E4"), drift_tolerance=0.2))["vocabulary"]
    assert row.status == "fail" and row.issues == ["Observed event count 2 deviates from vocab size 4 by 50.00%"]


def test_samples_are_the_first_ten(spark):
    events = [f"X{i:02d}" for i in range(30)]
    row = by_name(checks(spark, seqs(spark, events), vocab(spark, "E1"), drift_tolerance=99))["vocabulary"]
    assert row.issues[0].endswith(f"(samples: {events[:10]})")


def test_schema_issues(spark):
    empty = by_name(guardrails.check_sequences(seqs(spark)))["npz_schema"]
    assert empty.issues == ["x_data is empty"]
    half = guardrails.check_sequences(seqs(spark, ["E1"], None, labels=[1, None]))
    assert by_name(half)["npz_schema"].issues == [
        "x_data entries must be iterable sequences of events",
        "y_data length 1 does not match x_data length 2",
    ]
    texts = spark.createDataFrame([("b", "E1")], "block_id string, events string")
    assert by_name(guardrails.check_sequences(texts))["npz_schema"].status == "fail"


def test_index_issues(spark):
    table = seqs(spark, ["E1"], ["E1"])
    known = vocab(spark, "E1")
    assert by_name(checks(spark, table, known, index=None))["block_index"].status == "warn"
    short = spark.createDataFrame([(0, "b0")], "Index long, Block string")
    assert by_name(checks(spark, table, known, index=short))["block_index"].issues == [
        "BlockId column missing from block index",
        "Block index row count 1 does not match expected 2",
    ]


def test_empty_vocabulary_raises(spark):
    with pytest.raises(GuardrailError, match="empty"):
        checks(spark, seqs(spark, ["E1"]), vocab(spark, "E1").limit(0))


# incidents

FLAGGED = "block_id string, anomaly_score double, decision_threshold double, score_direction string, row_idx long"


def flagged(spark):
    rows = [("blk_low", -0.5, 0.5, "lower", 0), ("blk_high", 1.7, 0.5, "higher", 1), ("blk_medium", -0.1, 0.5, "lower", 2)]
    return spark.createDataFrame(rows, FLAGGED)


@pytest.mark.parametrize("top,expected", [(2, ["blk_high", "blk_low"]), (0, ["blk_high", "blk_low", "blk_medium"]), (9, ["blk_high", "blk_low", "blk_medium"])])
def test_rank(spark, top, expected):
    found = incidents.rank_anomalies(flagged(spark), top).orderBy("rank").collect()
    assert [r.block_id for r in found] == expected and [r["rank"] for r in found] == list(range(1, len(expected) + 1))


def test_rank_ties_keep_row_order_and_zeroes_are_zero(spark):
    rows = [("c", 0.0, 0.0, "lower", 2), ("b", 0.0, 0.0, "HIGHER", 1), ("a", 0.5, 0.5, "odd", 3)]
    found = incidents.rank_anomalies(spark.createDataFrame(rows, FLAGGED), 0).orderBy("rank").collect()
    assert [(r.block_id, r.severity) for r in found] == [("b", 0.0), ("c", 0.0), ("a", 0.0)]


LOG = ["1 blk_1 start", "2 blk_2 start", "3 blk_1 and blk_1 and blk_3", "4 blk_3", "malformed blk_1"]


@pytest.mark.parametrize("limit,counts", [(2, {"blk_1": [0, 2], "blk_3": [2, 3]}), (0, {"blk_1": [0, 2, 4], "blk_3": [2, 3]}), (5000, {"blk_1": [0, 2, 4], "blk_3": [2, 3]})])
def test_excerpts(spark, limit, counts):
    wanted = spark.createDataFrame([("blk_1",), ("blk_3",), ("blk_9",)], "block_id string")
    found = {}
    for r in incidents.block_excerpts(lines_of(spark, LOG), wanted, limit).orderBy("block_id", "line_rank").collect():
        found.setdefault(r.block_id, []).append(r.line_no)
        assert r.line == LOG[r.line_no] and r.line_rank == len(found[r.block_id])
    assert found == counts


def test_prompt(spark):
    found = spark.createDataFrame([("blk_1", -1.0, 0.0, "lower", 0), ("blk_9", -0.5, 0.0, "lower", 1)], FLAGGED)
    text = incidents.prompt_text(incidents.incident_prompt(found, lines_of(spark, LOG), 20, 2, "Be brief.\n")).first().prompt
    assert text == (
        "Be brief.\n\n" + incidents.INSTRUCTION + "\n\n"
        "Block 1: blk_1\n  • 1 blk_1 start\n  • 3 blk_1 and blk_1 and blk_3\n\n"
        "Block 2: blk_9\n(No log lines found for this block)\n\n" + incidents.CLOSING + "\n"
    )


def test_prompt_needs_anomalies(spark):
    with pytest.raises(ValueError, match="no anomalies"):
        incidents.incident_prompt(flagged(spark).limit(0), lines_of(spark, LOG))


def test_summaries(spark):
    prompts = spark.createDataFrame([("p",)], "prompt string")
    assert incidents.summarize(prompts, incidents.StaticClient(" done \n")).first().summary == "done"
    assert incidents.summarize(prompts, lambda p: p * 2).first().summary == "pp"


# report


def run(spark, labels, events=("E1",), **options):
    blocks = spark.createDataFrame([("b0", 1), ("b1", 0), ("b2", 0)], "block_id string, label int")
    if not labels:
        blocks = blocks.drop("label")
    predictions = spark.createDataFrame(
        [("b0", 1, -0.5, "lower", "isolation-forest"), ("b1", 1, -0.9, "lower", "isolation-forest"), ("b2", 0, 0.4, "lower", "isolation-forest")],
        "block_id string, prediction int, anomaly_score double, score_direction string, algorithm string",
    )
    table = seqs(spark, ["E1"], ["E1"], ["E1"])
    return report.run_summary(spark, blocks, predictions, checks(spark, table, vocab(spark, *events)), {"sequences": "s", "predictions": "p"}, top_k=1)


def test_summary_and_history(spark, tmp_path):
    summary, history, failure = run(spark, labels=True)
    body = json.loads(summary.first().value)
    assert body["sequence_stats"] == {"total_sequences": 3, "labeled_normals": 2, "labeled_anomalies": 1}
    assert body["prediction_stats"]["top_anomalies"][0]["block_id"] == "b1"
    assert body["evaluation"] == {
        "true_positives": 1, "false_positives": 1, "true_negatives": 1, "false_negatives": 0, "precision": 0.5, "recall": 1.0, "f1": 0.6667,
    }
    assert failure is None
    for _ in range(2):
        report.write_run(summary, history, failure, str(tmp_path / "summary"), str(tmp_path / "history"))
    rows = spark.read.schema(report.HISTORY).option("header", True).csv(str(tmp_path / "history")).collect()
    assert len(rows) == 2 and rows[0].contamination == 0.333333 and rows[0].guardrails_status == "ok"


def test_a_run_that_is_written_again_keeps_one_row(spark, tmp_path):
    made = run(spark, labels=True)
    paths = str(tmp_path / "summary"), str(tmp_path / "history")
    for run_id in ("2024-01-02T03:04:05+00:00", "2024-01-02T03:04:05+00:00", "second"):
        report.write_run(*made, *paths, run_id=run_id)
    assert tables.read_history(spark, paths[1]).count() == 2
    report.write_run(*made, *paths)
    assert tables.read_history(spark, paths[1]).count() == 3 and tables.read_history(spark, paths[1]).columns == made[1].columns


def test_unlabelled_runs_keep_no_history(spark):
    summary, history, _ = run(spark, labels=False)
    body = json.loads(summary.first().value)
    assert history is None and body["evaluation"] is None and body["sequence_stats"]["labeled_normals"] is None


def test_failure_is_raised_after_the_write(spark, tmp_path):
    summary, history, failure = run(spark, labels=True, events=("E9",))
    with pytest.raises(GuardrailError, match="vocabulary"):
        report.write_run(summary, history, failure, str(tmp_path / "summary"), str(tmp_path / "history"))
    assert json.loads(spark.read.text(str(tmp_path / "summary")).first().value)["guardrails"]["status"] == "fail"
    assert spark.read.schema(report.HISTORY).option("header", True).csv(str(tmp_path / "history")).first().guardrails_status == "fail"


def test_direction_must_be_one(spark):
    mixed = spark.createDataFrame([(1, 0.1, "lower"), (1, 0.2, "higher")], "prediction int, anomaly_score double, score_direction string")
    with pytest.raises(ValueError, match="mix"):
        evaluate.score_direction(mixed)
    assert evaluate.score_direction(mixed.drop("score_direction")) == "lower"
    with pytest.raises(KeyError):
        evaluate.score_direction(mixed.drop("prediction"))
