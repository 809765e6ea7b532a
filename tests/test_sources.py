import pytest
from pyspark.sql import functions as F

from logblocks.operators import sequences
from logblocks.operators.staging import materialize, spread, staging_root
from logblocks.plans import logview
from logblocks.sources import lines, sinks, tables


def write(folder, name, body: bytes) -> str:
    (folder / name).write_bytes(body)
    return str(folder / name)


def test_lines_end_at_newlines_only(spark, tmp_path):
    path = write(tmp_path, "a.log", "one\r\ntwo\rtwo\n\nlast é\r\r\nend".encode())
    found = [tuple(r) for r in lines.read_lines(spark, path).orderBy("line_no").collect()]
    assert found == [(0, "one"), (1, "two\rtwo"), (2, ""), (3, "last é\r"), (4, "end")]


@pytest.mark.parametrize("split_bytes", [64, 1000, 10**8])
def test_numbers_follow_file_order_over_many_splits(spark, tmp_path, split_bytes):
    expected = []
    for f in range(3):
        body = [f"file {f} line {i} " + "x" * (i % 37) for i in range(400)]
        write(tmp_path, f"part-{f}.log", ("\n".join(body) + "\n").encode())
        expected += body
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        found = lines.read_lines(spark, str(tmp_path)).orderBy("line_no").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [r.line_no for r in found] == list(range(1200)) and [r.line for r in found] == expected


def test_very_long_line(spark, tmp_path):
    path = write(tmp_path, "a.log", b"x" * 300_000 + b"\nshort\n")
    assert [len(r.line) for r in lines.read_lines(spark, path).orderBy("line_no").collect()] == [300_000, 5]


def test_labels(spark, tmp_path):
    path = write(tmp_path, "labels.csv", b"BlockId,Label\nblk_2,Anomaly\nblk_1,Normal\n")
    assert [tuple(r) for r in tables.read_labels(spark, path).orderBy("label_row").collect()] == [(0, "blk_2", "Anomaly"), (1, "blk_1", "Normal")]
    assert tables.read_labels(spark, None) is None
    with pytest.raises(KeyError, match="Label"):
        tables.read_labels(spark, write(tmp_path, "bad.csv", b"BlockId,Tag\nblk_2,x\n"))


PREDICTIONS = (
    "BLOCKID, Prediction ,Anomaly_Score,decision_threshold,score_direction\n"
    "blk_a,1,1.5,0.5, Higher \nblk_b,0,x,0.5,lower\nblk_c, 1 ,-0.25,,\nblk_d,,,,\nblk_e,-1,,,\n"
)


def test_flagged_predictions(spark, tmp_path):
    body = PREDICTIONS.replace(" Prediction ", "Prediction").encode()
    found = tables.read_anomalies(spark, write(tmp_path, "p.csv", body)).orderBy("row_idx").collect()
    assert [tuple(r)[1:] for r in found] == [("blk_a", 1, 1.5, 0.5, "higher"), ("blk_c", 1, -0.25, 0.0, "lower")]


def test_flagged_predictions_without_optional_columns(spark, tmp_path):
    found = tables.read_anomalies(spark, write(tmp_path, "p.csv", b"BlockId,prediction\nblk_a,1\nblk_b,0\n")).collect()
    assert [tuple(r)[1:] for r in found] == [("blk_a", 1, 0.0, 0.0, "lower")]
    with pytest.raises(KeyError, match="prediction"):
        tables.read_anomalies(spark, write(tmp_path, "q.csv", b"BlockId,score\nblk_a,1\n"))


@pytest.mark.parametrize("row", ["blk_a,yes,1.0", "blk_a,1.0,1.0", "blk_a,1,high"])
def test_bad_numbers_fail_the_load(spark, tmp_path, row):
    path = write(tmp_path, "p.csv", f"BlockId,prediction,anomaly_score\n{row}\n".encode())
    with pytest.raises(Exception, match="is not a number"):
        tables.read_anomalies(spark, path).collect()


def test_vocabulary_round_trip(spark, tmp_path):
    vocab = spark.createDataFrame([("E1", 0), ("E10", 1), ("E2", 2)], "event string, idx int")
    sinks.write_vocabulary(vocab, str(tmp_path / "v"))
    assert {tuple(r) for r in tables.read_vocabulary(spark, str(tmp_path / "v")).collect()} == {("E1", 0), ("E10", 1), ("E2", 2)}
    with pytest.raises(ValueError):
        tables.read_vocabulary(spark, write(tmp_path, "v.json", b'{\n  "E1": 0,\n  "E2": 2\n}'))


def test_threshold(spark, tmp_path):
    path = write(tmp_path, "t.json", b'{\n "algorithm": null,\n "score_threshold": 0.25\n}')
    assert tables.read_threshold(spark, path).first().score_threshold == 0.25
    assert tables.read_threshold(spark, None) is None
    with pytest.raises(ValueError):
        tables.read_threshold(spark, write(tmp_path, "u.json", b'{"algorithm": "isolation-forest"}'))


def test_sequences_and_index(spark, tmp_path):
    rows = spark.createDataFrame([("b1", 0, "E1"), ("b2", 1, "E2")], "block_id string, line_no long, event_id string")
    sinks.write_table(sequences.block_sequences(rows), str(tmp_path / "s"))
    assert tables.read_sequences(spark, str(tmp_path / "s")).count() == 2
    with pytest.raises(KeyError, match="label"):
        tables.read_sequences(spark, str(tmp_path / "s"), labels_required=True)
    sinks.write_block_index(sequences.block_index(sequences.block_totals(rows), "first_line"), str(tmp_path / "i"))
    assert tables.read_block_index(spark, str(tmp_path / "i"), 2).count() == 2
    with pytest.raises(ValueError, match="expected 3"):
        tables.read_block_index(spark, str(tmp_path / "i"), 3)
    plain = spark.createDataFrame([(4, ["E1"])], "row_idx long, events array<string>")
    assert tables.with_sequence_ids(plain).first().SequenceId == "sequence_4"


def test_parsed_csv_needs_its_message(spark, tmp_path):
    path = write(tmp_path, "p.csv", b"timestamp,pid,severity,component,body\n1,2,INFO,c,m\n")
    with pytest.raises(KeyError, match="message"):
        tables.read_parsed(spark, path, csv=True)


def test_quoted_csv_messages_survive(spark, tmp_path):
    parsed = spark.createDataFrame([(0, 1, 2, "INFO", "c", 'say "hi", ok'), (1, 1, 2, "INFO", "c", "a\\b")], "line_no long, timestamp long, pid int, severity string, component string, message string")
    sinks.write_parsed_csv(parsed, str(tmp_path / "c"))
    found = tables.read_parsed(spark, str(tmp_path / "c"), csv=True).orderBy("line_no").collect()
    assert [r.message for r in found] == ['say "hi", ok', "a\\b"]


def test_structured_scan_reads_two_columns(spark, tmp_path):
    spark.createDataFrame([(0, "m", "E1", "x")], "line_no long, message string, event_id string, other string").write.parquet(str(tmp_path / "l"))
    plan = tables.read_structured(spark, str(tmp_path / "l")).drop("line_no")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<message:string,event_id:string>" in plan


def test_staging_folder_comes_from_the_session(spark):
    assert staging_root(spark) == spark.conf.get("spark.checkpoint.dir")
    staged = materialize(spark.range(3), "three")
    assert all(staging_root(spark) in f for f in staged.inputFiles()) and staged.count() == 3


def test_a_file_of_one_row_group_is_read_by_all_cores(spark, tmp_path):
    rows = spark.range(200_000).selectExpr(
        "id as event_id", "timestamp'2024-01-01' as ts", "id % 50 as user_id", "'view' as event_type", "1.0D as value"
    )
    rows.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    rows.limit(10).coalesce(1).write.parquet(f"{tmp_path}/few/events.parquet")
    read = spark.read.parquet(f"{tmp_path}/events.parquet")
    log = logview.log_lines(spark, str(tmp_path))
    parts = [r["count"] for r in log.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(parts) == 200_000 and max(parts) < 60_000
    assert spread(read).exceptAll(read).isEmpty() and read.exceptAll(spread(read)).isEmpty()
    assert spread(read.limit(0)).count() == 0
    assert "Exchange" not in logview.log_lines(spark, f"{tmp_path}/few")._jdf.queryExecution().executedPlan().toString()
