import random

import pytest
from pyspark.sql import functions as F

from logblocks.operators import evaluate, features, ordering, sequences, splits
from logblocks.operators.staging import broadcast_if_small, materialize, materialize_bucketed, materialize_counted, scope


def rows_of(spark, events):
    """``(block, event)`` pairs in line order."""
    rows = [(b, i, e) for i, (b, e) in enumerate(events)]
    return spark.createDataFrame(rows, "block_id string, line_no long, event_id string").repartition(5)


def labels_of(spark, labels):
    return spark.createDataFrame([(i, *x) for i, x in enumerate(labels)], "label_row long, BlockId string, Label string")


EXAMPLE = [("blk_-1", "E1"), ("blk_-2", "E3"), ("blk_-1", "E2")]


def test_example_sequences_and_labels(spark):
    rows = rows_of(spark, EXAMPLE)
    labels = labels_of(spark, [("blk_-2", "Anomaly"), ("blk_missing", "Anomaly"), ("blk_-2", "Normal"), ("blk_-1", "Normal")])
    built = sequences.labelled_sequences(sequences.block_sequences(rows), labels).orderBy("label_row")
    assert [(r.block_id, r.events, r.label) for r in built.collect()] == [("blk_-2", ["E3"], 1), ("blk_-1", ["E1", "E2"], 0)]
    totals = sequences.block_totals(rows)
    missing = sequences.missing_blocks(totals, labels).orderBy("label_row").collect()
    assert [(r.label_row, r.block_id) for r in missing] == [(1, "blk_missing"), (2, "blk_-2")]
    index = sequences.block_index(sequences.labelled_blocks(totals, labels), "label_row").orderBy("Index").collect()
    assert [tuple(r) for r in index] == [(0, "blk_-2", 1), (1, "blk_-1", 0)]


def test_unused_blocks(spark):
    totals = sequences.block_totals(rows_of(spark, EXAMPLE))
    assert [r.block_id for r in sequences.unused_blocks(totals, labels_of(spark, [("blk_-1", "Normal")])).collect()] == ["blk_-2"]


def test_a_block_with_a_third_of_all_rows_is_one_sequence(spark):
    draw = random.Random(2)
    events = [("blk_hot" if i % 3 == 0 else f"blk_{draw.randrange(400)}", f"E{draw.randrange(9)}") for i in range(6000)]
    expected = {}
    for b, e in events:
        expected.setdefault(b, []).append(e)
    rows = rows_of(spark, events)
    built = sequences.block_sequences(rows).collect()
    assert len(built) == len(expected) and {r.block_id: r.events for r in built} == expected
    assert all(r.n_events == len(r.events) for r in built)
    places = sequences.ordered_events(rows).collect()
    assert {(r.block_id, r.pos, r.event_id) for r in places} == {(b, i, e) for b, es in expected.items() for i, e in enumerate(es)}


def test_vectors_keep_blocks_of_unknown_events(spark):
    rows = rows_of(spark, [*EXAMPLE, ("blk_3", "E9"), ("blk_-1", "E1")])
    vocab = features.vocabulary(rows.where("event_id <> 'E9'"))
    assert {(r.event, r.idx) for r in vocab.collect()} == {("E1", 0), ("E2", 1), ("E3", 2)}
    found = {r.block_id: dict(zip(r.idxs, r.cnts)) for r in features.count_vectors(rows, vocab).collect()}
    assert found == {"blk_-1": {0: 2, 1: 1}, "blk_-2": {2: 1}, "blk_3": {}}
    assert [r.event_id for r in features.unseen_events(rows, vocab).collect()] == ["E9"]


def test_vocabulary_is_in_text_order(spark):
    rows = rows_of(spark, [("b", f"E{i}") for i in (2, 10, 1, 11)])
    assert [r.event for r in features.vocabulary(rows).orderBy("idx").collect()] == ["E1", "E10", "E11", "E2"]
    features.check_vocabulary_index(features.vocabulary(rows))
    with pytest.raises(ValueError):
        features.check_vocabulary_index(features.vocabulary(rows).where("idx <> 1"))


def test_split_sizes_follow_the_published_calibration_size(spark):
    """575,061 blocks with 16,838 anomalies leave 80,509 for calibration."""
    blocks = spark.range(575061).select(F.concat(F.lit("blk_"), "id").alias("block_id"), (F.col("id") < 16838).cast("int").alias("label"))
    split = materialize(splits.stratified_split(blocks, "block_id", "label", 0.3, 42), "split")
    assert split.where("is_test").count() == 172519
    share = split.groupBy("label").agg(F.avg(F.col("is_test").cast("double")).alias("s")).collect()
    assert all(abs(r.s - 0.3) < 1e-4 for r in share)
    fit, held = splits.calibration_split(split.where("not is_test"), "block_id", "label")
    assert (fit.count(), held.count()) == (322033, 80509)
    assert fit.join(held, "block_id").count() == 0


def test_split_ignores_partitioning(spark):
    blocks = spark.range(500).selectExpr("concat('b', id) as block_id", "cast(id % 7 = 0 as int) as label")
    pick = lambda df: {r.block_id for r in splits.stratified_split(df, "block_id", "label", 0.3, 1).where("is_test").collect()}
    assert pick(blocks.coalesce(1)) == pick(blocks.repartition(16)) != set()


def test_small_classes_reuse_all_rows(spark):
    one = spark.createDataFrame([("a", 0), ("b", 0), ("c", 1)], "block_id string, label int")
    fit, held = splits.calibration_split(one, "block_id", "label")
    assert fit.count() == held.count() == 3


def test_contamination_floor(spark):
    empty = spark.createDataFrame([], "block_id string, label int")
    assert splits.contamination(empty).first()[0] == 1e-6
    assert splits.contamination(spark.createDataFrame([(1,), (0,), (0,), (0,)], "label int")).first()[0] == 0.25


@pytest.mark.parametrize("small", [0, 10_000])
@pytest.mark.parametrize("ascending", [True, False])
def test_running_sums(spark, small, ascending):
    draw = random.Random(4)
    data = sorted({round(draw.gauss(0, 1), 3): draw.randrange(9) for _ in range(3000)}.items(), reverse=not ascending)
    frame = spark.createDataFrame(data, "s double, n long").repartition(7)
    found = {r.s: r.upto for r in ordering.running_sums(frame, "s", {"upto": "n"}, ascending, buckets=16, small=small).collect()}
    total, expected = 0, {}
    for s, n in data:
        total += n
        expected[s] = total
    assert found == expected


def test_number_rows_with_a_hot_key(spark):
    data = [(0.5 if i % 3 else float(i % 11), i) for i in range(3000)]
    frame = spark.createDataFrame(data, "s double, i long").repartition(8)
    found = ordering.number_rows(frame, F.col("s").desc(), F.col("i")).orderBy("row_idx").collect()
    assert [(r.s, r.i) for r in found] == sorted(data, key=lambda x: (-x[0], x[1]))
    assert [r.row_idx for r in found] == list(range(3000))


def test_rank_within_a_hot_key(spark):
    data = [("hot" if i % 3 == 0 else f"k{i % 50}", i) for i in range(2000)]
    frame = spark.createDataFrame(data, "k string, line long").repartition(8)
    found = {(r.k, r.line): r.r for r in ordering.rank_within(frame, "k", "line", "r", width=64).collect()}
    seen, expected = {}, {}
    for k, line in data:
        seen[k] = seen.get(k, 0) + 1
        expected[k, line] = seen[k]
    assert found == expected


def test_broadcast_only_behind_a_count(spark):
    hinted = lambda df: "broadcast" in df._jdf.queryExecution().logical().toString().lower()
    assert hinted(broadcast_if_small(spark.range(10), 10))
    assert not hinted(broadcast_if_small(spark.range(11), 10))


def staged_folders(spark):
    from pathlib import Path

    from logblocks.operators import staging

    folder = Path(staging._session_folder(spark))
    return {p.name for p in folder.iterdir()} if folder.exists() else set()


def test_a_scope_leaves_no_staged_table(spark):
    from logblocks.operators.staging import published, scope

    before = staged_folders(spark)
    with scope(spark):
        assert materialize(spark.range(3).toDF("a"), "x").count() == 3
        assert len(staged_folders(spark)) == len(before) + 1
        with published():
            kept = materialize(spark.range(4).toDF("a"), "y")
    assert len(staged_folders(spark) - before) == 1 and kept.count() == 4


def test_broadcasts_are_bounded_by_rows_and_bytes(spark):
    from logblocks.operators.staging import fits

    wide = spark.range(10).select(F.repeat(F.lit("x"), 1000).alias("t"), F.array(F.lit("é"), F.lit(None)).alias("a"), F.lit(None).alias("n"))
    assert fits(wide, 10) and not fits(wide, 9) and not fits(wide, 10, 10_000) and fits(wide.limit(0), 0, 0)


def test_counters_are_taken_by_the_job_that_writes(spark):
    rows = spark.range(1000, numPartitions=7).select("id", (F.col("id") % 3 == 0).cast("int").alias("third"))
    counts = {"rows": F.count(F.lit(1)), "thirds": F.sum("third")}
    jobs = {}
    for name, run in (("plain", lambda: materialize(rows, "plain")), ("counted", lambda: materialize_counted(rows, "counted", **counts))):
        spark.sparkContext.setJobGroup(name, name)
        found = run()
        jobs[name] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    table, seen = found
    assert seen == {"rows": 1000, "thirds": 334} and table.count() == 1000
    assert jobs["counted"] == jobs["plain"] > 0
    assert materialize_counted(rows.where("id < 0"), "none", **counts)[1] == {"rows": 0, "thirds": 0}


def test_bucketed_tables_join_without_an_exchange(spark):
    rows = rows_of(spark, [(f"blk_{i % 50}", f"E{i % 7}") for i in range(600)])
    labels = labels_of(spark, [(f"blk_{i}", "Anomaly" if i % 5 == 0 else "Normal") for i in range(10, 60)] + [("blk_11", "Anomaly")])
    predictions = sequences.block_totals(rows).select("block_id", (F.col("first_line") % 2).cast("int").alias("prediction"))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        with scope(spark):
            built = materialize_bucketed(sequences.block_sequences(rows), "built", "block_id")
            first = materialize_bucketed(sequences.first_labels(labels), "first", "block_id")
            met = sequences.with_first_labels(built, first)
            assert "SortMergeJoin" in plan(met) and "Exchange" not in plan(met)
            plain = sequences.labelled_sequences(sequences.block_sequences(rows), labels)
            assert sorted(map(tuple, met.select(plain.columns).collect())) == sorted(map(tuple, plain.collect()))
            flagged = materialize_bucketed(predictions.join(met.select("block_id"), "block_id"), "flagged", "block_id")
            pairs = evaluate.with_labels(flagged, first.join(built.select("block_id"), "block_id"))
            assert "FullOuter" in plan(pairs) and "Exchange" not in plan(pairs)
            assert evaluate.confusion(pairs).first()["true_positives"] is not None
            assert len(spark.catalog.listTables()) >= 3
        left = [t.name for t in spark.catalog.listTables() if t.name.split("_")[0] in ("built", "first", "flagged")]
        assert left == []
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
