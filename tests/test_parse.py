import pytest

from logblocks.functions import text
from logblocks.operators import blocks, parse
from pyspark.sql import functions as F
from tests.conftest import lines_of

GOOD = {
    "240102 030405 77 INFO store.Writer$Lane: lane 4 closed blk_-12 after 9 parts": (
        1704164645,
        77,
        "INFO",
        "store.Writer$Lane",
        "lane 4 closed blk_-12 after 9 parts",
    ),
    "231231 235959 6 WARN store.Reader: 192.0.2.7:81:no answer for blk_12": (
        1704067199,
        6,
        "WARN",
        "store.Reader",
        "192.0.2.7:81:no answer for blk_12",
    ),
    "240102 030405 58 ERROR c:: a  b": (1704164645, 58, "UNKNOWN", "c:", "a b"),
    "240102 030405 58 FATAL c": (1704164645, 58, "UNKNOWN", "c", ""),
    "\t240102 030405\u00a058 INFO c:\u2003m\x0bn ": (1704164645, 58, "INFO", "c", "m n"),
    "240102 030405.25 58 INFO c: m": (1704164645, 58, "INFO", "c", "m"),
    "691231 235959 -1 INFO c: m": (-1, -1, "INFO", "c", "m"),
    "680101 000000 4294967297 INFO c: m": (3092601600, 1, "INFO", "c", "m"),
    "080229 000000 +2147483648 INFO c: m": (1204243200, -2147483648, "INFO", "c", "m"),
    "080229 000000 9223372036854775807 INFO c: m": (1204243200, -1, "INFO", "c", "m"),
}

BAD = {
    "": "too few parts",
    "240102 030405 58 INFO": "too few parts",
    "yesterday noon 58 INFO c: m": "timestamp",
    "080230 000000 58 INFO c: m": "timestamp",
    "070229 000000 58 INFO c: m": "timestamp",
    "081301 000000 58 INFO c: m": "timestamp",
    "080100 000000 58 INFO c: m": "timestamp",
    "240102 240000 58 INFO c: m": "timestamp",
    "240102 030460 58 INFO c: m": "timestamp",
    "240102 030405 worker INFO c: m": "pid",
    "240102 030405 1.5 INFO c: m": "pid",
    "240102 030405 1e3 INFO c: m": "pid",
    "240102 030405 9223372036854775808 INFO c: m": "pid",
}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_fields(spark, zone, ansi):
    spark.conf.set("spark.sql.session.timeZone", zone)
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        lines = lines_of(spark, [*GOOD, *BAD])
        assert [tuple(r)[1:] for r in parse.parse_lines(lines).orderBy("line_no").collect()] == list(GOOD.values())
        assert {r.line: r.reason for r in parse.rejected_lines(lines).collect()} == BAD
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_block_references(spark):
    lines = lines_of(spark, ["x blk_-1 and blk_2 and blk_-1", "none", "blk_2"])
    assert [tuple(r) for r in blocks.first_references(lines, "line").select("line_no", "block_id").collect()] == [(0, "blk_-1"), (2, "blk_2")]
    found = {tuple(r) for r in blocks.all_references(lines).select("line_no", "block_id").collect()}
    assert found == {(0, "blk_-1"), (0, "blk_2"), (2, "blk_2")}
    assert tuple(blocks.skipped_messages(lines, "line").first()) == (3, 1)


def test_label_flag(spark):
    labels = spark.createDataFrame([("Anomaly",), ("\u00a0 aNOMALY\x1c\t",), ("Normal",), (None,)], "Label string")
    assert [r[0] for r in labels.select(text.label_flag(F.col("Label"))).collect()] == [1, 1, 0, 0]


def test_words_agree_with_python_split(spark):
    samples = ["a b", "  a\u3000b ", "a_b__c", "\x1ca\x1fb", "", "\u2028x", "caf\u00e9 ol\u00e9", "a\tb"]
    frame = spark.createDataFrame([(s,) for s in samples], "m string")
    found = [r[0] for r in frame.select(text.words(F.col("m"), "_", controls=True)).collect()]
    assert found == [s.replace("_", " ").split() for s in samples]
