"""WARC archives: written by Spark's text writer, read back by boundary-chain verification.

Writing. Each page is one record of WARC/1.1; the record separator is the writer's line separator, so
archives come from the committed output of ordinary tasks and hold ``records_per_archive`` records at most. Of
equal payloads one page is a response and the others are revisits that refer to it.

Reading. Archives are split at any byte. Rows are what lies between two occurrences of the magic
``WARC/1.``, wherever it occurs, also inside payloads. Each row's header names the record's length, and
with it the offset of its successor:

1. Offsets are sums of row lengths: within a split, then over the splits of a file.
2. Candidates whose successor is the next candidate form runs. Only the last of a run points
   elsewhere, so a clean archive has one run a split.
3. Pointer jumping over the runs from offset 0 of each file: pointers double in reach each round, and
   only what is reached is a record. Magic inside payloads is never reached.
4. A record whose payload holds the magic is put together again from its rows.

All steps are DataFrame functions. Only lengths, offsets and headers are shuffled; payloads are
hashed where they are read (those that hold the magic excepted).

A null html is an empty payload, a null url leaves the header out. Of equal payloads the largest
page_id is the response (null smallest); rows that repeat that id are all responses. A group with
null ids only is all responses. An empty table gives an empty result. Only page_id, url and html are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logblocks.llm.common import whole
from logblocks.operators.staging import broadcast_if_small, materialize, staging_path

# Fixed values of the format.
MAGIC = "WARC/1."
BREAK = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
RECORDS_PER_ARCHIVE = 20_000


def base32_sha1(payload: Column) -> Column:
    """The bare upper-case base32 SHA-1 of a binary column: ten hex digits are eight base32 digits."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def record_id(page_id: Column) -> Column:
    h = F.md5(F.concat(F.lit("page:"), F.coalesce(page_id.cast("string"), F.lit("null"))).cast("binary"))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``(value)``: the text of each page's record, without the separator that follows it."""
    html = whole(F.col("html"))
    plain = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.regexp_replace("url", r"[\x00-\x20\x7F]", "").alias("url"),
        html.alias("html"),
        F.octet_length(html).cast("long").alias("n"),
        base32_sha1(html.cast("binary")).alias("digest"),
    )
    # one small row for each payload that occurs more than once
    twins = plain.where(F.col("n") >= least_bytes).groupBy("digest").agg(
        F.max("page_id").alias("winner"), F.count(F.lit(1)).alias("copies")
    )
    twins = materialize(twins.where("copies > 1").drop("copies"), "warc-twins")
    joined = plain.join(broadcast_if_small(twins), "digest", "left")
    revisit = F.col("winner").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("winner"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n"), F.lit(BREAK))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("html")))
    line = lambda name, value: F.concat(F.lit(f"\r\n{name}: "), value)
    header = F.concat_ws(
        "",
        F.lit(MAGIC + "1"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", record_id(F.col("page_id"))),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", F.col("url")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, line("WARC-Profile", F.lit(REVISIT_PROFILE))),
        F.when(revisit, line("WARC-Refers-To", record_id(F.col("winner")))),
        line("X-Page-ID", F.col("page_id").cast("string")),
        line("Content-Type", F.lit("application/http;msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
    )
    return joined.select(F.concat(header, F.lit(BREAK), block).alias("value"))


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0, records_per_archive: int = RECORDS_PER_ARCHIVE) -> None:
    writer = records(pages, least_bytes).write.option("lineSep", BREAK).option("compression", "none")
    writer.option("maxRecordsPerFile", records_per_archive).text(path)


def _field(header: Column, name: str) -> Column:
    found = F.regexp_extract(header, rf"(?i)\r\n{name}: *([^\r\n]*)", 1)
    return F.when(found != "", found)


def _parsed(value: Column) -> dict[str, Column]:
    """Parts of a record's text after the magic; null where the text has no valid header."""
    valid = value.rlike(r"\A[0-9]\r\n") & value.contains(BREAK)
    header = F.when(valid, F.substring_index(value, BREAK, 1))
    # a header field's name opens a line, so the version line must end before the first field
    length = F.regexp_extract(header, r"(?i)\r\nContent-Length: *([0-9]{1,18})(?=\r\n|\z)", 1)
    size = F.when(length != "", length.cast("long"))
    body = F.octet_length(header).cast("long") + len(BREAK)  # bytes before the block
    block = F.substring(value.cast("binary"), (body + 1).cast("int"), size.cast("int"))
    http = F.substring_index(block.cast("string"), BREAK, 1)
    http_size = F.octet_length(http).cast("long") + len(BREAK)
    kind = _field(header, "WARC-Type")
    payload = F.substring(value.cast("binary"), (body + http_size + 1).cast("int"), (size - http_size).cast("int"))
    return {
        "body": body,
        "size": size,
        "kind": kind,
        "id": _field(header, "WARC-Record-ID"),
        "refers": _field(header, "WARC-Refers-To"),
        "page_id": _field(header, "X-Page-ID").cast("long"),
        "stated": F.regexp_replace(_field(header, "WARC-Payload-Digest"), "^sha1:", ""),
        "payload_bytes": F.when(kind == "revisit", _field(F.concat(F.lit("\r\n"), http), "Content-Length").cast("long")).otherwise(
            F.greatest(F.lit(0), size - http_size)
        ),
        "digest": F.when(kind == "response", base32_sha1(payload)),
    }


def _rows(spark: SparkSession, path: str) -> DataFrame:
    """What lies between two magics, with file, split and order within the split."""
    lines = spark.read.option("lineSep", MAGIC).text(path)
    return lines.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("seq"),
        F.octet_length("value").cast("long").alias("n"),
    )


def _placed(rows: DataFrame, splits: DataFrame) -> DataFrame:
    """``at``: the offset of each row's magic in its file (-7 for what precedes the first)."""
    inside = W.partitionBy("file", "split").orderBy("seq").rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.col("n") + len(MAGIC)).over(inside), F.lit(0))
    return rows.withColumn("before", before).join(broadcast_if_small(splits), ["file", "split"]).withColumn(
        "at", F.col("start") + F.col("before") - len(MAGIC)
    ).drop("before", "start")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``(file, at, kind, id, refers, page_id, stated, payload_bytes, digest)`` of every record of the archives."""
    rows = _rows(spark, path)
    parts = _parsed(F.col("value"))
    scanned = rows.select("file", "split", "seq", "n", *(c.alias(k) for k, c in parts.items()))
    scanned = materialize(scanned, "warc-rows")
    ends = scanned.groupBy("file", "split").agg(F.sum(F.col("n") + len(MAGIC)).alias("total"))
    by_file = W.partitionBy("file").orderBy("split").rowsBetween(W.unboundedPreceding, -1)
    splits = materialize(ends.select("file", "split", F.coalesce(F.sum("total").over(by_file), F.lit(0)).alias("start")), "warc-splits")
    placed = materialize(
        _placed(scanned, splits).withColumn("next", F.col("at") + len(MAGIC) + F.col("body") + F.col("size") + len(BREAK)),
        "warc-candidates",
    )
    candidates = placed.where(F.col("next").isNotNull())
    inside = W.partitionBy("file", "split").orderBy("seq")
    opens = F.coalesce(F.lag("next").over(inside) != F.col("at"), F.lit(True)).cast("int")
    candidates = candidates.withColumn("opens", opens).withColumn("run", F.sum("opens").over(inside)).drop("opens")
    candidates = materialize(candidates, "warc-runs")
    reached = _reach(candidates)
    key = ["file", "split", "run"]
    true = candidates.join(broadcast_if_small(reached), key).where(F.col("at") >= F.col("entry")).drop("entry", "run")
    true = materialize(true, "warc-records")

    whole_row = F.col("n") == F.col("body") + F.col("size") + len(BREAK)
    keep = ["file", "at", "kind", "id", "refers", "page_id", "stated", "payload_bytes", "digest"]
    cut = true.where(~whole_row)
    if cut.isEmpty():
        return true.select(*keep)
    return true.where(whole_row).select(*keep).unionByName(_rejoined(spark, path, splits, placed, cut).select(*keep))


def _reach(candidates: DataFrame) -> DataFrame:
    """``(file, split, run, entry)``: runs that the chain from offset 0 reaches, and where it enters them."""
    runs = candidates.groupBy("file", "split", "run").agg(F.max_by("next", "at").alias("next"))
    goal = candidates.select("file", F.col("at").alias("next"), F.col("split").alias("split2"), F.col("run").alias("run2"))
    jumps = materialize(runs.join(goal, ["file", "next"]).withColumnRenamed("next", "entry2"), "warc-jumps")
    reached = candidates.where("at = 0").select("file", "split", "run", F.col("at").alias("entry"))
    reached, count = materialize(reached, "warc-reached"), -1
    while count != (count := reached.count()):
        step = reached.join(jumps, ["file", "split", "run"]).select(
            "file", F.col("split2").alias("split"), F.col("run2").alias("run"), F.col("entry2").alias("entry")
        )
        reached = reached.unionByName(step).groupBy("file", "split", "run").agg(F.min("entry").alias("entry"))
        reached = materialize(reached, "warc-reached")
        then = jumps.select(
            "file", F.col("split").alias("split2"), F.col("run").alias("run2"),
            F.col("split2").alias("split3"), F.col("run2").alias("run3"), F.col("entry2").alias("entry3"),
        )
        jumps = jumps.join(then, ["file", "split2", "run2"]).select(
            "file", "split", "run", F.col("split3").alias("split2"), F.col("run3").alias("run2"), F.col("entry3").alias("entry2")
        )
        jumps = materialize(jumps, "warc-jumps")
    return reached


def _rejoined(spark: SparkSession, path: str, splits: DataFrame, placed: DataFrame, cut: DataFrame) -> DataFrame:
    """Records whose payload holds the magic, parsed anew from all their rows."""
    heads = cut.select("file", "at", F.lit(True).alias("head"), F.col("next").alias("until"))
    marked = placed.select("file", "at").join(heads, ["file", "at"], "left")
    order = W.partitionBy("file").orderBy("at").rowsBetween(W.unboundedPreceding, 0)
    owner = F.last(F.when(F.col("head"), F.struct(F.col("at").alias("owner"), F.col("until").alias("to"))), ignorenulls=True).over(order)
    owned = marked.withColumn("o", owner).select("file", "at", "o.owner", "o.to").where("at < to")
    texts = _placed(_rows(spark, path), splits).select("file", "at", "value")
    pieces = texts.join(broadcast_if_small(materialize(owned, "warc-pieces")), ["file", "at"])
    joined = pieces.groupBy("file", F.col("owner").alias("at")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "value"))), lambda p: p["value"]), MAGIC).alias("value")
    )
    return joined.select("file", "at", *(c.alias(k) for k, c in _parsed(F.col("value")).items()))


def round_trip(pages: DataFrame, least_bytes: int = 0, records_per_archive: int = RECORDS_PER_ARCHIVE) -> DataFrame:
    """Writes archives and reads them: page_id, payload_bytes, payload_digest, record_type, refers_to.

    A response's digest is that of the payload read, a revisit's is that of the response it refers to.
    """
    spark = pages.sparkSession
    path = staging_path(spark, "archives")
    write_archives(pages, path, least_bytes, records_per_archive)
    found = read_records(spark, path)
    revisits = found.where("kind = 'revisit'")
    responses = found.where("kind = 'response'").select(F.col("id").alias("refers"), F.col("page_id").alias("refers_to"), F.col("digest").alias("full"))
    linked = revisits.join(responses.dropDuplicates(["refers"]), "refers", "left")
    done = lambda df, digest, refers: df.select("page_id", "payload_bytes", digest.alias("payload_digest"), F.col("kind").alias("record_type"), refers.alias("refers_to"))
    return done(found.where("kind = 'response'"), F.col("digest"), F.lit(None).cast("long")).unionByName(
        done(linked, F.col("full"), F.col("refers_to"))
    )


SQL = r"""
with p as (select page_id, coalesce(html, '') as html from pages),
h as (select page_id, strlen(html) as payload_bytes, sha1(html) as h,
  max(page_id) over (partition by html) as winner from p),
d as (select *, list_aggregate(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    cast((cast('0x' || substr(h, 1 + 10 * (k // 8), 10) as bigint) >> (35 - 5 * (k % 8))) & 31 as integer) + 1, 1)),
  'string_agg', '') as payload_digest from h)
select page_id, cast(payload_bytes as bigint) as payload_bytes, payload_digest,
  case when winner is null or page_id is not distinct from winner then 'response' else 'revisit' end as record_type,
  case when winner is null or page_id is not distinct from winner then null else winner end as refers_to from d
"""
