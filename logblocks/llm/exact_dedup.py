"""Exact dedup by a minimal perfect hash over the distinct digests of a corpus.

1. Every text is normalised (white space deleted) and hashed to a SHA-256 digest, JVM-side.
   Only ``(doc_id, n_points, digest)`` goes on, some 50 bytes a document.
2. ``build_index`` sums equal digests (partial sums before the shuffle, so a text with a
   third of all rows sends one row per task), deals the distinct digests into shards of
   bounded size and builds a minimal perfect hash per shard: levels of bit arrays in which
   each digest owns the first level where it falls alone. The slot of a digest is the rank
   of its bit. Slots hold the full digest and the locator of the winner, so a lookup is
   checked byte by byte and a digest outside the index is recognised.
3. ``lookup`` sends the rows to their shard. A shard with more rows than its share is probed
   by several tasks, each with a copy of the shard's index: rows are streamed, only one
   shard's index is in memory.
4. ``dedup_batch`` removes the rows of a new batch whose text the history holds; the rest, the
   nonmembers, are grouped on their own.

Null texts count as empty. Of equal texts the row with the most code points stays, then the
smallest doc_id (a null id comes last). Rows that repeat a doc_id and a text count each in
``group_size`` and share the decision. An empty table gives an empty result. Only the id and
text columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logblocks.llm.common import SPACES, partitions, whole
from logblocks.operators.staging import broadcast_if_small, materialize
from logblocks.shipping import ship

SHARD_DIGESTS = 32_768
GAMMA = 2.0
NO_ID = (1 << 63) - 1  # stands for a null doc_id inside the index

INDEX = "shard long, sizes binary, bits binary, digests binary, winners binary, counts binary"


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: Column) -> DataFrame:
    """``(doc_id, n_points, digest)`` of every row, and ``more`` columns."""
    text = whole(F.col(text_col))
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.length(text).cast("long").alias("n_points"),
        F.unhex(F.sha2(F.translate(text, SPACES, ""), 256)).alias("digest"),
        *more,
    )


def distinct_digests(rows: DataFrame) -> DataFrame:
    """``(digest, winner, n_rows)``: the row that stays for each digest, and its copies.

    The winner is a doc_id, or a row number if ``rows`` have a column ``row``.
    """
    rank = [F.col("n_points").alias("p"), (-F.coalesce("doc_id", F.lit(NO_ID))).alias("w")]
    if "row" in rows.columns:
        rank[1:] = [rank[1].alias("d"), (-F.col("row")).alias("w")]
    return rows.groupBy("digest").agg(
        (-F.max(F.struct(*rank))["w"]).alias("winner"), F.count(F.lit(1)).alias("n_rows")
    )


def _mix(words: np.ndarray, level: int) -> np.ndarray:
    """A 64-bit hash of each digest for one level."""
    with np.errstate(over="ignore"):
        h = words[:, 0] + words[:, 1] * np.uint64(2 * level + 1) + np.uint64(0x9E3779B97F4A7C15) * np.uint64(level + 1)
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _words(flat: bytes) -> np.ndarray:
    return np.frombuffer(flat, "<u8").reshape(-1, 4)


class Levels:
    """Bit arrays, one per level, and the rank that turns a bit into a slot."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        self.rank = np.cumsum(bits) - bits

    @classmethod
    def build(cls, words: np.ndarray) -> "Levels":
        """Levels for distinct digests; every digest ends alone on a bit."""
        left, sizes, bits = words, [], []
        while len(left):
            size = max(1, math.ceil(GAMMA * len(left)))
            at = (_mix(left, len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            bits.append(alone)
            left = left[~alone[at]]
        return cls(np.array(sizes, np.int64), np.concatenate(bits) if bits else np.zeros(0, bool))

    def slots(self, words: np.ndarray) -> np.ndarray:
        """The slot of each digest; -1 where no level has its bit."""
        found = np.full(len(words), -1, np.int64)
        open_rows = np.arange(len(words))
        for level, (start, size) in enumerate(zip(self.starts, self.sizes)):
            at = start + (_mix(words[open_rows], level) % np.uint64(size)).astype(np.int64)
            hit = self.bits[at]
            found[open_rows[hit]] = self.rank[at[hit]]
            open_rows = open_rows[~hit]
            if not len(open_rows):
                break
        return found


def _build_shard(rows: pa.Table) -> pa.Table:
    flat = b"".join(rows.column("digest").to_pylist())
    words = _words(flat)
    levels = Levels.build(words)
    order = np.argsort(levels.slots(words))  # slot k holds row order[k]: the hash is minimal
    column = lambda name: rows.column(name).to_numpy()[order].astype("<i8").tobytes()
    return pa.table(
        {
            "shard": pa.array([rows.column("shard")[0].as_py()], pa.int64()),
            "sizes": [levels.sizes.astype("<i8").tobytes()],
            "bits": [np.packbits(levels.bits).tobytes()],
            "digests": [words[order].tobytes()],
            "winners": [column("winner")],
            "counts": [column("n_rows")],
        }
    )


class Shard:
    """One shard of the index, opened for lookups."""

    def __init__(self, row: dict):
        sizes = np.frombuffer(row["sizes"], "<i8")
        bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8))[: sizes.sum()].astype(bool)
        self.levels = Levels(sizes, bits)
        self.digests = _words(row["digests"])
        self.winners = np.frombuffer(row["winners"], "<i8")
        self.counts = np.frombuffer(row["counts"], "<i8")

    def find(self, words: np.ndarray):
        """Member flag, winner and row count of each digest; members are checked byte by byte."""
        slots = self.levels.slots(words)
        at = np.maximum(slots, 0)
        member = slots >= 0
        member[member] = (self.digests[at[member]] == words[member]).all(axis=1)
        return member, np.where(member, self.winners[at], 0), np.where(member, self.counts[at], 0)


def build_index(groups: DataFrame, name: str = "mph") -> tuple[DataFrame, int]:
    """The written index, one row per shard, over ``distinct_digests`` rows; and the shard count."""
    spark = groups.sparkSession
    ship(spark)
    groups = materialize(groups, f"{name}-digests")
    shards = max(partitions(spark), math.ceil(groups.count() / SHARD_DIGESTS))
    dealt = groups.withColumn("shard", F.pmod(F.xxhash64("digest"), F.lit(shards)))
    return materialize(dealt.groupBy("shard").applyInArrow(_build_shard, INDEX), name), shards


def _probe(batches):
    """Rows sorted by (shard, salt, kind): an index row, then the rows to look up in it."""
    shard, key = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        pair = np.stack([batch.column("shard").to_numpy(), batch.column("salt").to_numpy(), batch.column("kind").to_numpy()], 1)
        cuts = [0, *(np.flatnonzero((pair[1:] != pair[:-1]).any(axis=1)) + 1), len(pair)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            part = batch.slice(a, b - a)
            if pair[a, 2] == 0:
                shard, key = Shard(part.slice(0, 1).to_pylist()[0]), tuple(pair[a, :2])
                continue
            n = b - a
            if key == tuple(pair[a, :2]):
                member, winner, count = shard.find(_words(b"".join(part.column("digest").to_pylist())))
            else:  # no digest of the index lies in this shard
                member, winner, count = np.zeros(n, bool), np.zeros(n, np.int64), np.zeros(n, np.int64)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": part.column("doc_id"),
                    "n_points": part.column("n_points"),
                    "digest": part.column("digest"),
                    "member": member,
                    "winner": winner,
                    "n_rows": count,
                }
            )


def lookup(rows: DataFrame, index: DataFrame, shards: int) -> DataFrame:
    """``rows`` (doc_id, n_points, digest) with member, winner and n_rows from the index."""
    spark = rows.sparkSession
    ship(spark)
    probe = rows.withColumn("shard", F.pmod(F.xxhash64("digest"), F.lit(shards)))
    loads = materialize(probe.groupBy("shard").agg(F.count(F.lit(1)).alias("n")), "mph-loads")
    share = max(1.0, loads.agg(F.avg("n")).first()[0] or 1.0) * 2
    hot = loads.where(F.col("n") > share).select("shard", F.ceil(F.col("n") / share).alias("salts"))
    hot = broadcast_if_small(hot)  # at most one 16-byte row per shard
    salts = F.coalesce(F.col("salts"), F.lit(1).cast("long"))
    probe = probe.join(hot, "shard", "left").withColumn("salt", F.pmod(F.xxhash64("doc_id", "n_points"), salts))
    copies = index.join(hot, "shard", "left").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)))
    none = lambda kind: F.lit(None).cast(kind)
    both = copies.select(
        "shard", "salt", F.lit(0).alias("kind"), none("long").alias("doc_id"), none("long").alias("n_points"),
        none("binary").alias("digest"), "sizes", "bits", "digests", "winners", "counts",
    ).unionByName(
        probe.select(
            "shard", "salt", F.lit(1).alias("kind"), "doc_id", "n_points", "digest",
            *(none("binary").alias(c) for c in ("sizes", "bits", "digests", "winners", "counts")),
        )
    )
    dealt = both.repartition(partitions(spark), "shard", "salt").sortWithinPartitions("shard", "salt", "kind")
    return dealt.mapInArrow(
        _probe, "doc_id long, n_points long, digest binary, member boolean, winner long, n_rows long"
    )


def dedup_batch(batch: DataFrame, index: DataFrame, shards: int) -> DataFrame:
    """Decisions on a new batch (``digests`` rows) against a history's index.

    ``(doc_id, digest, in_history, keep_id, kept)``: a member of the index is a repeat and its
    keep_id is the winner of the history. Nonmembers are grouped on their own.
    """
    found = materialize(lookup(batch, index, shards), "mph-found")
    fresh = distinct_digests(found.where(~F.col("member"))).withColumnRenamed("winner", "fresh")
    keep = F.when(F.col("member"), F.col("winner")).otherwise(F.col("fresh"))
    return (
        found.drop("n_rows").join(fresh.drop("n_rows"), "digest", "left")
        .select(
            "doc_id",
            "digest",
            F.col("member").alias("in_history"),
            _null_id(keep).alias("keep_id"),
            (~F.col("member") & F.coalesce(F.col("fresh") == F.coalesce("doc_id", F.lit(NO_ID)), F.lit(False))).alias("kept"),
        )
    )


def _null_id(column):
    return F.when(column != NO_ID, column)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    The corpus is its own history: the index holds its distinct digests with their winners, and
    every row is looked up in it.
    """
    rows = materialize(digests(docs, id_col, text_col), "digests")
    index, shards = build_index(distinct_digests(rows))
    return lookup(rows, index, shards).select(
        "doc_id",
        _null_id(F.col("winner")).alias("keep_id"),
        F.col("n_rows").alias("group_size"),
        (F.coalesce("doc_id", F.lit(NO_ID)) == F.col("winner")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def kept_rows(docs: DataFrame, row_col: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(row_col, kept)`` by unique row numbers: of each group exactly one row stays.

    It is the row that ``exact_dedup`` keeps; of rows that share its id the longest, then the first.
    """
    rows = digests(docs, id_col, text_col, F.col(row_col).alias("row"))
    rows = materialize(rows, "digests")
    index, shards = build_index(distinct_digests(rows))
    found = lookup(rows.select(F.col("row").alias("doc_id"), "n_points", "digest"), index, shards)
    return found.select(F.col("doc_id").alias(row_col), (F.col("doc_id") == F.col("winner")).alias("kept"))


SQL = r"""
with n as (
  select doc_id, length(coalesce(text, '')) as points,
    sha256(translate(coalesce(text, ''), chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) as text_sha256
  from documents),
g as (
  select *, first_value(doc_id) over (partition by text_sha256 order by points desc, doc_id nulls last) as keep_id,
    count(*) over (partition by text_sha256) as group_size
  from n)
select doc_id, keep_id, group_size, coalesce(doc_id = keep_id, doc_id is null and keep_id is null) as kept, text_sha256 from g
"""
