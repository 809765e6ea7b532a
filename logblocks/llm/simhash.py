"""SimHash near-dedup by tiled exact comparison.

1. ``fingerprints``: 64-bit SimHash over word shingles, repeats included, in Arrow batches.
   Only ``(doc_id, fp)`` goes on.
2. Equal fingerprints collapse first, so a group of copies of any size is one fingerprint.
3. Distinct fingerprints form classes by the population counts of their two halves (at most
   33 x 33). Two fingerprints can only link if the counts of their classes differ by no more
   than the radius in sum; other tile pairs are skipped. Classes are cut into tiles of bounded
   size, one packed row each.
4. Every remaining pair of tiles is compared completely: exclusive-or and bit counts in numpy.
   A pair of tiles emits a spanning forest of its links, at most one link per fingerprint,
   so a dense group does not emit all its pairs and no connection is lost.
5. Components by alternating star contraction (``connected_components``).

Null texts count as empty; a text without words has the fingerprint zero and links like any
other. The component id is the smallest doc_id reachable; null ids are only used if there is
no other. Repeated rows share fingerprint and component. An empty table gives an empty result.
Only the id and text columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logblocks.llm.common import partitions
from logblocks.llm.components import connected_components
from logblocks.operators.staging import materialize
from logblocks.shipping import ship

TILE = 8_192
STRIP = 64  # rows of a tile compared with the other tile at a time
SEED = 42


def _lanes() -> np.ndarray:
    """For each byte value a word of eight lanes, lane i holding bit i."""
    bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
    return np.ascontiguousarray(bits).view("<u8").ravel()


LANES = _lanes()


def majority(hashes: np.ndarray) -> int:
    """The word whose bits are set in over half of the hashes."""
    n = len(hashes)
    if not n:
        return 0
    lanes = LANES[hashes.view(np.uint8).reshape(n, 8)]
    sums = np.add.reduceat(lanes, np.arange(0, n, 255), axis=0)  # a lane counts to 255 at most
    counts = np.ascontiguousarray(sums).view(np.uint8).sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def text_fingerprint(text: str | None, shingle: int, seed: int = SEED) -> int:
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    flat = b" ".join(words)
    ends = ends.tolist()[min(shingle, len(words)) - 1 :]
    return majority(np.array([xxh64_intdigest(flat[a:b], seed) for a, b in zip(starts, ends)], "<u8"))


def fingerprints(
    docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None
) -> DataFrame:
    """``(doc_id, fp)``: the fingerprint of every row as a signed long; with ``row_col`` also its number ``row``."""
    ship(docs.sparkSession)

    def body(batches):
        for batch in batches:
            found = [text_fingerprint(t, shingle) for t in batch.column("text").to_pylist()]
            kept = {name: batch.column(name) for name in names}
            yield pa.RecordBatch.from_pydict(kept | {"fp": np.array(found, np.uint64).view(np.int64)})

    ids = [F.col(id_col).cast("long").alias("doc_id"), *([F.col(row_col).alias("row")] if row_col else [])]
    names = ["doc_id", "row"][: len(ids)]
    return docs.select(*ids, F.col(text_col).alias("text")).mapInArrow(body, "".join(f"{n} long, " for n in names) + "fp long")


def _pack(rows: pa.Table) -> pa.Table:
    first = rows.slice(0, 1).select(["a", "b", "part"])
    fps = np.sort(rows.column("fp").to_numpy())
    return first.append_column("fps", pa.array([fps.astype("<i8").tobytes()], pa.binary()))


def _flatten(labels: np.ndarray) -> np.ndarray:
    while True:
        above = labels[labels]
        if (above == labels).all():
            return labels
        labels = above


def forest(left: np.ndarray, right: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, root) that span the links between two tiles, or inside one if ``right`` is None."""
    nodes = left if right is None else np.concatenate([left, right])
    other, shift = (left, 0) if right is None else (right, len(left))
    labels = np.arange(len(nodes))
    for a in range(0, len(left), STRIP):
        near = np.bitwise_count(left[a : a + STRIP, None] ^ other[None, :]) <= radius
        i, j = np.nonzero(near)
        i, j = i + a, j + shift
        while len(i):
            x, y = labels[i], labels[j]
            open_links = x != y
            if not open_links.any():
                break
            i, j, x, y = i[open_links], j[open_links], x[open_links], y[open_links]
            np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
            labels = _flatten(labels)
    moved = np.flatnonzero(labels != np.arange(len(nodes)))
    return nodes[moved], nodes[labels[moved]]


def _compare(radius: int):
    def body(batches):
        left, key = None, None
        for batch in batches:
            for row in batch.to_pylist():
                fps = np.frombuffer(row["fps"], "<u8")
                if row["lo"] == row["hi"]:
                    u, v = forest(fps, None, radius)
                elif row["side"] == 0:
                    left, key = fps, (row["lo"], row["hi"])
                    continue
                else:
                    assert key == (row["lo"], row["hi"])
                    u, v = forest(left, fps, radius)
                if len(u):
                    yield pa.RecordBatch.from_pydict({"u": u.view(np.int64), "v": v.view(np.int64)})

    return body


def links(distinct: DataFrame, radius: int, tile: int = TILE) -> DataFrame:
    """Edges ``(u, v)`` that span all links between the distinct fingerprints ``(fp)``."""
    spark = distinct.sparkSession
    ship(spark)
    low = F.lit(0xFFFFFFFF).cast("long")
    classed = distinct.select(
        "fp",
        F.bit_count(F.col("fp").bitwiseAND(low)).alias("a"),
        F.bit_count(F.shiftrightunsigned("fp", 32)).alias("b"),
    )
    # at most 33 x 33 rows
    classes = classed.groupBy("a", "b").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("parts"))
    classes = F.broadcast(materialize(classes, "simhash-classes"))
    tiles = (
        classed.join(classes, ["a", "b"])
        .withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
        .groupBy("a", "b", "part")
        .applyInArrow(_pack, "a int, b int, part int, fps binary")
    )
    tiles = materialize(tiles, "simhash-tiles")
    partner = classes.select(F.col("a").alias("a2"), F.col("b").alias("b2"), "parts")
    own, other = F.struct("a", "b", "part"), F.struct(F.col("a2"), F.col("b2"), F.col("part2"))
    name = lambda s: F.concat_ws("-", s["a"], s["b"], s["part"])
    pairs = (
        tiles.join(partner, F.abs(F.col("a") - F.col("a2")) + F.abs(F.col("b") - F.col("b2")) <= radius)
        .withColumn("part2", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(
            "fps",
            F.concat_ws("-", "a", "b", "part").alias("own"),
            F.concat_ws("-", "a2", "b2", "part2").alias("other"),
        )
        .select(
            "fps",
            F.least("own", "other").alias("lo"),
            F.greatest("own", "other").alias("hi"),
            (F.col("own") > F.col("other")).cast("int").alias("side"),
        )
    )
    dealt = pairs.repartition(partitions(spark) * 4, "lo", "hi").sortWithinPartitions("lo", "hi", "side")
    return dealt.mapInArrow(_compare(radius), "u long, v long")


def components(prints: DataFrame, radius: int) -> DataFrame:
    """``(doc_id, fp, component_id)`` of written fingerprints ``(doc_id, fp)``."""
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    edges = materialize(links(distinct, radius), "simhash-links")
    roots = connected_components(edges).withColumnRenamed("node", "fp")
    rooted = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    per_print = rooted.join(smallest, "root").select("fp", "component_id")
    return prints.join(materialize(per_print, "simhash-components"), "fp").select("doc_id", "fp", "component_id")


def simhash_dedup(
    docs: DataFrame, shingle: int = 4, radius: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    prints = materialize(fingerprints(docs, shingle, id_col, text_col), "simhash-prints")
    return components(prints, radius).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def kept_rows(
    docs: DataFrame, row_col: str, shingle: int = 4, radius: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(row_col, kept)`` by unique row numbers: of each component exactly one row stays.

    It has the component's smallest doc_id (null ids come last); of rows that share it the first.
    """
    prints = materialize(fingerprints(docs, shingle, id_col, text_col, row_col), "simhash-prints")
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), "row")
    found = components(prints.select(key.alias("doc_id"), "fp"), radius)
    same = F.col("doc_id")["row"] == F.col("component_id")["row"]
    return found.select(F.col("doc_id")["row"].alias(row_col), same.alias("kept"))
