"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Texts are lower-cased and white space runs become one blank. A document holds an item if one of its
substrings is within the edit budget e of any ``WINDOW`` consecutive characters of the item (of the whole
item, if that is shorter): a stretch may start at every character.

1. Lemma: such a substring shares at least m - q + 1 - q * e q-grams with a stretch of m characters, and
   all of them lie on at most e + 1 neighbouring diagonals. Shared q-grams are sorted by item position within
   overlapping bands of diagonals, so that any e + 1 neighbours lie within one band.
2. Only regions are kept where a stretch reaches the bound; starts without a gap are one region.
3. Each kept region is verified by banded alignment (numpy): its stretches against the substring of the
   region, free ends in the document, until one is within the budget. Its edits are those reported.

The benchmark's items are broadcast block by block: a block holds at most ``BLOCK_CHARS``
characters of the benchmark, its proven size bound; a larger benchmark takes more passes, and a block is freed before
the next. A worker process keeps the index of one block. Documents are
scanned whole, without a shuffle; only with more than one block are the counts of a row summed by its number.

Nulls and empty texts hold nothing. An item shorter than q characters has no q-gram: it is searched as it is, standing between
blanks or text ends. An empty or null item contaminates nothing. Items of one text count each, items without an id
count as one together and come last. Repeated rows get equal answers. An empty table gives an empty result, an empty benchmark marks nothing. Only the named columns are read.
"""

from __future__ import annotations

import functools
import uuid

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logblocks.operators.staging import materialize
from logblocks.shipping import ship

Q = 12
WINDOW = 96
EDITS = 0.06  # edits a character of the window
BAND = 16  # diagonals from the start of one band to the start of the next
BLOCK_CHARS = 4_000_000
FILTER_BITS = 22
STEP = np.uint64(0x9E3779B97F4A7C15)


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def gram_hashes(points: np.ndarray, q: int) -> np.ndarray:
    """A hash of every q-gram, by doubling."""
    if len(points) < q:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        have, h, out, done = 1, points.astype(np.uint64) + np.uint64(1), None, 0
        factor = STEP
        while True:
            if q & have:
                if out is None:
                    out, done = h, have
                else:
                    n = len(points) - done - have + 1
                    power = np.uint64(pow(int(STEP), have, 1 << 64))
                    out, done = out[:n] * power + h[done : done + n], done + have
            if done == q:
                return (out ^ (out >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            h = h[:-have] * factor + h[have:]
            factor = factor * factor
            have *= 2


def budget(m: int, q: int = Q, edits: float = EDITS) -> int:
    """Edits allowed for a window of m characters: at least one q-gram must survive them."""
    return max(0, min(int(m * edits), (m - q) // q))


class Index:
    """q-grams of some benchmark items."""

    def __init__(self, items: list[tuple[int | None, str]], q: int = Q, window: int = WINDOW, edits: float = EDITS):
        self.q = q
        self.short: dict[str, list] = {}
        self.items: list[tuple[int | None, np.ndarray]] = []  # item, characters
        for item, text in items:
            points = codes(text)
            if not len(points):
                continue
            if len(points) < q:
                self.short.setdefault(text, []).append(item)
                continue
            self.items.append((item, points))
        self.words = ahocorasick.Automaton()
        for text in self.short:
            self.words.add_word(f" {text} ", text)
        if self.short:
            self.words.make_automaton()
        hashes = [gram_hashes(points, q) for _, points in self.items]
        flat = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(hashes)), [len(h) for h in hashes])
        offset = np.concatenate([np.arange(len(h)) for h in hashes]) if hashes else np.zeros(0, np.int64)
        order = np.argsort(flat, kind="stable")
        self.keys, first, counts = np.unique(flat[order], return_index=True, return_counts=True)
        self.first, self.counts = first, counts
        self.owner, self.offset = owner[order].astype(np.int64), offset[order].astype(np.int64)
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[(self.keys >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
        self.width = np.array([min(len(points), window) for _, points in self.items], np.int64)
        self.edits = np.array([budget(int(m), q, edits) for m in self.width], np.int64)
        self.need = self.width - q + 1 - q * self.edits

    def hits(self, points: np.ndarray):
        """Shared q-grams as (document position, item, item position)."""
        hashes = gram_hashes(points, self.q)
        at = np.flatnonzero(self.filter[(hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
        if not len(at):
            return at, at, at
        place = np.minimum(np.searchsorted(self.keys, hashes[at]), len(self.keys) - 1)
        true = self.keys[place] == hashes[at]
        at, place = at[true], place[true]
        n = self.counts[place]
        row = np.repeat(self.first[place] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        return np.repeat(at, n), self.owner[row], self.offset[row]

    def regions(self, points: np.ndarray):
        """(item, first diagonal, first start, last start) of the stretches that reach the lemma's bound.

        Along each band ``need`` shared q-grams must lie within one stretch of the item; starts that
        follow each other without a gap are one region.
        """
        at, item, offset = self.hits(points)
        if not len(at):
            return []
        diagonal = at - offset + (1 << 20)
        band = diagonal // BAND
        again = diagonal % BAND <= self.edits[item]  # also within reach of the band before
        band = np.concatenate([band, band[again] - 1])
        item, offset = np.concatenate([item, item[again]]), np.concatenate([offset, offset[again]])
        _, group, sizes = np.unique(item * (1 << 40) + band, return_inverse=True, return_counts=True)
        enough = (sizes >= np.maximum(self.need[item[np.unique(group, return_index=True)[1]]], 1))[group]
        item, band, offset, group = item[enough], band[enough], offset[enough], group[enough]
        order = np.lexsort((offset, group))
        item, band, offset, group = item[order], band[order], offset[order], group[order]
        ahead = np.arange(len(item)) + self.need[item] - 1
        inside = np.minimum(ahead, len(item) - 1)
        span = self.width[item] - self.q  # a stretch's q-grams start within so many characters
        run = (ahead < len(item)) & (group[inside] == group) & (offset[inside] - offset <= span)
        k = np.flatnonzero(run)
        if not len(k):
            return []
        lengths = np.array([len(p) for _, p in self.items], np.int64)
        low = np.maximum(0, offset[inside[k]] - span[k])
        high = np.minimum(offset[k], lengths[item[k]] - self.width[item[k]])
        low = np.minimum(low, high)
        new = np.ones(len(k), bool)
        new[1:] = (group[k][1:] != group[k][:-1]) | (low[1:] > high[:-1] + 1)
        cut = np.flatnonzero(new)
        low, high = np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut)
        k = k[cut]
        return list(zip(item[k].tolist(), (band[k] * BAND - (1 << 20)).tolist(), low.tolist(), high.tolist()))

    def find(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(item, start, end, edits) in the normalised text, one row per verified region."""
        flat = normal(text)
        points = codes(flat)
        found = set()
        for end, text in self.words.iter(f" {flat} ") if self.short and flat else ():
            found.update((item, end - 1 - len(text), end - 1, 0) for item in self.short[text])
        for item, diagonal, low, high in self.regions(points):
            name, whole = self.items[item]
            width, edits = int(self.width[item]), int(self.edits[item])
            # from the middle outwards: a quote's own stretches come first
            for s in sorted(range(low, high + 1), key=lambda s: abs(2 * s - low - high)):
                a = max(0, diagonal + s - edits)
                b = min(len(points), diagonal + s + BAND + 2 * edits + width)
                hit = align(whole[s : s + width], points[a:b], edits)
                if hit is not None:
                    found.add((name, a + hit[0], a + hit[1], hit[2]))
                    break
        return sorted(found, key=lambda hit: (hit[0] is None, hit))


def align(part: np.ndarray, region: np.ndarray, edits: int) -> tuple[int, int, int] | None:
    """Best alignment of all of ``part`` with a substring of ``region``: (start, end, edits) within the budget.

    The region is only a band of diagonals wide, so one row of the table per character of
    ``part`` over the region's width is the banded alignment. Rows are numpy operations: the
    insertions along a row are a running minimum.
    """
    n = len(region)
    ramp = np.arange(n + 1)
    cost, start = np.zeros(n + 1, np.int64), ramp.copy()
    for char in part:
        sub = cost[:-1] + (region != char)
        gap = cost + 1
        pick = sub < gap[1:]
        new = np.concatenate([[gap[0]], np.where(pick, sub, gap[1:])])
        new_start = np.concatenate([[start[0]], np.where(pick, start[:-1], start[1:])])
        # cheapest way along the row: min over j' <= j of new[j'] + (j - j')
        shifted = (new - ramp) * (n + 2) + (n + 1 - ramp)  # ties: the nearest cell
        best = np.minimum.accumulate(shifted)
        source = n + 1 - (best % (n + 2))
        cost, start = new[source] + ramp - source, new_start[source]
        if cost.min() > edits:
            return None
    end = int(np.argmin(cost))
    return (int(start[end]), end, int(cost[end])) if cost[end] <= edits else None


def benchmark_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", block_chars: int = BLOCK_CHARS):
    """The benchmark's normalised items in driver-sized blocks of bounded characters, one at a time."""
    rows = benchmark.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t")).where("t is not null")
    block, size = [], 0
    for row in rows.toLocalIterator():
        text = normal(row["t"])
        if block and size + len(text) > block_chars:
            yield block
            block, size = [], 0
        block.append((row["i"], text))
        size += len(text)
    if block:
        yield block


def matches(docs: DataFrame, benchmark: DataFrame, q: int = Q, window: int = WINDOW, edits: float = EDITS) -> DataFrame:
    """``(doc_id, item_id, start, end, edits)`` of every verified region (positions in the normalised text)."""
    spark = docs.sparkSession
    ship(spark)
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    schema = "doc_id long, item_id long, start long, end long, edits long"
    return _by_block(benchmark, BLOCK_CHARS, schema, lambda block: named.mapInArrow(_scan(block, q, window, edits), schema))


def _by_block(benchmark: DataFrame, block_chars: int, schema: str, work) -> DataFrame:
    """The results of ``work`` on every block; all but the only one are written and their block is freed."""
    spark, out, waiting = benchmark.sparkSession, [], None
    for items in benchmark_blocks(benchmark, block_chars=block_chars):
        if waiting is not None:
            out.append(materialize(work(waiting), "decontamination-block"))
            waiting.shared.unpersist()
        waiting = Block(spark, items)
    if waiting is None:
        return work(Block(spark, []))
    if not out:
        return work(waiting)
    out.append(materialize(work(waiting), "decontamination-block"))
    waiting.shared.unpersist()
    return functools.reduce(DataFrame.unionByName, out)


class Block:
    """A broadcast run of items; a worker process keeps the index that it made last."""

    _made: tuple = (None, None)

    def __init__(self, spark, items):
        self.name, self.shared = uuid.uuid4().hex, spark.sparkContext.broadcast(items)

    def index(self, q: int = Q, window: int = WINDOW, edits: float = EDITS) -> Index:
        key = (self.name, q, window, edits)
        if Block._made[0] != key:
            Block._made = (None, None)
            Block._made = (key, Index(self.shared.value, q, window, edits))
        return Block._made[1]


def _scan(block, q, window, edits):
    def body(batches):
        index = block.index(q, window, edits)
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                rows += [(doc, *hit) for hit in index.find(text)]
            if rows:
                cols = list(zip(*rows))
                names = ("doc_id", "item_id", "start", "end", "edits")
                yield pa.RecordBatch.from_pydict({n: pa.array(c, pa.int64()) for n, c in zip(names, cols)})

    return body


def _count(block):
    """One row per input row: its columns but the text, the ids of its items, regions and least edits."""

    def body(batches):
        index = block.index()
        for batch in batches:
            hits = [index.find(t) for t in batch.column("text").to_pylist()]
            found = {name: batch.column(name) for name in batch.schema.names if name != "text"}
            found["items"] = pa.array([list({h[0] for h in of}) for of in hits], pa.list_(pa.int64()))
            found["n_regions"] = pa.array([len(of) for of in hits], pa.int64())
            found["least_edits"] = pa.array([min((h[3] for h in of), default=None) for of in hits], pa.int64())
            yield pa.RecordBatch.from_pydict(found)

    return body


def _clean(block):
    """The rows of a batch whose text holds no item of the block."""

    def body(batches):
        index = block.index()
        for batch in batches:
            yield batch.filter(pa.array([not index.find(t) for t in batch.column("text").to_pylist()], pa.bool_()))

    return body


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item, whatever their ids; one pass over them for each block, nothing written for the last."""
    spark, waiting = docs.sparkSession, None
    ship(spark)
    for items in benchmark_blocks(benchmark):
        if waiting is not None:
            docs = materialize(docs.mapInArrow(_clean(waiting), docs.schema), "decontamination-left")
            waiting.shared.unpersist()
        waiting = Block(spark, items)
    return docs if waiting is None else docs.mapInArrow(_clean(waiting), docs.schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per document: doc_id, contaminated, n_items, n_regions, first_item (smallest), least_edits.

    Each row has its own answer, whatever its id. With more than one block of the benchmark the rows are
    written with a number first, by which the blocks' answers are put together.
    """
    spark = docs.sparkSession
    ship(spark)
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    schema = "doc_id long, items array<long>, n_regions long, least_edits long"
    if (benchmark.agg(F.sum(F.length("text") * 3)).first()[0] or 0) <= block_chars:  # one block: lower case is at most three times as long
        found = _by_block(benchmark, 1 << 62, schema, lambda block: named.mapInArrow(_count(block), schema))
    else:
        rows = materialize(named.withColumn("row", F.monotonically_increasing_id()), "decontamination-rows").select("row", "doc_id", "text")
        parts = _by_block(benchmark, block_chars, schema, lambda block: rows.mapInArrow(_count(block), f"row long, {schema}"))
        found = parts.groupBy("row").agg(
            F.max("doc_id").alias("doc_id"),
            F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
            F.sum("n_regions").alias("n_regions"),
            F.min("least_edits").alias("least_edits"),
        )
    return found.select(
        "doc_id",
        (F.col("n_regions") > 0).alias("contaminated"),
        F.size("items").cast("long").alias("n_items"),
        "n_regions",
        F.array_min("items").alias("first_item"),
        "least_edits",
    )
