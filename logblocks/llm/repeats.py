"""Removal of repeated byte strings by suffix arrays and their common-prefix interval trees.

Task: mark every byte that a string of ``LENGTH`` bytes covers which also starts earlier (in the smaller
doc_id, or in the same document). Any two equal strings of that length share their minimizer (the
least hash among their ``GRAM``-byte grams, leftmost), at the same place in both, so the work falls apart by minimizer:

1. Anchors. Tasks scan whole texts (numpy). An anchor is a run of neighbouring windows whose
   minimizer is at one place, some 35 on average; it is sent as the minimizer's hash, a hash of its context (all
   the bytes of its windows) and its place. Equal contexts collapse within a batch at once:
   all but the batch's first are repeats, whatever else there is.
2. ``settle``: anchors are dealt by hash, packed as arrays; hashes with one context go. Of equal contexts
   all but the first occurrence are repeats. Copies end here: a context is one entry a batch,
   whatever the number of its copies.
3. What differs within a hash is compared as text: the first occurrence of each context sends its
   bytes. Contexts are joined to one text, whose suffix array is built by prefix doubling, with the
   common-prefix lengths of neighbours. A stack scan over these yields the tree of intervals of
   at least ``LENGTH`` bytes; an interval with more than one left extension is a maximal repeat, emitted
   with all its occurrences in the shard; all but the earliest are repeats.
   A hash with more than ``HOT_CLASS`` different contexts (a common line in unlike surroundings) would make
   one task's text too long: its single windows are dealt by their own hashes and settled as in 2.
4. Spans are united per document and cut out of its bytes. Only texts with a repeat are shuffled.

Groups are maximal within their anchors' contexts and name the first place of each context; a longer
repeat is the union of the groups along it. The removed bytes are exact.

Memory: a task of steps 2 and 4 holds the anchors of one bucket, about ``SHARD_BYTES`` of text, and one Arrow batch; a task of step 1
``FLUSH`` anchors. Where ids repeat, the texts are written first with a number that tells the rows of one id apart.

Null texts are empty. The order is (doc_id, start); a null id is last. Rows that repeat a doc_id count as one
place in that order: their equal places do not remove each other, and each gets its own answer. Texts shorter than LENGTH lose
nothing. An empty table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logblocks.llm.common import partitions, whole
from logblocks.operators.staging import broadcast_if_small, materialize
from logblocks.shipping import ship

LENGTH = 100
GRAM = 32
LAST = (1 << 63) - 1
PACK = 1_000_000  # bytes of contexts in one suffix array
HOT_CLASS = 1_000
SHARD_BYTES = 8 << 20  # bytes of text to a bucket
TASK_BUCKETS = 4  # buckets that a task takes one after the other
FLUSH = 300_000  # anchors that a scan holds
STEP = np.uint64(0x9E3779B97F4A7C15)


def powers_of_two_hash(data: np.ndarray, n: int) -> np.ndarray:
    """A polynomial hash of every n-byte gram, n a power of two."""
    h, factor, have = data.astype(np.uint64) + np.uint64(1), STEP, 1
    with np.errstate(over="ignore"):
        while have < n:
            h = h[:-have] * factor + h[have:]
            factor, have = factor * factor, have * 2
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
    return h


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` neighbours, by doubling."""
    have, out = 1, values
    while have * 2 <= width:
        out, have = np.minimum(out[:-have], out[have:]), have * 2
    rest = width - have
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def anchors(data: np.ndarray):
    """(hash, context hash, start, windows) of every anchor of a text.

    An anchor's windows have their minimizer at one place, so no two of them are equal.
    """
    hashes = powers_of_two_hash(data, GRAM)
    least = sliding_min(hashes, LENGTH - GRAM + 1)  # one value a window
    # the leftmost least gram moves on where the value changes, or after the window that starts with it
    moves = (least[1:] != least[:-1]) | (hashes[: len(least) - 1] == least[:-1])
    first = np.flatnonzero(np.concatenate([[True], moves]))
    n = np.diff(np.concatenate([first, [len(least)]]))
    wide = powers_of_two_hash(data, 64)
    size = n + LENGTH - 1
    context = size.astype(np.uint64)
    with np.errstate(over="ignore"):  # three 64-byte grams cover a context
        for at in (first, first + np.minimum(52, size - 64), first + size - 64):
            context = (context ^ wide[at]) * STEP
            context ^= context >> np.uint64(31)
    return least[first], context, first, n


def window_anchors(data: np.ndarray, n: int):
    """The first ``n`` windows of a context as anchors of their own."""
    wide = powers_of_two_hash(data, 64)
    at = np.arange(n)
    with np.errstate(over="ignore"):
        one = wide[at] * STEP ^ wide[at + LENGTH - 64]
        two = (wide[at] ^ (wide[at + LENGTH - 64] >> np.uint64(7))) * STEP
    return one * STEP, two


class Kinds:
    """What shuffled rows pack. ``doc`` orders the documents, ``uid`` tells rows of one id apart (one byte where none repeat)."""

    def __init__(self, repeated: bool):
        place = [("doc", "<i8"), ("uid", "<i8" if repeated else "u1"), ("start", "<i4")]
        self.anchor = np.dtype([("hash", "<u8"), ("context", "<u8"), *place, ("n", "u1")])
        self.span = np.dtype([*place, ("end", "<i4")])
        self.request = np.dtype([*place, ("n", "u1"), ("hot", "u1"), ("hash", "<u8")])


PACKED = "kind string, bucket int, blob binary"


def bucket_of(values: np.ndarray, buckets: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = values.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return ((h ^ (h >> np.uint64(32))) % np.uint64(buckets)).astype(np.int64)


def packed(kind: str, items: np.ndarray, buckets: np.ndarray):
    """Rows of PACKED: one for each bucket that has items."""
    if not len(items):
        return
    order = np.argsort(buckets, kind="stable")
    items, buckets = items[order], buckets[order]
    cuts = np.concatenate([[0], np.flatnonzero(buckets[1:] != buckets[:-1]) + 1, [len(buckets)]])
    for a in range(0, len(cuts) - 1, 512):
        part = list(zip(cuts[a : a + 512], cuts[a + 1 : a + 513]))
        yield pa.RecordBatch.from_pydict(
            {
                "kind": [kind] * len(part),
                "bucket": pa.array([int(buckets[x]) for x, _ in part], pa.int32()),
                "blob": pa.array([items[x:y].tobytes() for x, y in part], pa.binary()),
            }
        )


def first_of_equal(found: np.ndarray):
    """Sorts anchors by (hash, context, doc, start); returns them and a flag for those after the first place of their context."""
    found = found[np.lexsort((found["start"], found["doc"], found["context"], found["hash"]))]
    new = np.ones(len(found), bool)
    new[1:] = (found["hash"][1:] != found["hash"][:-1]) | (found["context"][1:] != found["context"][:-1])
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    later = (found["doc"] != found["doc"][first]) | (found["start"] != found["start"][first])
    return found, later


def spans_of(found: np.ndarray, kinds: Kinds) -> np.ndarray:
    out = np.empty(len(found), kinds.span)
    for name in ("doc", "uid", "start"):
        out[name] = found[name]
    out["end"] = found["start"] + found["n"] + (LENGTH - 1)
    return out


def _emit(parts: list[np.ndarray], shards: int, kinds: Kinds):
    """Anchors of a batch: repeats within it as spans, the rest dealt by hash."""
    if not parts:
        return
    found, later = first_of_equal(np.concatenate(parts))
    spans = spans_of(found[later], kinds)
    yield from packed("span", spans, bucket_of(spans["doc"], shards))
    rest = found[~later]
    yield from packed("anchor", rest, bucket_of(rest["hash"], shards))


def _scan(shards: int, kinds: Kinds):
    def body(batches):
        for batch in batches:
            parts, size = [], 0
            docs, uids = batch.column("doc").to_pylist(), batch.column("uid").to_pylist()
            texts = batch.column("text")
            for k, (doc, uid) in enumerate(zip(docs, uids)):
                data = np.frombuffer(texts[k].as_buffer(), np.uint8)
                if len(data) < LENGTH:
                    continue
                hashes, contexts, start, n = anchors(data)
                found = np.empty(len(start), kinds.anchor)
                found["hash"], found["context"], found["start"], found["n"] = hashes, contexts, start, n
                found["doc"], found["uid"] = doc, uid
                parts.append(found)
                size += len(found)
                if size > FLUSH:
                    yield from _emit(parts, shards, kinds)
                    parts, size = [], 0
            yield from _emit(parts, shards, kinds)

    return body


def _settle(shards: int, hot_class: int, kinds: Kinds):
    """All anchors of one shard: repeats as spans; where contexts differ, requests for their bytes."""

    def body(batches):
        at, blobs = None, []
        for batch in batches:
            for bucket, blob in zip(batch.column("bucket").to_pylist(), batch.column("blob")):
                if bucket != at and blobs:
                    yield from settle(blobs)
                    blobs = []
                at = bucket
                blobs.append(np.frombuffer(blob.as_buffer(), kinds.anchor))
            blobs = [np.concatenate(blobs)] if blobs else []  # the batch itself can go
        if blobs:
            yield from settle(blobs)

    def settle(blobs):
        found, later = first_of_equal(np.concatenate(blobs))
        spans = spans_of(found[later], kinds)
        yield from packed("span", spans, bucket_of(spans["doc"], shards))
        found = found[~later]
        new_hash = np.concatenate([[True], found["hash"][1:] != found["hash"][:-1]])
        new_context = new_hash.copy()
        new_context[1:] |= found["context"][1:] != found["context"][:-1]
        index = np.cumsum(new_hash) - 1
        contexts = np.bincount(index, new_context).astype(np.int64)[index]  # different contexts of the hash
        ask = contexts > 1
        out = np.empty(ask.sum(), kinds.request)
        for name in ("doc", "uid", "start", "n", "hash"):
            out[name] = found[name][ask]
        out["hot"] = contexts[ask] > hot_class
        yield from packed("request", out, bucket_of(out["doc"], shards))

    return body


def _by_doc(items: np.ndarray) -> tuple[np.ndarray, dict]:
    """Items sorted by (doc, uid, start), and the slice of each document."""
    items = items[np.lexsort((items["start"], items["uid"], items["doc"]))]
    new = np.ones(len(items), bool)
    new[1:] = (items["doc"][1:] != items["doc"][:-1]) | (items["uid"][1:] != items["uid"][:-1])
    cuts = np.concatenate([np.flatnonzero(new), [len(items)]])
    return items, {(int(items["doc"][a]), int(items["uid"][a])): (a, b) for a, b in zip(cuts[:-1], cuts[1:])}


def _with_texts(dtype, each, finish=None):
    """Body over rows sorted by (bucket, kind): a bucket's blobs, then its texts, streamed.

    ``each(doc, uid, data, items)`` yields result batches for a text and its items.
    """

    def body(batches):
        bucket, blobs, items, slices = None, [], None, None
        for batch in batches:
            at = batch.column("bucket").to_pylist()
            kind, blob = batch.column("kind").to_pylist(), batch.column("blob")
            docs, uids, texts = batch.column("doc").to_pylist(), batch.column("uid").to_pylist(), batch.column("text")
            for k in range(batch.num_rows):
                if at[k] != bucket:
                    bucket, blobs, slices = at[k], [], None
                if kind[k] == 0:
                    blobs.append(blob[k].as_py())
                    continue
                if slices is None:
                    items, slices = _by_doc(np.frombuffer(b"".join(blobs), dtype))
                    blobs = []
                a, b = slices.get((docs[k], uids[k]), (0, 0))
                data = np.frombuffer(texts[k].as_buffer(), np.uint8)
                yield from each(docs[k], uids[k], data, items[a:b])
        if finish:
            yield from finish()

    return body


CONTEXTS = "kind string, bucket int, hash long, doc long, uid long, start int, n int, blob binary"


def _contexts(shards: int, kinds: Kinds):
    """The bytes of requested contexts; hot ones as packed windows."""

    def body(batches):
        cold, hot = [], []

        def flush_cold():
            yield pa.RecordBatch.from_pydict(
                {
                    "kind": ["context"] * len(cold),
                    "bucket": pa.array([c[0] for c in cold], pa.int32()),
                    "hash": pa.array([c[1] for c in cold], pa.int64()),
                    "doc": pa.array([c[2] for c in cold], pa.int64()),
                    "uid": pa.array([c[3] for c in cold], pa.int64()),
                    "start": pa.array([c[4] for c in cold], pa.int32()),
                    "n": pa.array([c[5] for c in cold], pa.int32()),
                    "blob": pa.array([c[6] for c in cold], pa.binary()),
                }
            )
            cold.clear()

        def flush_hot():
            for batch in _emit(hot, shards, kinds):
                none = lambda kind: pa.nulls(batch.num_rows, kind)
                yield pa.RecordBatch.from_pydict(
                    {
                        "kind": batch.column("kind"), "bucket": batch.column("bucket"), "hash": none(pa.int64()),
                        "doc": none(pa.int64()), "uid": none(pa.int64()), "start": none(pa.int32()), "n": none(pa.int32()),
                        "blob": batch.column("blob"),
                    }
                )
            hot.clear()

        def each(doc, uid, data, requests):
            buckets = bucket_of(requests["hash"], shards)
            for request, bucket in zip(requests, buckets.tolist()):
                a, n = int(request["start"]), int(request["n"])
                part = data[a : a + n + LENGTH - 1]
                if request["hot"]:
                    found = np.empty(n, kinds.anchor)
                    found["hash"], found["context"] = window_anchors(part, n)
                    found["doc"], found["uid"], found["start"], found["n"] = doc, uid, a + np.arange(n), 1
                    hot.append(found)
                else:
                    cold.append((bucket, int(request["hash"].view(np.int64)), doc, uid, a, n, part.tobytes()))
            if len(cold) >= 10_000:
                yield from flush_cold()
            if len(hot) >= 10_000:
                yield from flush_hot()

        def finish():
            if cold:
                yield from flush_cold()
            if hot:
                yield from flush_hot()

        yield from _with_texts(kinds.request, each, finish)(batches)

    return body


def suffix_array(data: np.ndarray, reach: int):
    """The suffix array of ``data`` by prefix doubling, in order up to ``reach`` bytes, and its neighbours' common prefixes."""
    size = len(data)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    word = np.ndarray((size,), ">u8", padded.tobytes(), strides=(1,)).astype(np.uint64)
    _, rank = np.unique(word, return_inverse=True)
    ranks, have = [(8, rank)], 8
    order = None
    while have < reach:
        after = np.full(size, -1, np.int64)
        after[: size - have] = rank[have:]
        key = rank * np.int64(size + 1) + after + 1
        order = np.argsort(key, kind="stable")
        key = key[order]
        rank = np.empty(size, np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]]))
        have *= 2
        ranks.append((have, rank))
    a, b = order[:-1].copy(), order[1:].copy()
    common = np.zeros(size, np.int64)
    for step, rank in reversed(ranks):
        inside = np.maximum(a, b) < size
        same = np.zeros(size - 1, bool)
        same[inside] = rank[a[inside]] == rank[b[inside]]
        a, b = a + step * same, b + step * same
        common[1:] += step * same
    tail = np.concatenate([word, np.zeros(8, np.uint64)])
    apart = tail[np.minimum(a, size)] ^ tail[np.minimum(b, size)]
    for k in range(7):  # the bytes within the last, unequal word
        same = apart < np.uint64(1) << np.uint64(8 * (7 - k))
        common[1:] += same
    return order, common


def intervals(common: np.ndarray, least: int):
    """(length, first, last) of the common-prefix intervals of at least ``least`` bytes, by a stack scan."""
    deep = common >= least
    starts = np.flatnonzero(deep & ~np.concatenate([[False], deep[:-1]]))
    ends = np.flatnonzero(deep & ~np.concatenate([deep[1:], [False]]))
    for a, b in zip(starts.tolist(), ends.tolist()):
        stack: list[tuple[int, int]] = []
        values = common[a : b + 1].tolist()
        for k, value in enumerate([*values, 0]):
            left = a + k - 1
            while stack and stack[-1][0] > value:
                length, left = stack.pop()
                yield length, left, a + k - 1
            if value >= least and (not stack or stack[-1][0] < value):
                stack.append((value, left))


def maximal_repeats(texts: list[bytes], least: int = LENGTH):
    """(length, places) of the maximal repeats of some texts; a place is an index into their concatenation.

    Texts must not hold the byte 0xFF, which UTF-8 never does.
    """
    data = np.frombuffer(b"\xff".join(texts) + b"\xff", np.uint8)
    longest = max(map(len, texts))
    order, common = suffix_array(data, longest + 1)
    size = np.array([len(t) + 1 for t in texts])
    end = np.repeat(np.cumsum(size) - 1, size)  # where each place's text ends
    left_bytes = end - np.arange(len(data))
    common[1:] = np.minimum(common[1:], np.minimum(left_bytes[order[1:]], left_bytes[order[:-1]]))
    before = np.concatenate([[255], data[:-1]])[order]
    turn = np.zeros(len(data), np.int64)
    turn[1:] = (before[1:] != before[:-1]) | (before[1:] == 255)  # a text's start extends to nothing
    turns = np.cumsum(turn)
    for length, a, b in intervals(common, least):
        if turns[b] > turns[a]:
            yield length, order[a : b + 1]


def _compare(shards: int, kinds: Kinds, with_groups: bool = False):
    """The contexts of one shard, in runs of whole hashes: repeats as spans (or the groups themselves)."""

    def run(rows):
        texts = [r[5] for r in rows]
        size = np.array([len(t) + 1 for t in texts])
        at = np.cumsum(size) - size
        owner = np.repeat(np.arange(len(texts)), size)
        doc = np.array([r[1] for r in rows], np.int64)
        uid = np.array([r[2] for r in rows], np.int64)
        start = np.array([r[3] for r in rows], np.int64)
        place = start[owner] + np.arange(len(owner)) - at[owner]  # in the document
        rank = np.empty(len(owner), np.int64)
        by_order = np.lexsort((place, doc[owner]))
        sorted_doc, sorted_place = doc[owner][by_order], place[by_order]
        rank[by_order] = np.cumsum(
            np.concatenate([[0], (sorted_doc[1:] != sorted_doc[:-1]) | (sorted_place[1:] != sorted_place[:-1])])
        )
        covered = np.zeros(len(owner), np.int64)
        for length, places in maximal_repeats(texts):
            ranks = rank[places]
            if with_groups:
                yield length, doc[owner[places]], place[places]
                continue
            later = places[ranks > ranks.min()]
            covered[later] = np.maximum(covered[later], length)
        if with_groups:
            return
        hit = np.flatnonzero(covered)
        spans = np.empty(len(hit), kinds.span)
        spans["doc"], spans["uid"] = doc[owner[hit]], uid[owner[hit]]
        spans["start"], spans["end"] = place[hit], place[hit] + covered[hit]
        yield spans

    def runs(batches):
        rows, size, last = [], 0, None
        for batch in batches:
            names = ("hash", "doc", "uid", "start", "n", "blob")
            for row in zip(*(batch.column(c).to_pylist() for c in names)):
                if size > PACK and row[0] != last:
                    yield rows
                    rows, size = [], 0
                rows.append(row)
                size, last = size + len(row[5]), row[0]
        if rows:
            yield rows

    def body(batches):
        for rows in runs(batches):
            if with_groups:
                for length, docs, places in run(rows):
                    yield pa.RecordBatch.from_pydict(
                        {"length": pa.array([length], pa.int64()), "docs": pa.array([docs.tolist()]), "starts": pa.array([places.tolist()])}
                    )
                continue
            for spans in run(rows):
                yield from packed("span", spans, bucket_of(spans["doc"], shards))

    return body


def united(spans: np.ndarray) -> list[tuple[int, int]]:
    """Sorted spans as maximal runs."""
    out: list[list[int]] = []
    for a, b in zip(spans["start"].tolist(), spans["end"].tolist()):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


RESULT = "doc long, uid long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _cut(kinds: Kinds):
    def body(batches):
        done = []

        def flush():
            yield pa.RecordBatch.from_pydict(
                {
                    "doc": pa.array([d[0] for d in done], pa.int64()),
                    "uid": pa.array([d[1] for d in done], pa.int64()),
                    "n_bytes": pa.array([d[2] for d in done], pa.int64()),
                    "n_removed": pa.array([d[3] for d in done], pa.int64()),
                    "n_spans": pa.array([d[4] for d in done], pa.int64()),
                    "kept_sha256": [d[5] for d in done],
                }
            )
            done.clear()

        def each(doc, uid, data, spans):
            runs, at, kept = united(spans), 0, hashlib.sha256()
            for a, b in runs:
                kept.update(data[at:a])
                at = b
            kept.update(data[at:])
            done.append((doc, uid, len(data), sum(b - a for a, b in runs), len(runs), kept.hexdigest()))
            if len(done) >= 5_000:
                yield from flush()

        yield from _with_texts(kinds.span, each, lambda: flush() if done else ())(batches)

    return body


class Repeats:
    """The steps over one table of documents; ``spans`` and ``contexts`` are written tables."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot_class: int = HOT_CLASS):
        self.spark, self.hot_class = docs.sparkSession, hot_class
        ship(self.spark)
        ids = docs.groupBy(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST))).agg(F.count(F.lit(1)).alias("n"))
        repeated = not ids.where("n > 1").isEmpty()
        self.texts = docs.select(
            F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("doc"),
            (F.monotonically_increasing_id() if repeated else F.lit(0).cast("long")).alias("uid"),
            whole(F.col(text_col)).cast("binary").alias("text"),
        )
        if repeated:
            self.texts = materialize(self.texts, "repeat-texts")
        self.kinds = kinds = Kinds(repeated)
        total = self.texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        self.shards = max(partitions(self.spark), -(-total // SHARD_BYTES))
        self.tasks = max(partitions(self.spark), -(-self.shards // TASK_BUCKETS))
        scanned = materialize(self.texts.mapInArrow(_scan(self.shards, kinds), PACKED), "repeat-anchors")
        settled = materialize(self._settled(scanned), "repeat-settled")
        self.spans = [scanned, settled]
        asked = settled.where("kind = 'request'")
        found = materialize(self._joined(asked, kinds.request).mapInArrow(_contexts(self.shards, kinds), CONTEXTS), "repeat-contexts")
        self.contexts = found.where("kind = 'context'").repartition(self.tasks, "bucket").sortWithinPartitions("bucket", "hash")
        self.spans.append(found.select("kind", "bucket", "blob"))
        self.spans.append(self._settled(found.select("kind", "bucket", "blob")))

    def _settled(self, rows: DataFrame) -> DataFrame:
        dealt = rows.where("kind = 'anchor'").select("bucket", "blob").repartition(self.tasks, "bucket")
        return dealt.sortWithinPartitions("bucket").mapInArrow(_settle(self.shards, self.hot_class, self.kinds), PACKED)

    def _joined(self, blobs: DataFrame, dtype: np.dtype) -> DataFrame:
        """Blobs and the texts they are about, by document bucket, blobs first."""

        def named(batches):
            for batch in batches:
                docs = [np.unique(np.frombuffer(b, dtype)["doc"]) for b in batch.column("blob").to_pylist()]
                yield pa.RecordBatch.from_pydict(
                    {"doc": np.concatenate(docs), "bucket": np.repeat(batch.column("bucket").to_numpy(), [len(d) for d in docs]).astype(np.int32)}
                )

        wanted = blobs.select("bucket", "blob").mapInArrow(named, "doc long, bucket int").distinct()
        wanted = broadcast_if_small(materialize(wanted, "repeat-docs"))
        none = lambda kind: F.lit(None).cast(kind)
        return (
            blobs.select("bucket", F.lit(0).alias("kind"), "blob", none("long").alias("doc"), none("long").alias("uid"), none("binary").alias("text"))
            .unionByName(
                self.texts.join(wanted, "doc").select("bucket", F.lit(1).alias("kind"), none("binary").alias("blob"), "doc", "uid", "text")
            )
            .repartition(self.tasks, "bucket")
            .sortWithinPartitions("bucket", "kind")
        )

    def groups(self) -> DataFrame:
        """``(length, docs, starts)``: the maximal repeats with all their places, the first of each context."""
        return self.contexts.mapInArrow(_compare(self.shards, self.kinds, True), "length long, docs array<long>, starts array<long>")

    def removed(self) -> DataFrame:
        """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
        compared = self.contexts.mapInArrow(_compare(self.shards, self.kinds), PACKED)
        blobs = compared
        for part in self.spans:
            blobs = blobs.unionByName(part.where("kind = 'span'"))
        blobs = materialize(blobs.where("kind = 'span'"), "repeat-spans")
        cut = materialize(self._joined(blobs, self.kinds.span).mapInArrow(_cut(self.kinds), RESULT), "repeat-cut")
        plain = self.texts.select("doc", "uid", F.octet_length("text").cast("long").alias("size"), F.sha2("text", 256).alias("sha"))
        zero = F.lit(0).cast("long")
        joined = plain.join(cut, ["doc", "uid"], "left")
        return joined.select(
            F.when(F.col("doc") != LAST, F.col("doc")).alias("doc_id"),
            F.col("size").alias("n_bytes"),
            F.coalesce("n_removed", zero).alias("n_removed"),
            F.coalesce("n_spans", zero).alias("n_spans"),
            F.coalesce("kept_sha256", "sha").alias("kept_sha256"),
        )


def remove_repeats(docs: DataFrame, hot_class: int = HOT_CLASS) -> DataFrame:
    return Repeats(docs, hot_class=hot_class).removed()
