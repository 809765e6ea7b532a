"""Hard-negative mining over a GNAT-style multiway hyperplane tree.

A vector's score with an anchor is an inner product. One more component, ``sqrt(M - |x|^2)`` for a row and 0 for an anchor,
gives all rows the length M, so that a score window is an annulus of Euclidean distances around the anchor.

* A node has up to ``FANOUT`` split points; a row belongs to its nearest one. For every split point i and every child j
  the node stores the least and greatest distance from i to the rows of j. By the triangle inequality each range bounds the
  distance from an anchor to all rows of j; j is left out if no window of the anchor meets all its ranges. Leaves are compared exactly.
* The upper tree is grown from a bounded sample (``SAMPLE`` rows of smallest hash); all rows are routed through it and its ranges
  are those of all rows. The rows of a leaf are dealt into blocks of about ``BLOCK_BYTES``, and each block is a tree of its own, grown in a task.
* A search sends each anchor to the blocks that its windows leave, and streams the anchors of a block past its tree;
  a block with many anchors is copied to several tasks. Each gives its best five, the best five of these stay.
* Positives are searched in the anchor's own leaf first; the fifth score found bounds the search of all other blocks. Negatives are searched
  in one annulus per positive, whose outer radius shrinks as it fills.

The answers are exact. Of equal vectors of one label only the ``TAKE + 1`` smallest ids can be chosen, so only these enter the tree; a vector
that a third of all rows hold is cut by a partial rank before the shuffle. Nothing but the sample, the upper tree (at most
``TOP_LEAVES`` leaves) and the number of rows per leaf reaches the driver.

Rows with a null label, a null vector or a null or non-finite component take no part. A null vec_id is no anchor and comes last among
ties; rows that repeat a vec_id are rows of their own. A shorter vector is filled up with zeros, an empty one is all zeros. Products that a
double cannot hold exactly are computed as whole numbers of any length; a score beyond a long is given as the largest or smallest long. An empty
table gives an empty result. Only the three columns are read, so others cannot clash.
"""

from __future__ import annotations

import math
import pickle
from dataclasses import dataclass, field
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logblocks.llm.common import partitions
from logblocks.operators.staging import materialize
from logblocks.shipping import ship

TAKE = 5
FANOUT = 8
LEAF_ROWS = 64
BLOCK_BYTES = 2 << 20  # of a block's vectors at 8 bytes a component
SAMPLE, SAMPLE_BYTES = 4_096, 32 << 20
TOP_LEAVES = 512
PROBES = 1_024  # anchors that one task compares with a block
EXACT = 2.0**52  # up to here inner products are whole doubles
LONG = (1 << 63) - 1
EDGE = 10**30  # larger scores count as equal


@dataclass
class Space:
    """What all tasks know of the vectors: their size, the squared length M of all rows after lifting."""

    dim: int
    m2: float

    @property
    def wide(self) -> bool:
        return self.m2 >= EXACT

    @property
    def slack(self) -> float:
        """Above the rounding error of a distance."""
        return 1e-6 * math.sqrt(self.m2) + 1e-6

    def matrix(self, lists: pa.ListArray) -> np.ndarray:
        """A list column as rows of ``dim`` components, filled up with zeros."""
        sizes = np.diff(lists.offsets.to_numpy())
        flat = lists.values.slice(lists.offsets[0].as_py(), int(sizes.sum())).to_numpy(zero_copy_only=False)
        out = np.zeros((len(lists), self.dim), np.int64)
        out[np.arange(self.dim) < sizes[:, None]] = flat
        return out

    def lift(self, v: np.ndarray) -> np.ndarray:
        """The rows with their additional component."""
        v = v.astype(np.float64)
        return np.column_stack([v, np.sqrt(np.maximum(self.m2 - (v * v).sum(axis=1), 0))])

    def apart(self, x: np.ndarray, y: np.ndarray, norms: np.ndarray | float) -> np.ndarray:
        """Distances between lifted rows x, of squared lengths ``norms``, and lifted rows y of length M."""
        return np.sqrt(np.maximum(np.reshape(norms, (-1, 1)) + self.m2 - 2 * (x @ y.T), 0))

    def scores(self, a: np.ndarray, v: np.ndarray) -> np.ndarray:
        if self.wide:
            return a.astype(object) @ v.astype(object).T
        return a.astype(np.float64) @ v.astype(np.float64).T


@dataclass
class Node:
    """Split points with distance ranges to every child; a leaf has the numbers of its rows instead."""

    rows: np.ndarray | None = None
    splits: np.ndarray | None = None
    lo: np.ndarray | None = None
    hi: np.ndarray | None = None
    children: list["Node"] = field(default_factory=list)
    number: int = -1
    path: tuple = ()


def _split_points(lifted: np.ndarray, space: Space) -> np.ndarray:
    """Rows far from each other, of evenly spaced candidates; each next one is farthest from those taken."""
    candidates = lifted[np.linspace(0, len(lifted) - 1, min(len(lifted), 3 * FANOUT)).astype(int)]
    taken = [0]
    nearest = np.full(len(candidates), np.inf)
    while len(taken) < FANOUT:
        nearest = np.minimum(nearest, space.apart(candidates, candidates[taken[-1:]], space.m2)[:, 0])
        if nearest.max() <= space.slack:
            break
        taken.append(int(nearest.argmax()))
    return candidates[taken]


def grow(lifted: np.ndarray, space: Space, leaf_rows: int) -> Node:
    """A tree over lifted rows; equal rows that no split point tells apart end in one leaf."""
    root = Node(rows=np.arange(len(lifted)))
    stack = [root]
    while stack:
        node = stack.pop()
        if len(node.rows) <= leaf_rows:
            continue
        here = lifted[node.rows]
        splits = _split_points(here, space)
        apart = space.apart(here, splits, space.m2)
        nearest = apart.argmin(axis=1)
        used = np.unique(nearest)
        if len(used) < 2:
            continue
        node.splits, apart = splits[used], apart[:, used]
        mine = [np.flatnonzero(nearest == j) for j in used]
        node.lo = np.stack([apart[m].min(axis=0) for m in mine], axis=1)
        node.hi = np.stack([apart[m].max(axis=0) for m in mine], axis=1)
        node.children = [Node(rows=node.rows[m]) for m in mine]
        node.rows = None
        stack += node.children
    return root


def child_scores(node: Node, probes: np.ndarray, norms: np.ndarray, space: Space):
    """The least and greatest score that a row of each child can have with each probe."""
    d = space.apart(probes, node.splits, norms)[:, :, None]
    nearest = np.maximum(np.maximum(d - node.hi, node.lo - d).max(axis=1) - space.slack, 0)
    farthest = (d + node.hi).min(axis=1) + space.slack
    middle = (norms[:, None] + space.m2) / 2
    rounding = 1e-9 * middle + 0.5
    return middle - farthest**2 / 2 - rounding, middle - nearest**2 / 2 + rounding


def meets(least: np.ndarray, greatest: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Whether any window [low, high] of a probe meets the scores that a subtree can have."""
    return ((greatest[:, None] >= low) & (least[:, None] <= high) & (low <= high)).any(axis=1)


class Search:
    """The best ``TAKE`` rows in each window of some probes, over any number of trees."""

    def __init__(self, space: Space, vectors, labels, rows, low, high, same: bool):
        self.space, self.same = space, same
        self.vectors, self.labels, self.rows = vectors, labels, rows
        self.lifted = np.column_stack([vectors.astype(np.float64), np.zeros(len(vectors))])
        self.norms = (self.lifted**2).sum(axis=1)
        self.low, self.high = low, high
        self.best = [[[] for _ in range(low.shape[1])] for _ in range(len(vectors))]

    def walk(self, root: Node, block: dict) -> None:
        everyone = np.arange(len(self.vectors))
        stack = [(root, everyone, np.full(len(everyone), -np.inf), np.full(len(everyone), np.inf))]
        while stack:
            node, probes, least, greatest = stack.pop()
            keep = meets(least, greatest, self.low[probes], self.high[probes])  # the windows may have shrunk
            probes = probes[keep]
            if not len(probes):
                continue
            if node.rows is not None:
                self._leaf(node.rows, probes, block)
                continue
            least, greatest = child_scores(node, self.lifted[probes], self.norms[probes], self.space)
            for j in np.argsort(greatest.mean(axis=0), kind="stable"):  # the most promising one is popped first
                stack.append((node.children[j], probes, least[:, j], greatest[:, j]))

    def _leaf(self, rows: np.ndarray, probes: np.ndarray, block: dict) -> None:
        scores = self.space.scores(self.vectors[probes], block["vectors"][rows])
        fits = block["labels"][rows] == self.labels[probes][:, None]
        if not self.same:
            fits = ~fits
        else:
            fits &= block["rows"][rows] != self.rows[probes][:, None]
        for w in range(self.low.shape[1]):
            hit = fits & (scores >= self.low[probes, w][:, None]) & (scores <= self.high[probes, w][:, None])
            for a in np.flatnonzero(hit.any(axis=1)):
                probe, at = probes[a], np.flatnonzero(hit[a])
                best = self.best[probe][w]
                ids, numbers = block["ids"][rows[at]], block["rows"][rows[at]]
                best += zip((-int(s) for s in scores[a, at]), ids.tolist(), numbers.tolist())
                best.sort()
                del best[TAKE:]
                if len(best) == TAKE:
                    self.low[probe, w] = max(self.low[probe, w], -best[-1][0])


# --- the index ------------------------------------------------------------------------------------------------------


def vectors(table: DataFrame) -> DataFrame:
    """``(row, vec_id, label, v)`` of the rows that take part, written; labels moved, components made whole."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("long"))
    rows = table.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & fine).select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), moved.cast("long").alias("label"), whole.alias("v")
    )
    return materialize(rows, "vectors")


def distinct_rows(rows: DataFrame) -> DataFrame:
    """Of the rows with equal vector and label those of smallest id that can be chosen."""
    order = Window.partitionBy("v", "label").orderBy(F.col("vec_id").asc_nulls_last(), "row")
    return rows.withColumn("copy", F.row_number().over(order)).where(F.col("copy") <= TAKE + 1).drop("copy")


class Top:
    """The upper tree, numbered: routes rows to leaves and knows each leaf's blocks."""

    def __init__(self, root: Node, space: Space):
        self.root, self.space = root, space
        self.nodes, self.leaves, stack = [], [], [root]
        while stack:
            node = stack.pop()
            kind = self.leaves if node.rows is not None else self.nodes
            node.number = len(kind)
            kind.append(node)
            for j, child in enumerate(node.children):
                child.path = (*node.path, (node.number, j))
            stack += node.children
        for leaf in self.leaves:
            leaf.rows = np.zeros(0, int)
        self.first = np.zeros(len(self.leaves) + 1, np.int64)

    def route(self, lifted: np.ndarray, norms) -> np.ndarray:
        """The leaf of each lifted row."""
        out = np.zeros(len(lifted), np.int64)
        stack = [(self.root, np.arange(len(lifted)))]
        while stack:
            node, mine = stack.pop()
            if node.rows is not None:
                out[mine] = node.number
                continue
            nearest = self.space.apart(lifted[mine], node.splits, norms[mine] if np.ndim(norms) else norms).argmin(axis=1)
            stack += [(child, part) for j, child in enumerate(node.children) if len(part := mine[nearest == j])]
        return out

    def set_blocks(self, counts: dict[int, int], block_rows: int) -> None:
        """Numbers the blocks of all leaves from the rows per leaf."""
        sizes = [math.ceil(counts.get(k, 0) / block_rows) for k in range(len(self.leaves))]
        self.first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)

    def set_ranges(self, found) -> None:
        for node in self.nodes:
            shape = (len(node.splits), len(node.children))
            node.lo, node.hi = np.full(shape, np.inf), np.full(shape, -np.inf)  # a child without rows is never met
        for number, child, split, lo, hi in found:
            self.nodes[number].lo[split, child], self.nodes[number].hi[split, child] = lo, hi

    def reached(self, probes: np.ndarray, norms: np.ndarray, low: np.ndarray, high: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """``(leaf, probes)``: the leaves that each probe's windows leave."""
        found, stack = [], [(self.root, np.flatnonzero((low <= high).any(axis=1)))]
        while stack:
            node, mine = stack.pop()
            if node.rows is not None:
                found.append((node.number, mine))
                continue
            least, greatest = child_scores(node, probes[mine], norms[mine], self.space)
            for j, child in enumerate(node.children):
                keep = mine[meets(least[:, j], greatest[:, j], low[mine], high[mine])]
                if len(keep):
                    stack.append((child, keep))
        return found


BLOCK = "block long, tree binary, ranges array<struct<node:int,child:int,split:int,lo:double,hi:double>>"


def _block_builder(top: Top, space: Space):
    ranges = pa.list_(pa.struct([("node", pa.int32()), ("child", pa.int32()), ("split", pa.int32()), ("lo", pa.float64()), ("hi", pa.float64())]))

    def build(rows: pa.Table) -> pa.Table:
        v = space.matrix(rows.column("v").combine_chunks())
        lifted = space.lift(v)
        found = []
        for number, child in top.leaves[rows.column("leaf")[0].as_py()].path:
            apart = space.apart(lifted, top.nodes[number].splits, space.m2)
            for split, (lo, hi) in enumerate(zip(apart.min(axis=0), apart.max(axis=0))):
                found.append({"node": number, "child": child, "split": split, "lo": float(lo), "hi": float(hi)})
        narrow = v.astype(np.int32) if np.abs(v).max(initial=0) < 2**31 else v
        block = {
            "vectors": narrow,
            "labels": rows.column("label").to_numpy(),
            "ids": rows.column("vec_id").fill_null(LONG).to_numpy(),
            "rows": rows.column("row").to_numpy(),
        }
        tree = pickle.dumps((grow(lifted, space, LEAF_ROWS), block))
        return pa.table(
            {"block": rows.column("block").slice(0, 1), "tree": pa.array([tree], pa.binary()), "ranges": pa.array([found], ranges)}
        )

    return build


@dataclass
class Index:
    """The upper tree and the written blocks."""

    top: Top
    space: Space
    blocks: DataFrame


def build_index(rows: DataFrame, block_bytes: int = BLOCK_BYTES) -> Index | None:
    """An index of every row of ``vectors``; None if there are none."""
    spark = rows.sparkSession
    ship(spark)
    norm = F.aggregate("v", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    count, dim, m2 = rows.agg(F.count(F.lit(1)), F.max(F.size("v")), F.max(norm)).first()
    if not count:
        return None
    space = Space(max(dim, 1), m2 * (1 + 1e-9) + 1)
    size = max(2 * FANOUT, min(SAMPLE, SAMPLE_BYTES // (8 * space.dim)))
    sample = rows.orderBy(F.xxhash64("row"), "row").limit(size).select("v").toArrow().column("v").combine_chunks()
    block_rows = max(1, block_bytes // (8 * space.dim))
    leaves = min(TOP_LEAVES, math.ceil(count / block_rows))
    top = Top(grow(space.lift(space.matrix(sample)), space, max(1, math.ceil(len(sample) / leaves))), space)

    def routed(batches):
        for batch in batches:
            leaf = top.route(space.lift(space.matrix(batch.column("v"))), space.m2)
            yield batch.append_column("leaf", pa.array(leaf, pa.int64()))

    dealt = distinct_rows(rows).mapInArrow(routed, "row long, vec_id long, label long, v array<long>, leaf long")
    dealt = materialize(dealt, "routed")
    top.set_blocks(dict(map(tuple, dealt.groupBy("leaf").count().collect())), block_rows)  # one row a leaf
    pairs = [F.lit(int(n)) for n in top.first]
    first = F.element_at(F.array(*pairs), F.col("leaf").cast("int") + 1)
    after = F.element_at(F.array(*pairs), F.col("leaf").cast("int") + 2)
    blocks = dealt.withColumn("block", (first + F.pmod(F.xxhash64("row"), after - first)).cast("long"))
    blocks = materialize(blocks.groupBy("block").applyInArrow(_block_builder(top, space), BLOCK), "blocks")
    each = blocks.select(F.explode("ranges").alias("r")).groupBy("r.node", "r.child", "r.split")
    top.set_ranges(each.agg(F.min("r.lo"), F.max("r.hi")).collect())  # at most FANOUT rows for each node of the upper tree
    return Index(top, space, blocks.select("block", "tree"))


# --- the search -----------------------------------------------------------------------------------------------------

PROBE = "probe long, label long, v array<long>, low array<decimal(38,0)>, high array<decimal(38,0)>"
FOUND = "probe long, w int, score decimal(38,0), vec_id long, row long"


def _windows(batch: pa.RecordBatch, space: Space):
    """The score windows of a batch as two matrices; missing ones are empty."""
    low, high = batch.column("low").to_pylist(), batch.column("high").to_pylist()
    width = max(map(len, low), default=0)
    matrix = lambda side, pad: [[*map(int, x), *[pad] * (width - len(x))] for x in side]
    kind = object if space.wide else float
    return tuple(np.array(matrix(side, pad), kind).reshape(len(side), width) for side, pad in ((low, 1), (high, 0)))


def _sender(index: Index, home: bool | None):
    """Probes to the blocks they have to see: those of their own leaf, of the others, or of all that are left (None)."""
    top, space = index.top, index.space

    def send(batches):
        for batch in batches:
            v = space.matrix(batch.column("v"))
            lifted = np.column_stack([v.astype(np.float64), np.zeros(len(v))])
            norms = (lifted**2).sum(axis=1)
            own = top.route(lifted, norms)
            low, high = _windows(batch, space)
            if home:
                reached = [(leaf, np.flatnonzero(own == leaf)) for leaf in np.unique(own)]
            else:
                reached = top.reached(lifted, norms, low, high)
            for leaf, probes in reached:
                if home is False:
                    probes = probes[own[probes] != leaf]
                for block in range(top.first[leaf], top.first[leaf + 1]):
                    for start in range(0, len(probes), PROBES):
                        part = batch.take(pa.array(probes[start : start + PROBES]))
                        yield part.append_column("block", pa.array(np.full(len(part), block, np.int64)))

    return send


def _searcher(space: Space, same: bool):
    """Rows sorted by (block, salt, kind): a block's tree, then the probes to compare with it."""

    def run(batches):
        tree, key = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in ("block", "salt", "kind")], 1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1), len(keys)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if keys[a, 2] == 0:
                    tree, key = pickle.loads(batch.column("tree")[a].as_py()), tuple(keys[a, :2])
                    continue
                if key != tuple(keys[a, :2]):
                    raise AssertionError("probes follow their block")
                for start in range(a, b, PROBES):
                    yield _compared(batch.slice(start, min(PROBES, b - start)), tree, space, same)

    return run


def _compared(batch: pa.RecordBatch, tree, space: Space, same: bool) -> pa.RecordBatch:
    probe = batch.column("probe").to_numpy()
    search = Search(space, space.matrix(batch.column("v")), batch.column("label").to_numpy(), probe, *_windows(batch, space), same)
    search.walk(*tree)
    out = [(int(p), w, -s, i, r) for p, best in zip(probe, search.best) for w, rows in enumerate(best) for s, i, r in rows]
    probes, w, scores, ids, rows = zip(*out) if out else [()] * 5
    return pa.RecordBatch.from_pydict(
        {
            "probe": pa.array(probes, pa.int64()),
            "w": pa.array(w, pa.int32()),
            "score": pa.array([Decimal(max(-EDGE, min(EDGE, s))) for s in scores], pa.decimal128(38, 0)),
            "vec_id": pa.array([None if i == LONG else i for i in ids], pa.int64()),
            "row": pa.array(rows, pa.int64()),
        }
    )


def search(index: Index, probes: DataFrame, same: bool, home: bool | None = None) -> DataFrame:
    """``(probe, w, score, vec_id, row)``: candidates of every window of ``PROBE`` rows, at most five a block."""
    spark = probes.sparkSession
    sent = materialize(probes.mapInArrow(_sender(index, home), PROBE + ", block long"), "probes")
    loads = sent.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / PROBES).cast("long").alias("salts"))
    copies = index.blocks.join(loads, "block").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)))
    salted = sent.join(loads, "block").withColumn("salt", F.pmod(F.xxhash64("probe"), "salts"))
    both = copies.select("block", "salt", F.lit(0).alias("kind"), "tree").unionByName(
        salted.withColumn("kind", F.lit(1)).drop("salts"), allowMissingColumns=True
    )
    dealt = both.repartition(partitions(spark), "block", "salt").sortWithinPartitions("block", "salt", "kind")
    return dealt.mapInArrow(_searcher(index.space, same), FOUND)


def _best(found: DataFrame) -> DataFrame:
    """The best rows of each window, with their rank."""
    order = Window.partitionBy("probe", "w").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TAKE)


def _long(score):
    return F.greatest(F.least(score, F.lit(LONG).cast("decimal(38,0)")), F.lit(-LONG - 1).cast("decimal(38,0)")).cast("long")


def hard_negatives(table: DataFrame, every: int = 100, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of all anchors (ids divisible by ``every``)."""
    spark = table.sparkSession
    rows = vectors(table)
    kind = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    index = build_index(rows, block_bytes)
    if index is None:
        return spark.createDataFrame([], kind)
    anchors = rows.where(F.col("vec_id") % every == 0).select(F.col("row").alias("probe"), "vec_id", "label", "v")
    edge = F.lit(Decimal(EDGE)).cast("decimal(38,0)")
    open_probes = anchors.select("probe", "label", "v", F.array(-edge).alias("low"), F.array(edge).alias("high"))
    near = materialize(_best(search(index, open_probes, True, home=True)), "near")
    bound = near.where(F.col("rank") == TAKE).select("probe", F.array("score").alias("bound"))
    bounded = open_probes.join(bound, "probe", "left").withColumn("low", F.coalesce("bound", "low")).drop("bound")
    far = search(index, bounded, True, home=False)
    positives = materialize(_best(near.drop("rank").unionByName(far)), "positives")
    low = F.ceil(F.col("score") * 80 / 100).cast("decimal(38,0)")
    windows = positives.groupBy("probe").agg(F.sort_array(F.collect_list(F.struct("rank", low.alias("low"), F.col("score").alias("high")))).alias("w"))
    wanted = anchors.join(windows, "probe").select("probe", "label", "v", F.col("w.low").alias("low"), F.col("w.high").alias("high"))
    found = _best(search(index, wanted, False))
    named = positives.select("probe", (F.col("rank") - 1).alias("w"), F.col("vec_id").alias("positive_id"), F.col("score").alias("p"))
    inside = (F.col("score") * 100 >= F.col("p") * 80) & (F.col("score") <= F.col("p"))
    return (
        found.join(named, ["probe", "w"]).where(inside)
        .join(anchors.select("probe", F.col("vec_id").alias("anchor_id")), "probe")
        .select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
            _long(F.col("p")).alias("positive_score"), _long(F.col("score")).alias("negative_score"),
        )
    )


SQL = """
with e as (
  select row_number() over () as row, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
  from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select a.row as anchor, a.vec_id as anchor_id, a.label = b.label as same, b.vec_id, cast(list_inner_product(a.v, b.v) as bigint) as score, b.row
  from e a join e b on a.vec_id % 100 = 0 and a.row <> b.row),
p as (
  select anchor, vec_id as positive_id, score as positive_score, row_number() over (partition by anchor order by score desc, vec_id nulls last, row) as k
  from s where same qualify k <= 5)
select anchor_id, positive_id, cast(row_number() over (partition by p.anchor, p.k order by s.score desc, s.vec_id nulls last, s.row) as integer) as rank,
  s.vec_id as negative_id, positive_score, s.score as negative_score
from p join s on s.anchor = p.anchor and not s.same and 80 * positive_score <= 100 * s.score and 100 * s.score <= 100 * positive_score
qualify rank <= 5
"""
