"""Isolation forest over event-count vectors.

Equal vectors are collapsed to one row with a multiplicity first: exact, since
a node's ranges depend on distinct values only and its size is a sum.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logblocks.functions import trees
from logblocks.operators.ordering import running_sums
from logblocks.operators.staging import broadcast_if_small, materialize
from logblocks.shipping import ship

AUTO_SAMPLES = 256
GROW_ROWS = 200_000
DRAW_CELLS = 4096
CELL_VECTORS = 64
BROADCAST_NODES = 2_000_000
RUN_NODES = 400_000  # of a run of trees that a task walks: what a Python worker holds
MATRIX_CELLS = 4_000_000
PACKED_NODES = 200_000

NODES = "tree int, node long, feature int, cut double, size long"


@dataclass(frozen=True)
class ForestParams:
    n_trees: int = 100
    max_samples: float | int | str = 1.0
    max_features: float = 0.75
    contamination: float | None = None
    seed: int = 42

    def sample_size(self, rows: int) -> int:
        if self.max_samples == "auto":
            return min(AUTO_SAMPLES, rows)
        if isinstance(self.max_samples, int):
            return min(self.max_samples, rows)
        return max(1, int(self.max_samples * rows))


def distinct_vectors(vectors: DataFrame) -> DataFrame:
    """``(idxs, cnts, weight)``; counted on the map side, so a common vector is no hot key."""
    weight = F.sum("weight") if "weight" in vectors.columns else F.count("*")
    return vectors.groupBy("idxs", "cnts").agg(weight.alias("weight"))


def _with_trees(rows: DataFrame, n_trees: int) -> DataFrame:
    return rows.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(n_trees - 1))))


def draw_samples(whole: DataFrame, total: int, size: int, params: ForestParams) -> DataFrame:
    """Exactly ``size`` of ``total`` rows per tree without replacement, as ``(tree, idxs, cnts, weight)``.

    ``whole`` holds the distinct vectors with their multiplicities. A tree's rows are first dealt to hash cells
    of vectors, then inside each cell to its vectors, by hypergeometric draws, for all trees together. So only
    distinct vectors move, once each, and a cell without drawn rows gives none.
    """
    cells = min(DRAW_CELLS, -(-whole.count() // CELL_VECTORS))
    hashed = whole.withColumn("_h", F.xxhash64("idxs", "cnts")).withColumn("cell", F.pmod("_h", F.lit(cells)).cast("int"))
    sums = hashed.groupBy("cell").agg(F.sum("weight").alias("n")).orderBy("cell").collect()  # at most DRAW_CELLS rows
    number, rows = np.array([c.cell for c in sums]), np.array([c.n for c in sums], np.int64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                tree = batch.column(0).slice(start, 64).to_numpy()
                taken = trees.deal_all(rows, np.full(len(tree), size), trees.uniform(params.seed, 3, tree[:, None], number))
                of, at = np.nonzero(taken)
                yield pa.RecordBatch.from_pydict(
                    {"tree": tree[of].astype(np.int32), "cell": number[at].astype(np.int32), "taken": taken[of, at]}
                )

    def draw(table: pa.Table, taken: pa.Table) -> pa.Table:
        table, taken = table.sort_by("_h"), taken.sort_by("tree")
        tree = taken["tree"].to_numpy()
        chance = trees.uniform(params.seed, 4, tree[:, None], table["_h"].to_numpy().view(np.uint64))
        weight = trees.deal_all(table["weight"].to_numpy(), taken["taken"].to_numpy(), chance)
        of, at = np.nonzero(weight)
        found = table.select(["idxs", "cnts"]).take(pa.array(at))
        return pa.table([pa.array(tree[of]), found["idxs"], found["cnts"], pa.array(weight[of, at])], names=["tree", "idxs", "cnts", "weight"])

    spark = whole.sparkSession
    dealt = materialize(spark.range(params.n_trees).mapInArrow(deal, "tree int, cell int, taken long"), "dealt")
    kinds = {f.name: f.dataType.simpleString() for f in whole.schema}
    schema = f"tree int, idxs {kinds['idxs']}, cnts {kinds['cnts']}, weight long"
    return hashed.groupBy("cell").cogroup(dealt.groupBy("cell")).applyInArrow(draw, schema)


def _matrix(table, n_features: int) -> np.ndarray:
    idxs, cnts = (c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in (table["idxs"], table["cnts"]))
    lengths = pc.list_value_length(idxs).to_numpy(zero_copy_only=False)
    return trees.dense(idxs.flatten().to_numpy(zero_copy_only=False), cnts.flatten().to_numpy(zero_copy_only=False), lengths, n_features)


def _grow_in_tasks(sample: DataFrame, n_features: int, params: ForestParams, limit: int) -> DataFrame:
    """One task per tree; the caller has checked that a tree's rows are few."""

    def grow(table: pa.Table) -> pa.Table:
        tree = table["tree"][0].as_py()
        weight = table["weight"].to_numpy().astype(np.int64)
        node, feature, cut, size = trees.grow(_matrix(table, n_features), weight, params.seed, tree, params.max_features, limit)
        return pa.table(
            [pa.array(np.full(len(node), tree, np.int32)), node, feature.astype(np.int32), cut, size],
            names=["tree", "node", "feature", "cut", "size"],
        )

    return sample.select("tree", "idxs", "cnts", "weight").groupBy("tree").applyInArrow(grow, NODES)


def _descend(state: DataFrame, splits: DataFrame) -> DataFrame:
    """Moves rows at inner nodes to their child; rows at leaves go."""
    value = F.coalesce(F.get("cnts", F.array_position("idxs", F.col("feature")).cast("int") - 1), F.lit(0))
    inner = splits.where(F.col("feature") != trees.LEAF).select("tree", "node", "feature", "cut")
    child = F.col("node") * 2 + F.when(value > F.col("cut"), 1).otherwise(0)
    return state.join(broadcast_if_small(inner), ["tree", "node"]).select(
        *[child.alias("node") if c == "node" else c for c in state.columns]
    )


def _grow_by_level(sample: DataFrame, n_features: int, params: ForestParams, limit: int) -> DataFrame:
    """All trees at once, one level per round, for trees too large for one task.

    Value ranges per (tree, node, feature) are aggregated on the map side from
    the non-zero counts; only node rows reach the Python draw.
    """
    spark = sample.sparkSession
    allowed = spark.range(params.n_trees).mapInArrow(
        lambda batches: (
            pa.RecordBatch.from_pydict({"tree": np.full(len(f), t, np.int32), "feature": f.astype(np.int32)})
            for batch in batches
            for t in batch.column(0).to_pylist()
            for f in [trees.tree_features(params.seed, t, n_features, params.max_features)]
        ),
        "tree int, feature int",
    )
    allowed = broadcast_if_small(materialize(allowed, "features"))
    state = materialize(sample.select("tree", F.lit(1).cast("bigint").alias("node"), "idxs", "cnts", "weight"), "level")
    levels = []
    for depth in range(limit + 1):
        sizes = state.groupBy("tree", "node").agg(F.sum("weight").alias("size"), F.count("*").alias("_rows"))
        if depth < limit:
            cells = state.select("tree", "node", F.explode(F.arrays_zip("idxs", "cnts")).alias("_e"))
            ranges = (
                cells.groupBy("tree", "node", F.col("_e.idxs").cast("int").alias("feature"))
                .agg(F.min("_e.cnts").alias("_min"), F.max("_e.cnts").alias("high"), F.count("*").alias("_k"))
                .join(allowed, ["tree", "feature"])
                .join(sizes, ["tree", "node"])
                .withColumn("low", F.when(F.col("_k") < F.col("_rows"), 0).otherwise(F.col("_min")))
                .where(F.col("low") < F.col("high"))
                .groupBy("tree", "node")
                .agg(F.array_sort(F.collect_list(F.struct("feature", "low", "high"))).alias("_r"))
            )
            facts = sizes.join(ranges, ["tree", "node"], "left").select("tree", "node", "size", F.coalesce("_r", F.expr("array()")).alias("_r"))
        else:
            facts = sizes.select("tree", "node", "size", F.expr("cast(array() as array<struct<feature: int, low: bigint, high: bigint>>)").alias("_r"))
        splits = materialize(facts.mapInArrow(lambda b: _draw_splits(b, params.seed), NODES), "splits")
        levels.append(splits)
        state = materialize(_descend(state, splits), "level")
        if state.isEmpty():
            break
    nodes = levels[0]
    for level in levels[1:]:
        nodes = nodes.unionByName(level)
    return nodes


def _draw_splits(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        tree, node, size = (batch.column(i).to_numpy() for i in range(3))
        ranges = batch.column(3)
        choices = pc.list_value_length(ranges).to_numpy(zero_copy_only=False).astype(np.int64)
        first = np.cumsum(choices) - choices
        feature, low, high = (f.to_numpy(zero_copy_only=False) for f in ranges.flatten().flatten())
        at = np.flatnonzero(choices)
        taken = first[at] + trees.pick(seed, tree[at], node[at], choices[at])
        column, cut = np.full(len(tree), trees.LEAF, np.int32), np.zeros(len(tree))
        column[at] = feature[taken]
        cut[at] = trees.threshold(seed, tree[at], node[at], low[taken].astype(float), high[taken].astype(float))
        yield pa.RecordBatch.from_arrays(
            [pa.array(tree, pa.int32()), pa.array(node), pa.array(column), pa.array(cut), pa.array(size)],
            ["tree", "node", "feature", "cut", "size"],
        )


@dataclass(frozen=True)
class Sample:
    """The rows of all trees as distinct vectors with multiplicities, how many they are a tree, and the most distinct ones of a tree."""

    rows: DataFrame
    size: int
    largest: int


def draw_forest(vectors: DataFrame, params: ForestParams) -> Sample:
    """The trees' samples; they depend on the seed and ``max_samples`` only, so forests that differ in features share them."""
    ship(vectors.sparkSession)
    whole = materialize(distinct_vectors(vectors), "distinct")
    total = whole.agg(F.coalesce(F.sum("weight"), F.lit(0))).first()[0]
    size = params.sample_size(total)
    if size >= total:
        return Sample(_with_trees(whole, params.n_trees), size, whole.count())
    sample = materialize(draw_samples(whole, total, size, params), "sample")
    return Sample(sample, size, sample.groupBy("tree").count().agg(F.max("count")).first()[0])


def grow_trees(sample: Sample, n_features: int, params: ForestParams, grow_rows: int = GROW_ROWS) -> DataFrame:
    """The node table of the forest."""
    grow = _grow_in_tasks if sample.largest <= grow_rows else _grow_by_level
    return materialize(grow(sample.rows, n_features, params, trees.depth_limit(sample.size)), "nodes")


def grow_forest(vectors: DataFrame, n_features: int, params: ForestParams, grow_rows: int = GROW_ROWS) -> tuple[DataFrame, int]:
    """(node table, rows per tree)."""
    sample = draw_forest(vectors, params)
    return grow_trees(sample, n_features, params, grow_rows), sample.size


def weighted_quantiles(scores: DataFrame, columns: list, weight: str, shares: list[float]) -> list[list[float]]:
    """Exact quantiles per score column, with linear interpolation between neighbours.

    Each column's distinct scores get running sums, so that no task holds them
    all; the formula is the same for any number of rows.
    """
    places = [share * (scores.agg(F.sum(weight)).first()[0] - 1) for share in shares]
    at = lambda k: F.min(F.when(F.col("upto") > k, F.col("score")))
    result = []
    for column in columns:
        by_score = materialize(scores.groupBy(column.alias("score")).agg(F.sum(weight).alias("n")), "quantile")
        running = running_sums(by_score, "score", {"upto": "n"})
        ends = running.agg(*[at(int(end(place))) for place in places for end in (np.floor, np.ceil)]).first()
        between = lambda i, p: float(ends[2 * i] + (ends[2 * i + 1] - ends[2 * i]) * (p - np.floor(p)))
        result.append([between(i, p) for i, p in enumerate(places)])
    return result


@dataclass
class ForestModel:
    nodes: DataFrame
    n_features: int
    sample_size: int
    params: ForestParams
    offset: float = -0.5

    def path_lengths(self, vectors: DataFrame, prefixes: list[int] | None = None) -> DataFrame:
        """Adds ``paths``: summed path lengths over the first k trees, per k in ``prefixes``.

        The trees go to the tasks in runs of bounded size.
        """
        prefixes = prefixes or [self.params.n_trees]
        sizes = sorted(tuple(r) for r in self.nodes.groupBy("tree").count().collect())  # one row per tree
        if max(count for _, count in sizes) > BROADCAST_NODES:
            return self._path_lengths_by_join(vectors, prefixes)
        return add_path_sums(self.nodes, ("tree", "node", "feature", "cut", "size"), trees.Forest, vectors, self.n_features, prefixes, sizes)

    def _path_lengths_by_join(self, vectors: DataFrame, prefixes: list[int]) -> DataFrame:
        """The same by one join per level and distinct vector, for trees too large to send to every task."""
        key = ["idxs", "cnts"]
        state = _with_trees(vectors.select(*key).distinct(), self.params.n_trees).withColumn("node", F.lit(1).cast("bigint"))
        ends = None
        while True:
            leaves = self.nodes.where(F.col("feature") == trees.LEAF).select("tree", "node", "size")
            ended = state.join(leaves, ["tree", "node"]).select(*key, "tree", "node", "size")
            ends = ended if ends is None else ends.unionByName(ended)
            state = materialize(_descend(state, self.nodes), "walk")
            if state.isEmpty():
                break
        size = F.col("size").cast("double")
        rest = F.when(size <= 1, 0.0).when(size <= 2, 1.0).otherwise(
            2.0 * (F.log(size - 1) + trees.EULER_GAMMA) - 2.0 * (size - 1) / size
        )
        path = F.floor(F.log2("node")) + rest
        sums = ends.groupBy(*key).agg(F.array(*[F.sum(F.when(F.col("tree") < k, path).otherwise(0.0)) for k in prefixes]).alias("paths"))
        return vectors.join(sums, key)

    def _score(self, paths, n_trees: int):
        return -F.pow(F.lit(2.0), -paths / (n_trees * self._normal()))

    def _normal(self) -> float:
        return max(float(trees.average_path(self.sample_size)), 1e-300)

    def transform(self, vectors: DataFrame) -> DataFrame:
        """Adds ``anomaly_score`` (below 0 is anomalous at the contamination cut) and ``if_class`` (-1 or 1)."""
        sample_score = self._score(F.col("paths")[0], self.params.n_trees)
        scored = self.path_lengths(vectors).withColumn("anomaly_score", sample_score - self.offset).drop("paths")
        return scored.withColumn("if_class", F.when(F.col("anomaly_score") < 0, -1).otherwise(1))

    def transform_on_jvm(self, vectors: DataFrame) -> DataFrame:
        """``transform`` without a Python worker: trees as packed arrays, walked by higher-order functions.

        Distinct vectors are walked once. Forests of more than ``PACKED_NODES`` nodes are joined level by level instead.
        """
        key = ["idxs", "cnts"]
        if self.nodes.count() > PACKED_NODES:
            sums = self._path_lengths_by_join(vectors.select(*key).distinct(), [self.params.n_trees])
        else:
            sums = self._walked(vectors.select(*key).distinct())
        scored = sums.withColumn("anomaly_score", self._score(F.col("paths")[0], self.params.n_trees) - self.offset).select(*key, "anomaly_score")
        return vectors.join(broadcast_if_small(scored), key).withColumn("if_class", F.when(F.col("anomaly_score") < 0, -1).otherwise(1))

    def _walked(self, vectors: DataFrame) -> DataFrame:
        at = F.row_number().over(Window.partitionBy("tree").orderBy("node")) - 1
        placed = materialize(self.nodes.withColumn("at", at), "placed-nodes")
        left = placed.select("tree", F.col("node").alias("child"), F.col("at").alias("left"))
        linked = placed.withColumn("child", F.col("node") * 2).join(broadcast_if_small(left), ["tree", "child"], "left")
        size = F.col("size").cast("double")
        rest = F.when(size <= 1, 0.0).when(size <= 2, 1.0).otherwise(
            2.0 * (F.log(size - 1) + trees.EULER_GAMMA) - 2.0 * (size - 1) / size
        )
        path = F.floor(F.log2("node")) + rest  # exact: a node number below 2^53 has the right whole logarithm
        node = F.struct("at", F.coalesce("left", F.lit(trees.LEAF)).alias("left"), "feature", "cut", path.alias("path"))
        packed = linked.groupBy("tree").agg(F.array_sort(F.collect_list(node)).alias("n"))
        forest = packed.agg(F.array_sort(F.collect_list(F.struct("tree", "n"))).alias("trees"))  # PACKED_NODES at most, in one row
        depth = F.lit(trees.depth_limit(self.sample_size))
        value = lambda f: F.coalesce(F.get("cnts", F.array_position("idxs", f).cast("int") - 1), F.lit(0).cast("long")).cast("double")

        def leaf(tree):
            def step(at, _):
                here = F.get(tree["n"], at)
                down = here["left"] + F.when(F.get("dense", here["feature"]) > here["cut"], 1).otherwise(0)
                return F.when(here["left"] == trees.LEAF, at).otherwise(down)

            return F.get(tree["n"], F.aggregate(F.sequence(F.lit(1), depth), F.lit(0), step))["path"]

        dense = F.transform(F.sequence(F.lit(0), F.lit(self.n_features - 1)), lambda f: value(f))
        wide = vectors.withColumn("dense", dense).crossJoin(F.broadcast(forest))
        return wide.withColumn("paths", F.array(F.aggregate("trees", F.lit(0.0), lambda total, tree: total + leaf(tree)))).drop("dense", "trees")

    def prefix_scores(self, vectors: DataFrame, prefixes: list[int]) -> DataFrame:
        """Adds ``scores``: raw scores of the forests of the first k trees."""
        walked = self.path_lengths(vectors, prefixes)
        scores = [self._score(F.col("paths")[i], k) for i, k in enumerate(prefixes)]
        return walked.withColumn("scores", F.array(*scores)).drop("paths")

    def save(self, path: str) -> None:
        self.nodes.write.parquet(f"{path}/nodes")
        facts = {"n_features": self.n_features, "sample_size": self.sample_size, "offset": self.offset, "params": asdict(self.params)}
        self.nodes.sparkSession.createDataFrame([(json.dumps(facts),)], "value string").coalesce(1).write.text(f"{path}/facts")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "ForestModel":
        facts = json.loads(spark.read.text(f"{path}/facts").first().value)
        params = ForestParams(**facts["params"])
        nodes = spark.read.schema(NODES).parquet(f"{path}/nodes")
        return ForestModel(nodes, facts["n_features"], facts["sample_size"], params, facts["offset"])


def add_path_sums(nodes: DataFrame, columns, make, vectors: DataFrame, n_features: int, prefixes: list[int], sizes=None) -> DataFrame:
    """Adds ``paths``: the values at each vector's leaves, summed over the first k trees, per k in ``prefixes``.

    ``make`` lays the node ``columns`` of some trees out for walking; trees go to the tasks in runs of ``RUN_NODES``, or of one
    larger tree. Each run is walked by tasks of its own, for distinct vectors, so a worker holds one run however many there are.
    """
    sizes = sizes or sorted(tuple(r) for r in nodes.groupBy("tree").count().collect())  # one row per tree
    runs, room = [], 0
    for tree, count in sizes:
        if count > room:
            runs.append([tree, tree])
            room = min(RUN_NODES, BROADCAST_NODES)
        runs[-1][1] = tree
        room -= count
    if not runs:
        return vectors.withColumn("paths", F.array_repeat(F.lit(0.0), len(prefixes)))

    def walked(rows: DataFrame, first: int, last: int) -> DataFrame:
        part = nodes.where(F.col("tree").between(first, last)).toArrow()  # at most RUN_NODES rows, or one tree
        return _add_paths(rows, make, [part[c].to_numpy() for c in columns], n_features, prefixes)

    if len(runs) == 1:
        return walked(vectors, *runs[0])
    key = ["idxs", "cnts"]
    distinct = materialize(vectors.select(*key).distinct(), "walked-vectors")
    of_runs = [walked(distinct, *run).withColumn("run", F.lit(k)) for k, run in enumerate(runs)]
    parts = F.array_sort(F.collect_list(F.struct("run", "paths")))
    by_run = reduce(DataFrame.unionByName, of_runs).groupBy(*key).agg(parts.alias("_runs"))
    total = lambda j: F.aggregate("_runs", F.lit(0.0), lambda upto, run: upto + run["paths"][j])  # in the order of the runs
    sums = materialize(by_run.select(*key, F.array(*[total(j) for j in range(len(prefixes))]).alias("paths")), "path-sums")
    return vectors.join(broadcast_if_small(sums), key).select(*vectors.columns, "paths")


def _add_paths(rows: DataFrame, make, arrays: list[np.ndarray], n_features: int, prefixes: list[int]) -> DataFrame:
    """Adds the leaf values of some trees, summed over the first k trees, batch by batch."""
    ship(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(arrays)
    names = rows.columns
    schema = T.StructType([*rows.schema.fields, T.StructField("paths", T.ArrayType(T.DoubleType()))])

    def walk(batches):
        forest = make(*shared.value)
        within = np.searchsorted(forest.trees, prefixes)  # how many of these trees are among the first k
        for batch in batches:
            # blocks repeat few vectors: each distinct one of the batch is walked once
            keys = [i.tobytes() + b"|" + c.tobytes() for i, c in zip(_lists(batch.column("idxs")), _lists(batch.column("cnts")))]
            seen = {k: n for n, k in enumerate(dict.fromkeys(keys))}
            place = np.array([seen[k] for k in keys], np.int64)
            first = np.unique(place, return_index=True)[1]
            chosen = batch.select(["idxs", "cnts"]).take(pa.array(first))
            step = max(1, MATRIX_CELLS // max(n_features, len(forest.path), 1)) if len(first) else 1
            step = max(step, 64)
            sums = np.zeros((len(first), len(prefixes)))
            for i in range(0, len(first), step):
                lengths = forest.paths(_matrix(chosen.slice(i, step), n_features))
                upto = np.cumsum(lengths, axis=1)  # tree by tree, so that a sum does not depend on the other rows
                for j, k in enumerate(within):
                    if k:
                        sums[i : i + step, j] = upto[:, k - 1]
            flat = pa.array(sums[place].reshape(-1))
            offsets = pa.array(np.arange(len(keys) + 1) * len(prefixes), pa.int32())
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.ListArray.from_arrays(offsets, flat)], [*names, "paths"])

    return rows.mapInArrow(walk, schema)


def _lists(column: pa.ListArray) -> Iterator[np.ndarray]:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(pc.list_value_length(column).to_numpy(zero_copy_only=False))
    return iter(np.split(flat, ends[:-1])) if len(ends) else iter(())


def fit_forest(vectors: DataFrame, n_features: int, params: ForestParams) -> ForestModel:
    """Grows the forest and sets the cut at the contamination share of its own rows."""
    nodes, size = grow_forest(vectors, n_features, params)
    model = ForestModel(nodes, n_features, size, params)
    if params.contamination is not None:
        rows = materialize(model.prefix_scores(distinct_vectors(vectors), [params.n_trees]).select("scores", "weight"), "fit-scores")
        [[model.offset]] = weighted_quantiles(rows, [F.col("scores")[0]], "weight", [params.contamination])
    return model
