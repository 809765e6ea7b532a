"""Opt-in random-forest baseline on labelled count vectors.

Every tree has a bootstrap of all rows, its own class weights from that bootstrap, and grows until its leaves are pure or cannot be
split; the depth has no limit unless one is set. Equal vectors are collapsed to one row with class counts first and a bootstrap
is drawn as multiplicities of these, so only distinct vectors move. A tree whose distinct rows are few, counted first, grows in one
task; otherwise all trees grow together, one level per round, from class histograms per (tree, node, feature, value)
that are summed on the map side. Both give the same trees.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logblocks.functions import classtrees, trees
from logblocks.operators import iforest
from logblocks.operators.staging import broadcast_if_small, materialize
from logblocks.shipping import ship

NODES = "tree int, node long, left long, right long, feature int, cut double, share double, rows long"


@dataclass(frozen=True)
class RandomForestParams:
    n_trees: int = 200
    max_depth: int | None = None
    seed: int = 42


def class_counts(vectors: DataFrame) -> DataFrame:
    """``(idxs, cnts, n0, n1)``: distinct vectors with the rows of each class, summed on the map side."""
    anomalous = F.sum(F.when(F.col("label") == 1, 1).otherwise(0))
    return vectors.groupBy("idxs", "cnts").agg((F.count("*") - anomalous).alias("n0"), anomalous.alias("n1"))


def draw_bootstraps(whole: DataFrame, total: int, params: RandomForestParams) -> DataFrame:
    """``total`` rows with replacement per tree, as ``(tree, idxs, cnts, c0, c1)``.

    A tree's rows are first dealt to hash cells of vectors, then inside each cell to its vectors and classes, by
    binomial draws that together are one multinomial draw.
    """
    cells = min(iforest.DRAW_CELLS, -(-whole.count() // iforest.CELL_VECTORS))
    hashed = whole.withColumn("_h", F.xxhash64("idxs", "cnts")).withColumn("cell", F.pmod("_h", F.lit(cells)).cast("int"))
    sums = hashed.groupBy("cell").agg(F.sum(F.col("n0") + F.col("n1")).alias("n")).orderBy("cell").collect()  # at most DRAW_CELLS rows
    number, rows = np.array([c.cell for c in sums]), np.array([c.n for c in sums], np.int64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tree in batch.column(0).to_pylist():
                chances = trees.uniform(params.seed, 6, np.full(len(rows), tree), number)
                taken = classtrees.deal_with_return(rows, total, chances)
                used = taken > 0
                yield pa.RecordBatch.from_pydict(
                    {"tree": np.full(used.sum(), tree, np.int32), "cell": number[used].astype(np.int32), "taken": taken[used]}
                )

    def draw(table: pa.Table) -> pa.Table:
        table = table.sort_by("_h")
        groups = np.stack([table["n0"].to_numpy(), table["n1"].to_numpy()], axis=1)
        tree = table["tree"][0].as_py()
        item = table["_h"].to_numpy().view(np.uint64)
        chances = np.stack([trees.uniform(params.seed, s, np.full(len(item), tree, np.int32), item) for s in (7, 8)], axis=1)
        taken = classtrees.deal_with_return(groups.reshape(-1), table["taken"][0].as_py(), chances.reshape(-1)).reshape(-1, 2)
        found = pa.table(
            [pa.array(np.full(len(item), tree, np.int32)), table["idxs"], table["cnts"], pa.array(taken[:, 0]), pa.array(taken[:, 1])],
            names=["tree", "idxs", "cnts", "c0", "c1"],
        )
        return found.filter(pa.array(taken.sum(axis=1) > 0))

    dealt = whole.sparkSession.range(params.n_trees).mapInArrow(deal, "tree int, cell int, taken long")
    kinds = {f.name: f.dataType.simpleString() for f in whole.schema}
    schema = f"tree int, idxs {kinds['idxs']}, cnts {kinds['cnts']}, c0 long, c1 long"
    dealt = broadcast_if_small(materialize(dealt, "bootstrap-cells"))
    return hashed.join(dealt, "cell").groupBy("tree", "cell").applyInArrow(draw, schema)


def _grow_in_tasks(sample: DataFrame, n_features: int, params: RandomForestParams) -> DataFrame:
    """One task per tree; the caller has checked that a tree's rows are few."""
    names = [f.split()[0] for f in NODES.split(", ")]

    def grow(table: pa.Table) -> pa.Table:
        tree = table["tree"][0].as_py()
        c0, c1 = table["c0"].to_numpy(), table["c1"].to_numpy()
        matrix = iforest._matrix(table, n_features)
        node, left, right, feature, *rest = classtrees.grow(
            matrix, c0, c1, params.seed, tree, classtrees.per_node(n_features), params.max_depth
        )
        return pa.table([pa.array(np.full(len(node), tree, np.int32)), node, left, right, feature.astype(np.int32), *rest], names=names)

    return sample.groupBy("tree").applyInArrow(grow, NODES)


def _histograms(state: DataFrame, open_nodes: DataFrame) -> DataFrame:
    """``(tree, node, feature, value, c0, c1)`` of the features that are not constant zero in an open node."""
    key = ["tree", "node", "feature"]
    cells = state.join(broadcast_if_small(open_nodes.select("tree", "node")), ["tree", "node"])
    cells = cells.select("tree", "node", "c0", "c1", F.explode(F.arrays_zip("idxs", "cnts")).alias("e"))
    found = cells.groupBy("tree", "node", F.col("e.idxs").cast("int").alias("feature"), F.col("e.cnts").cast("double").alias("value"))
    found = found.agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1"))
    rest = found.groupBy(key).agg(F.sum("c0").alias("s0"), F.sum("c1").alias("s1")).join(open_nodes, ["tree", "node"])
    rest = rest.select(*key, F.lit(0.0).alias("value"), (F.col("n0") - F.col("s0")).alias("c0"), (F.col("n1") - F.col("s1")).alias("c1"))
    both = found.unionByName(rest.where("c0 + c1 > 0"))
    return both.groupBy(*key, "value").agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1"))  # a stored zero joins the others


def _cuts(histograms: DataFrame, open_nodes: DataFrame) -> DataFrame:
    """The best cut of every feature that is not constant: ``(tree, node, feature, gain, cut)``."""
    upto = Window.partitionBy("tree", "node", "feature").orderBy("value")
    sums = upto.rowsBetween(Window.unboundedPreceding, 0)
    run = histograms.select(
        "tree", "node", "feature", "value", F.lead("value").over(upto).alias("after"),
        F.sum("c0").over(sums).alias("l0"), F.sum("c1").over(sums).alias("l1"),
    ).where("after is not null")
    run = run.join(broadcast_if_small(open_nodes), ["tree", "node"])
    side = lambda c0, c1: classtrees.purity(c0 * F.col("k0"), c1 * F.col("k1"))
    gain = side(F.col("l0"), F.col("l1")) + side(F.col("n0") - F.col("l0"), F.col("n1") - F.col("l1"))
    best = F.max(F.struct(gain.alias("gain"), (-F.col("value")).alias("v"), ((F.col("value") + F.col("after")) / 2).alias("cut")))
    return run.groupBy("tree", "node", "feature").agg(best.alias("b")).select("tree", "node", "feature", "b.gain", "b.cut")


def _order_drawer(seed: int, n_features: int):
    """Adds to nodes the order in which they look at features, and their children's numbers."""

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tree, node = batch.column("tree").to_numpy(), batch.column("node").to_numpy()
            orders = np.stack([classtrees.feature_order(seed, t, n, n_features) for t, n in zip(tree, node)]) if len(tree) else np.zeros((0, 0), int)
            ranks = np.argsort(orders, axis=1).astype(np.int32)
            offsets = pa.array(np.arange(len(tree) + 1) * n_features, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.ListArray.from_arrays(offsets, pa.array(ranks.reshape(-1))), pa.array(classtrees.child(node, 0)), pa.array(classtrees.child(node, 1))],
                [*batch.schema.names, "ranks", "left", "right"],
            )

    return draw


def _grow_by_level(sample: DataFrame, n_features: int, params: RandomForestParams) -> DataFrame:
    """All trees at once, one level per round, for bootstraps too large for one task."""
    looks = classtrees.per_node(n_features)
    sizes = sample.groupBy("tree").agg(F.sum("c0").alias("t0"), F.sum("c1").alias("t1"))
    weight = lambda mine: F.when((F.col("t0") == 0) | (F.col("t1") == 0), 1.0).otherwise((F.col("t0") + F.col("t1")) / (F.lit(2) * F.col(mine)))
    weights = F.broadcast(materialize(sizes.select("tree", weight("t0").alias("k0"), weight("t1").alias("k1")), "weights"))  # one row a tree
    state = materialize(sample.select("tree", F.lit(classtrees.ROOT).cast("long").alias("node"), "idxs", "cnts", "c0", "c1"), "level")
    levels, depth = [], 0
    while True:
        nodes = state.groupBy("tree", "node").agg(F.sum("c0").alias("n0"), F.sum("c1").alias("n1")).join(weights, "tree")
        nodes = materialize(nodes, "nodes")
        open_nodes = nodes.where("n0 > 0 and n1 > 0") if params.max_depth is None or depth < params.max_depth else nodes.where("false")
        cuts = _cuts(_histograms(state, open_nodes), open_nodes)
        kinds = "tree int, node long, ranks array<int>, left long, right long"
        looked = open_nodes.select("tree", "node").mapInArrow(_order_drawer(params.seed, n_features), kinds)
        ranked = cuts.join(looked, ["tree", "node"]).withColumn("rank", F.get("ranks", F.col("feature")))
        # the best of the first looks, else the first one that is not constant
        key = F.struct(
            (F.col("rank") >= looks).alias("late"),
            F.when(F.col("rank") < looks, -F.col("gain")).otherwise(F.col("rank").cast("double")).alias("order"),
            "rank", "feature", "cut", "left", "right",
        )
        chosen = ranked.groupBy("tree", "node").agg(F.min(key).alias("s")).select("tree", "node", "s.left", "s.right", "s.feature", "s.cut")
        w0, w1 = F.col("n0") * F.col("k0"), F.col("n1") * F.col("k1")
        level = nodes.join(chosen, ["tree", "node"], "left").select(
            "tree", "node", *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("left", "right")),
            F.coalesce("feature", F.lit(trees.LEAF)).alias("feature"), F.coalesce("cut", F.lit(0.0)).alias("cut"),
            (w1 / (w0 + w1)).alias("share"), (F.col("n0") + F.col("n1")).alias("rows"),
        )
        levels.append(materialize(level, "splits"))
        inner = levels[-1].where(F.col("feature") != trees.LEAF).select("tree", "node", "left", "right", "feature", "cut")
        value = F.coalesce(F.get("cnts", F.array_position("idxs", F.col("feature")).cast("int") - 1), F.lit(0))
        side = F.when(value <= F.col("cut"), F.col("left")).otherwise(F.col("right"))
        moved = state.join(broadcast_if_small(inner), ["tree", "node"]).select("tree", side.alias("node"), "idxs", "cnts", "c0", "c1")
        state, depth = materialize(moved, "level"), depth + 1
        if state.isEmpty():
            return reduce(DataFrame.unionByName, levels)


@dataclass
class RandomForestModel:
    nodes: DataFrame
    n_features: int
    params: RandomForestParams

    def transform(self, vectors: DataFrame) -> DataFrame:
        """Adds ``anomaly_score``: the mean of the trees' weighted shares of the anomaly class."""
        columns = ("tree", "node", "left", "right", "feature", "cut", "share")
        walked = iforest.add_path_sums(self.nodes, columns, classtrees.ClassForest, vectors, self.n_features, [self.params.n_trees])
        return walked.withColumn("anomaly_score", F.col("paths")[0] / self.params.n_trees).drop("paths")

    def save(self, path: str) -> None:
        self.nodes.write.parquet(f"{path}/nodes")
        facts = json.dumps({"n_features": self.n_features, "params": asdict(self.params)})
        self.nodes.sparkSession.createDataFrame([(facts,)], "value string").coalesce(1).write.text(f"{path}/facts")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "RandomForestModel":
        facts = json.loads(spark.read.text(f"{path}/facts").first().value)
        nodes = spark.read.schema(NODES).parquet(f"{path}/nodes")
        return RandomForestModel(nodes, facts["n_features"], RandomForestParams(**facts["params"]))


def fit_random_forest(
    vectors: DataFrame,
    n_features: int,
    allow_supervised: bool = False,
    n_trees: int = 200,
    max_depth: int | None = None,
    seed: int = 42,
    grow_rows: int = iforest.GROW_ROWS,
) -> RandomForestModel:
    """Random forest over ``idxs``, ``cnts`` and ``label``; classes are balanced in every bootstrap."""
    if not allow_supervised:
        raise ValueError("a random forest is supervised; pass allow_supervised=True to train this baseline")
    ship(vectors.sparkSession)
    params = RandomForestParams(n_trees, max_depth, seed)
    whole = materialize(class_counts(vectors), "class-counts")
    total = whole.agg(F.coalesce(F.sum(F.col("n0") + F.col("n1")), F.lit(0))).first()[0]
    if not total:
        raise ValueError("a random forest needs labelled rows")
    sample = materialize(draw_bootstraps(whole, total, params), "bootstraps")
    largest = sample.groupBy("tree").count().agg(F.max("count")).first()[0]
    grow = _grow_in_tasks if largest <= grow_rows else _grow_by_level
    return RandomForestModel(materialize(grow(sample, n_features, params), "class-nodes"), n_features, params)


def score_random_forest(model: RandomForestModel, vectors: DataFrame, n_features: int) -> DataFrame:
    """Adds ``anomaly_score``: the probability of the anomaly class."""
    if n_features != model.n_features:
        raise ValueError(f"the model has {model.n_features} features, the vectors {n_features}")
    return model.transform(vectors)


def save_random_forest(model: RandomForestModel, path: str) -> None:
    model.save(path)


def load_random_forest(spark: SparkSession, path: str) -> RandomForestModel:
    return RandomForestModel.load(spark, path)
