"""Grid search over isolation-forest settings by cross-validated F1."""

from __future__ import annotations

from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logblocks.operators.iforest import ForestModel, ForestParams, draw_forest, grow_trees, weighted_quantiles
from logblocks.operators.ordering import number_rows
from logblocks.operators.staging import materialize
from logblocks.shipping import ship

FOLDS = 3

# The full grid and the reduced one; contamination is added from the data.
FULL_GRID = {"n_trees": [100, 200, 300], "max_samples": ["auto", 0.8, 1.0], "max_features": [0.5, 0.75, 1.0]}
REDUCED_GRID = {"n_trees": [100, 200], "max_samples": [0.8, 1.0], "max_features": [0.75, 1.0]}

RESULT = "contamination double, max_features double, max_samples string, n_trees int, mean_f1 double, rank int"


def contamination_grid(ratio: float) -> list[float]:
    """The data's ratio next to two fixed ones."""
    return [ratio, 0.05, 0.1]


def reduced_contamination_grid(ratio: float) -> list[float]:
    """The data's ratio and what exceeds it of 0.05 and one and a half times the ratio, 0.1 at most."""
    larger = [share for share in (0.05, min(0.1, 1.5 * ratio)) if share > ratio]
    return sorted({round(share, 6) for share in (ratio, *larger)})


def with_folds(rows: DataFrame, *order, folds: int = FOLDS, name: str = "fold") -> DataFrame:
    """Adds contiguous folds: the rows in the given order, cut into runs of equal length, one row more in the first ones.

    The order should end in a unique column. Rows are numbered by a range sort, no task holds them all.
    """
    numbered = materialize(number_rows(rows, *order, name="_place"), "numbered-rows")
    size, more = divmod(numbered.count(), folds)
    long_part = F.lit(more * (size + 1))
    place = F.col("_place")
    fold = F.when(place < long_part, F.floor(place / (size + 1))).otherwise(more + F.floor((place - long_part) / max(size, 1)))
    return numbered.withColumn(name, fold.cast("int")).drop("_place")


def grid_search(
    vectors: DataFrame,
    n_features: int,
    contaminations: list[float],
    grid: dict = FULL_GRID,
    seed: int = 42,
    order: str = "block_id",
    parallelism: int = 6,
) -> tuple[DataFrame, ForestParams]:
    """(every setting with its mean F1 and rank, the best setting).

    Folds are contiguous in ``order`` (a unique column). Contamination moves only the cut, and a smaller forest is the first trees
    of a larger one with the same draws. So each (samples, features, fold)
    grows one forest, and all its sizes and cuts are scored from that. Folds are multiplicities of distinct vectors, and forests that differ
    in features share their samples; ``parallelism`` samples are in work at a time.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = with_folds(vectors.select(order, "idxs", "cnts", "label"), order)
    cells = materialize(
        rows.groupBy("idxs", "cnts", "fold").agg(F.count("*").alias("n"), F.sum("label").alias("pos")), "fold-cells"
    )
    sizes = sorted(grid["n_trees"])

    def scored(samples, k: int) -> dict[tuple, float]:
        params = ForestParams(sizes[-1], samples, 1.0, None, seed)
        fit = cells.where(F.col("fold") != k).select("idxs", "cnts", F.col("n").alias("weight"))
        sample, found = draw_forest(fit, params), {}
        for features in grid["max_features"]:
            params = ForestParams(sizes[-1], samples, features, None, seed)
            model = ForestModel(grow_trees(sample, n_features, params), n_features, sample.size, params)
            scores = materialize(model.prefix_scores(cells, sizes), "fold-scores")
            columns = [F.col("scores")[i] for i in range(len(sizes))]
            cuts = weighted_quantiles(scores.where(F.col("fold") != k), columns, "n", contaminations)
            f1 = _f1_at(scores.where(F.col("fold") == k), cuts)
            found |= {(c, features, str(samples), n): f1[i][j] for i, n in enumerate(sizes) for j, c in enumerate(contaminations)}
        return found

    work = list(product(grid["max_samples"], range(FOLDS)))
    with ThreadPool(min(parallelism, len(work))) as pool:
        results = pool.map(inheritable_thread_target(spark)(lambda task: scored(*task)), work)
    mean = {setting: sum(r[setting] for r in results if setting in r) / FOLDS for r in results for setting in r}
    order = [
        (c, features, str(samples), n)
        for c, features, samples, n in product(contaminations, grid["max_features"], grid["max_samples"], grid["n_trees"])
    ]
    ranked = sorted(order, key=lambda setting: -mean[setting])  # stable: the first setting wins a tie
    best = ranked[0]
    chosen = ForestParams(best[3], next(s for s in grid["max_samples"] if str(s) == best[2]), best[1], best[0], seed)
    table = [(*setting, mean[setting], ranked.index(setting) + 1) for setting in order]
    return spark.createDataFrame(table, RESULT), chosen


def _f1_at(test: DataFrame, cuts: list[list[float]]) -> list[list[float]]:
    """F1 of the anomaly class per forest size and cut, in one aggregation."""
    sums = [F.sum("pos")]
    for i, of_size in enumerate(cuts):
        for cut in of_size:
            low = F.col("scores")[i] < cut
            sums += [F.sum(F.when(low, F.col("pos")).otherwise(0)), F.sum(F.when(low, F.col("n")).otherwise(0))]
    total, *found = [x or 0 for x in test.agg(*sums).first()]
    f1 = [2 * hit / (flagged + total) if flagged + total else 0.0 for hit, flagged in zip(found[::2], found[1::2])]
    width = len(cuts[0])
    return [f1[i * width : (i + 1) * width] for i in range(len(cuts))]
