"""The detector as ``pyspark.ml`` stages: vocabulary, isolation forest and threshold in one pipeline.

``Pipeline(stages=[EventVocabulary(), IsolationForest(), ScoreThreshold()]).fit(sequences)`` takes rows with ``events`` (the ordered
events of a block) and ``label``. Rows whose ``calibrationCol`` is true set the threshold, the others grow the forest; without that column
all rows do both. The fitted pipeline is saved and loaded as one object and adds ``anomaly_score``, ``if_class`` and ``prediction``.

Null or empty sequences have no events; events that the vocabulary lacks are ignored.
"""

from __future__ import annotations

from dataclasses import asdict

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logblocks.operators import calibrate, features, score, splits
from logblocks.operators.iforest import NODES, ForestModel, ForestParams, fit_forest
from logblocks.operators.staging import materialize

SIZE = "n_features"  # in the metadata of the index column


def _text(name: str, doc: str) -> Param:
    return Param(Params._dummy(), name, doc, TypeConverters.toString)


class _Columns(Params):
    labelCol = _text("labelCol", "1 marks an anomaly")
    calibrationCol = _text("calibrationCol", "true marks rows that set the threshold and not the forest")

    def __init__(self):
        super().__init__()
        self._setDefault(labelCol="label", calibrationCol="is_calibration")

    def _rows(self, rows: DataFrame, calibration: bool) -> DataFrame:
        column = self.getOrDefault("calibrationCol")
        if column not in rows.columns:
            return rows
        return rows.where(F.col(column) if calibration else ~F.coalesce(F.col(column), F.lit(False)))


class _FactsWriter(MLWriter):
    """Params and the small facts of a model as metadata, tables beside them."""

    def __init__(self, model):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, extraMetadata={"facts": self.model._facts()})
        for name, table in self.model._tables().items():
            table.write.parquet(f"{path}/{name}")


class _FactsReader(MLReader):
    def __init__(self, kind):
        super().__init__()
        self.kind = kind

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.kind._restored(self.sparkSession, metadata["facts"], path)
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


class _FactsModel(Model, MLReadable, MLWritable):
    """A model that is saved as facts and tables."""

    def write(self) -> MLWriter:
        return _FactsWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _FactsReader(cls)

    def _tables(self) -> dict[str, DataFrame]:
        return {}


class EventVocabulary(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """All events of the rows, in code point order."""

    eventsCol = _text("eventsCol", "the ordered events of a block")

    @keyword_only
    def __init__(self, *, eventsCol: str = "events"):
        super().__init__()
        self._setDefault(eventsCol="events")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "EventVocabularyModel":
        events = dataset.select(F.explode(self.getOrDefault("eventsCol")).alias("event_id"))
        found = features.vocabulary(events.where(F.col("event_id").isNotNull())).orderBy("idx").collect()  # one row an event kind
        return self._copyValues(EventVocabularyModel([r.event for r in found]))


class EventVocabularyModel(_FactsModel, _Columns):
    """Adds ``idxs`` and ``cnts``, the sparse event counts of a row; row by row, without a shuffle."""

    eventsCol = EventVocabulary.eventsCol

    def __init__(self, events: list[str]):
        super().__init__()
        self._setDefault(eventsCol="events")
        self.events = events

    def _facts(self) -> dict:
        return {"events": self.events}

    @classmethod
    def _restored(cls, spark, facts: dict, path: str) -> "EventVocabularyModel":
        return cls(facts["events"])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        known = F.array(*map(F.lit, self.events)) if self.events else F.expr("cast(array() as array<string>)")
        places = F.transform(F.coalesce(F.col(self.getOrDefault("eventsCol")), F.expr("cast(array() as array<string>)")), lambda e: F.array_position(known, e))
        found = dataset.withColumn("_places", F.filter(places, lambda p: p > 0))
        idxs = F.transform(F.array_sort(F.array_distinct("_places")), lambda p: (p - 1).cast("int"))
        found = found.withColumn("idxs", idxs.alias("idxs", metadata={SIZE: len(self.events)}))
        counts = F.transform("idxs", lambda i: F.size(F.filter("_places", lambda p: p == i + 1)).cast("long"))
        return found.withColumn("cnts", counts).drop("_places")


class IsolationForest(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Isolation forest over ``idxs`` and ``cnts``. Without ``contamination`` the share of label 1 among the rows is taken."""

    numTrees = Param(Params._dummy(), "numTrees", "trees of the forest", TypeConverters.toInt)
    maxSamples = _text("maxSamples", "rows of a tree: 'auto', a number of rows, or a share with a decimal point")
    maxFeatures = Param(Params._dummy(), "maxFeatures", "share of the features that a tree may split on", TypeConverters.toFloat)
    contamination = Param(Params._dummy(), "contamination", "share of the rows below the native cut", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "seed of all draws", TypeConverters.toInt)

    @keyword_only
    def __init__(
        self, *, numTrees: int = 100, maxSamples: str = "1.0", maxFeatures: float = 0.75, contamination: float | None = None, seed: int = 42
    ):
        super().__init__()
        self._setDefault(numTrees=100, maxSamples="1.0", maxFeatures=0.75, seed=42)
        self._set(**self._input_kwargs)

    def params_for(self, rows: DataFrame) -> ForestParams:
        samples = self.getOrDefault("maxSamples")
        samples = samples if samples == "auto" else float(samples) if "." in samples else int(samples)
        if self.isDefined("contamination"):
            share = self.getOrDefault("contamination")
        else:
            share = splits.contamination(rows.select(F.col(self.getOrDefault("labelCol")).alias("label"))).first()[0]
        return ForestParams(self.getOrDefault("numTrees"), samples, self.getOrDefault("maxFeatures"), share, self.getOrDefault("seed"))

    def _fit(self, dataset: DataFrame) -> "IsolationForestModel":
        size = dataset.schema["idxs"].metadata.get(SIZE)
        rows = materialize(self._rows(dataset, False).select("idxs", "cnts", self.getOrDefault("labelCol")), "fit-rows")
        if size is None:
            size = (rows.agg(F.max(F.array_max("idxs"))).first()[0] or 0) + 1
        return self._copyValues(IsolationForestModel(fit_forest(rows, size, self.params_for(rows))))


class IsolationForestModel(_FactsModel, _Columns):
    """Adds ``anomaly_score`` (below 0 is anomalous at the native cut) and ``if_class``."""

    numTrees, maxSamples, maxFeatures = IsolationForest.numTrees, IsolationForest.maxSamples, IsolationForest.maxFeatures
    contamination, seed = IsolationForest.contamination, IsolationForest.seed

    def __init__(self, forest: ForestModel):
        super().__init__()
        self.forest = forest

    def _facts(self) -> dict:
        forest = self.forest
        return {"n_features": forest.n_features, "sample_size": forest.sample_size, "offset": forest.offset, "params": asdict(forest.params)}

    def _tables(self) -> dict[str, DataFrame]:
        return {"nodes": self.forest.nodes}

    @classmethod
    def _restored(cls, spark, facts: dict, path: str) -> "IsolationForestModel":
        nodes = spark.read.schema(NODES).parquet(f"{path}/nodes")
        return cls(ForestModel(nodes, facts["n_features"], facts["sample_size"], ForestParams(**facts["params"]), facts["offset"]))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        size = dataset.schema["idxs"].metadata.get(SIZE, self.forest.n_features)
        if size != self.forest.n_features:
            raise ValueError(f"the model has {self.forest.n_features} features but the vectors have {size}")
        return self.forest.transform(dataset)


class ScoreThreshold(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """The threshold with the best F-beta under a precision floor."""

    beta = Param(Params._dummy(), "beta", "weight of recall", TypeConverters.toFloat)
    minPrecision = Param(Params._dummy(), "minPrecision", "precision floor; 0 for none", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, beta: float = 2.0, minPrecision: float = 0.75):
        super().__init__()
        self._setDefault(beta=2.0, minPrecision=0.75)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "ScoreThresholdModel":
        scored = self._rows(dataset, True)
        floor = self.getOrDefault("minPrecision") or None
        found = calibrate.calibrate(scored, label=self.getOrDefault("labelCol"), beta=self.getOrDefault("beta"), min_precision=floor)
        return self._copyValues(ScoreThresholdModel(found.first().asDict(recursive=True)))


class ScoreThresholdModel(_FactsModel, _Columns):
    """Adds ``prediction`` and the threshold's columns."""

    beta, minPrecision = ScoreThreshold.beta, ScoreThreshold.minPrecision

    def __init__(self, threshold: dict):
        super().__init__()
        self.threshold = threshold

    def _facts(self) -> dict:
        return self.threshold

    @classmethod
    def _restored(cls, spark, facts: dict, path: str) -> "ScoreThresholdModel":
        return cls(facts)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        config = [tuple(self.threshold[c] for c in ("algorithm", "score_threshold", "score_direction"))]
        kind = "algorithm string, score_threshold double, score_direction string"
        return score.apply_threshold(dataset, dataset.sparkSession.createDataFrame(config, kind))


class AnomalyF1(Evaluator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """F1 of the anomaly class at the forest's native cut, for ``CrossValidator(..., foldCol=...)`` with ``tuning.with_folds``."""

    def _evaluate(self, dataset: DataFrame) -> float:
        flagged = F.sum((F.col("if_class") == -1).cast("int"))
        actual = F.sum(F.col(self.getOrDefault("labelCol")).cast("int"))
        hit = F.sum(((F.col("if_class") == -1) & (F.col(self.getOrDefault("labelCol")) == 1)).cast("int"))
        hits, total = dataset.agg(F.coalesce(hit, F.lit(0)), F.coalesce(flagged + actual, F.lit(0))).first()
        return 2 * hits / total if total else 0.0

    def isLargerBetter(self) -> bool:
        return True
