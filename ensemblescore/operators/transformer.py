"""The Spark ML stage that scores a model."""

from __future__ import annotations

from pyspark import SparkContext, keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ensemblescore.operators import inputs, outputs
from ensemblescore.plans import arrow, boxes, chunked, expression, relational, strategy, trees
from ensemblescore.sources.spec import MAX_BROADCAST_NODES, ModelSpec, load_spec
from ensemblescore.sources.tables import ModelTables


def _string_param(name: str, doc: str) -> Param:
    return Param(Params._dummy(), name, doc, typeConverter=TypeConverters.toString)


class EnsembleModel(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Scores the tree ensemble stored under ``modelPath``.

    A model with a single vector input reads ``featuresCol``; any other reads each
    input from the column of its name. One output gives ``predictionCol``; several
    give ``probabilityCol`` and, as the index of the largest, ``predictionCol``.

    >>> model = EnsembleModel.loadFile("/models/churn")
    >>> scored = model.transform(df)
    """

    modelPath = _string_param("modelPath", "directory of the model tables")
    modelId = _string_param("modelId", "which model to score, if the directory holds several")
    featuresCol = _string_param(
        "featuresCol", "vector column read by a model with a single vector input")
    predictionCol = _string_param(
        "predictionCol", "output column: the score, or the index of the largest output")
    probabilityCol = _string_param(
        "probabilityCol", "output column: all outputs as a vector, if there are several")
    strategy = _string_param("strategy", "auto, expr, arrow, chunked, trees, join or boxes")
    maxBroadcastNodes = Param(
        Params._dummy(), "maxBroadcastNodes", "nodes of a model, or of a chunk of it, that are "
        "broadcast at once; it decides the plan and no result", typeConverter=TypeConverters.toInt)
    maxBroadcastChars = Param(
        Params._dummy(), "maxBroadcastChars", "characters of category names beyond which strings are coded "
        "by a join; it decides the plan and no result", typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, modelPath: str | None = None, modelId: str | None = None,
                 featuresCol: str = "features", predictionCol: str = "prediction",
                 probabilityCol: str = "probability", strategy: str = "auto",
                 maxBroadcastNodes: int = MAX_BROADCAST_NODES) -> None:
        super().__init__()
        self._loaded: tuple | None = None
        self._prepared: tuple | None = None
        self._setDefault(featuresCol="features", predictionCol="prediction",
                         probabilityCol="probability", strategy="auto",
                         maxBroadcastNodes=MAX_BROADCAST_NODES)
        self.setParams(**self._input_kwargs)

    @keyword_only
    def setParams(self, *, modelPath: str | None = None, modelId: str | None = None,
                  featuresCol: str = "features", predictionCol: str = "prediction",
                  probabilityCol: str = "probability", strategy: str = "auto",
                  maxBroadcastNodes: int = MAX_BROADCAST_NODES) -> EnsembleModel:
        """Change the params named by keyword and give back this stage, so calls can be chained."""
        return self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    @classmethod
    def loadFile(cls, path: str, modelId: str | None = None) -> EnsembleModel:
        """Open and check the model now, so that a bad path fails here and not in ``transform``."""
        if SparkContext._active_spark_context is None:
            raise RuntimeError(
                "no Spark application is running to read the model with: start an active session "
                "first, or use EnsembleModel(modelPath=...), which reads it when it scores")
        model = cls(modelPath=path, modelId=modelId)
        model.spec()
        return model

    def spec(self) -> ModelSpec:
        """The model behind the present ``modelPath`` and ``modelId``, read once per such pair."""
        return self._load()[1]

    def _load(self) -> tuple[ModelTables, ModelSpec]:
        if not self.isDefined(self.modelPath):
            raise ValueError("modelPath is not set")
        key = (self.getModelPath(), self.getModelId(), self.getMaxBroadcastNodes(), self.getMaxBroadcastChars())
        if self._loaded is None or self._loaded[0] != key:
            spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
            tables = ModelTables.read(spark, key[0])
            self._loaded = (key, tables, load_spec(
                tables, key[1], max_nodes=key[2], max_chars=key[3]))
        return self._loaded[1:]

    @property
    def outputColsPerRow(self) -> int:
        """Number of outputs per row."""
        return self.spec().n_outputs

    @property
    def totalInputFeatures(self) -> int:
        """Number of features over all inputs."""
        return self.spec().input_width

    def transformSchema(self, schema: StructType) -> StructType:
        """The schema ``transform`` will give, without touching data."""
        spec = self.spec()
        inputs.bind(spec, schema, self.getFeaturesCol())
        return outputs.extended(
            schema, outputs.output_fields(spec, self.getProbabilityCol(), self.getPredictionCol()))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        tables, spec = self._load()
        self.transformSchema(dataset.schema)
        bound = inputs.bind(spec, dataset.schema, self.getFeaturesCol())
        plan = strategy.choose(spec, self.getStrategy(), dataset.isStreaming)
        sums = f"__sums_{self.uid}"
        one = tables.only(spec.model_id)
        coded, bound = inputs.with_codes(dataset, bound, one, sums)
        if plan == strategy.EXPR:
            summed = expression.add_sums(coded, bound, spec.forest, spec.n_outputs, sums)
        elif plan == strategy.ARROW:
            summed = arrow.add_sums(coded, bound, self._prepare(dataset, spec), sums)
        elif plan == strategy.CHUNKED:
            summed = chunked.add_sums(coded, bound, *self._prepare_chunks(dataset, one, spec),
                                      spec.n_outputs, sums)
        elif plan == strategy.TREES:
            summed = trees.add_sums(coded, bound, one, spec, sums)
        else:
            by = relational if plan == strategy.JOIN else boxes
            summed = by.add_sums(coded, bound, one, spec.n_outputs, sums)
        return outputs.append(summed, sums, dataset.columns, spec, self.getProbabilityCol(),
                              self.getPredictionCol())

    def _once(self, dataset: DataFrame, spec: ModelSpec, what: str, prepare):
        """Broadcast the model once per application, not once per ``transform``."""
        key = (what, dataset.sparkSession.sparkContext.applicationId)
        if self._prepared is None or self._prepared[0] is not spec or self._prepared[1] != key:
            if self._prepared is not None and self._prepared[1][1] == key[1]:
                self._prepared[3]()
            self._prepared = (spec, key, *prepare())
        return self._prepared[2]

    def _prepare(self, dataset: DataFrame, spec: ModelSpec) -> arrow.Prepared:
        def prepare():
            prepared = arrow.prepare(dataset.sparkSession.sparkContext, spec)
            return prepared, prepared.release
        return self._once(dataset, spec, strategy.ARROW, prepare)

    def _prepare_chunks(self, dataset: DataFrame, one: ModelTables, spec: ModelSpec) -> tuple:
        def prepare():
            chunks = chunked.prepare(one, spec, self.getMaxBroadcastNodes())
            lookups = dataset.sparkSession.sparkContext.broadcast(arrow.lookups(spec))

            def release():
                for shared in (*chunks, lookups):
                    shared.unpersist()
            return (chunks, lookups), release
        return self._once(dataset, spec, strategy.CHUNKED, prepare)

    def setModelPath(self, value: str) -> EnsembleModel:
        return self._set(modelPath=value)

    def setModelId(self, value: str) -> EnsembleModel:
        return self._set(modelId=value)

    def setFeaturesCol(self, value: str) -> EnsembleModel:
        return self._set(featuresCol=value)

    def setPredictionCol(self, value: str) -> EnsembleModel:
        return self._set(predictionCol=value)

    def setProbabilityCol(self, value: str) -> EnsembleModel:
        return self._set(probabilityCol=value)

    def setStrategy(self, value: str) -> EnsembleModel:
        return self._set(strategy=value)

    def setMaxBroadcastNodes(self, value: int) -> EnsembleModel:
        return self._set(maxBroadcastNodes=value)

    def setMaxBroadcastChars(self, value: int) -> EnsembleModel:
        return self._set(maxBroadcastChars=value)

    def getMaxBroadcastChars(self) -> int | None:
        return self.getOrDefault(self.maxBroadcastChars) if self.isDefined(self.maxBroadcastChars) else None

    def getMaxBroadcastNodes(self) -> int:
        return self.getOrDefault(self.maxBroadcastNodes)

    def getModelPath(self) -> str:
        return self.getOrDefault(self.modelPath)

    def getModelId(self) -> str | None:
        return self.getOrDefault(self.modelId) if self.isDefined(self.modelId) else None

    def getFeaturesCol(self) -> str:
        return self.getOrDefault(self.featuresCol)

    def getPredictionCol(self) -> str:
        return self.getOrDefault(self.predictionCol)

    def getProbabilityCol(self) -> str:
        return self.getOrDefault(self.probabilityCol)

    def getStrategy(self) -> str:
        return self.getOrDefault(self.strategy)
