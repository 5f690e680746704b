"""One output: params, schema, values."""

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Params
from pyspark.sql.types import DoubleType

from ensemblescore import EnsembleModel, InputError

STRATEGIES = ["expr", "arrow", "join"]


def scores(df, key="f0"):
    return {r[key]: r.prediction for r in df.collect()}


def test_defaults(regression):
    m = EnsembleModel(modelPath=regression)
    assert m.getModelPath() == regression
    assert (m.getFeaturesCol(), m.getPredictionCol(), m.getProbabilityCol()) == (
        "features", "prediction", "probability")
    assert m.getModelId() is None and m.getStrategy() == "auto"


def test_setters_chain_and_getters_agree():
    m = EnsembleModel()
    assert (m.setModelPath("p").setModelId("i").setFeaturesCol("f").setPredictionCol("s")
            .setProbabilityCol("q").setStrategy("arrow")) is m
    assert [m.getModelPath(), m.getModelId(), m.getFeaturesCol(), m.getPredictionCol(),
            m.getProbabilityCol(), m.getStrategy()] == ["p", "i", "f", "s", "q", "arrow"]


def test_constructor_and_set_params_take_keywords_only():
    m = EnsembleModel(modelPath="p", featuresCol="a", predictionCol="b", probabilityCol="c")
    assert [m.getFeaturesCol(), m.getPredictionCol(), m.getProbabilityCol()] == ["a", "b", "c"]
    assert m.setParams(modelPath="other", predictionCol="d") is m
    assert (m.getModelPath(), m.getFeaturesCol(), m.getPredictionCol()) == ("other", "a", "d")
    with pytest.raises(TypeError):
        EnsembleModel("p")


def test_params_are_documented():
    m = EnsembleModel()
    assert isinstance(m, Params)
    assert {p.name for p in m.params} == {
        "modelPath", "modelId", "featuresCol", "predictionCol", "probabilityCol", "strategy",
        "maxBroadcastNodes"}
    assert all(p.doc for p in m.params)
    with pytest.raises(TypeError):
        m.setFeaturesCol(3)


def test_copy_keeps_all_params(regression):
    m = EnsembleModel(modelPath=regression).setFeaturesCol("f").setPredictionCol("s")
    c = m.copy()
    assert c is not m and c.extractParamMap().values().__len__() == len(m.extractParamMap())
    assert (c.getModelPath(), c.getFeaturesCol(), c.getPredictionCol()) == (regression, "f", "s")
    c.setFeaturesCol("g")
    assert m.getFeaturesCol() == "f"


def test_widths(regression):
    m = EnsembleModel.loadFile(regression)
    assert m.outputColsPerRow == 1 and m.totalInputFeatures == 2


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_schema(regression, features, strategy):
    df = features([(0.1, 0.0)])
    m = EnsembleModel(modelPath=regression, strategy=strategy)
    out = m.transform(df)
    assert out.columns == ["f0", "f1", "features", "prediction"]
    assert out.schema["prediction"].dataType == DoubleType()
    assert not out.schema["prediction"].nullable
    assert out.schema == m.transformSchema(df.schema)


def test_probability_name_is_not_used(regression, features):
    out = EnsembleModel(modelPath=regression, probabilityCol="chances").transform(
        features([(0.1, 0.0)]))
    assert "chances" not in out.columns and "probability" not in out.columns


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_branches_and_boundary(regression, features, strategy):
    rows = [(0.0, 0.0), (0.1, 99.0), (0.4, -3.0), (0.5, 0.0), (0.6, 1.0), (0.9, 99.0), (1.0, 0.0)]
    out = EnsembleModel(modelPath=regression, strategy=strategy).transform(features(rows, 3))
    got = {round(k, 1): v for k, v in scores(out).items()}
    assert got == {0.0: 2, 0.1: 2, 0.4: 2, 0.5: -2, 0.6: -2, 0.9: -2, 1.0: -2}


def test_second_feature_is_ignored(regression, features):
    out = EnsembleModel(modelPath=regression).transform(
        features([(0.1, v) for v in (-1000.0, 0.0, 1000.0)]))
    assert [r.prediction for r in out.collect()] == [2.0] * 3


@pytest.mark.parametrize("strategy", STRATEGIES)
@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_any_partitioning(regression, features, partitions, strategy):
    rows = [(0.1 if i % 2 == 0 else 0.9, float(i)) for i in range(100)]
    out = EnsembleModel(modelPath=regression, strategy=strategy).transform(
        features(rows, partitions))
    got = scores(out, "f1")
    assert got == {float(i): 2.0 if i % 2 == 0 else -2.0 for i in range(100)}


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_dense_sparse_and_arrays(spark, regression, strategy):
    m = EnsembleModel(modelPath=regression, strategy=strategy)
    vectors = [(Vectors.dense(0.1, 0.0),), (Vectors.sparse(2, [0], [0.1]),),
               (Vectors.sparse(2, [], []),), (Vectors.sparse(2, [0], [0.7]),)]
    out = m.transform(spark.createDataFrame(vectors, ["features"]))
    assert sorted(r.prediction for r in out.collect()) == [-2.0, 2.0, 2.0, 2.0]
    arrays = spark.createDataFrame([([0.1, 1.0],), ([0.7, 1.0],), ([None, 1.0],)],
                                   "features array<double>")
    assert sorted(r.prediction for r in m.transform(arrays).collect()) == [-2.0, 2.0, 2.0]


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_empty_input(regression, features, strategy):
    m = EnsembleModel(modelPath=regression, strategy=strategy)
    for df in (features([]), features([(0.1, 0.0)]).filter("f0 < 0")):
        out = m.transform(df)
        assert out.count() == 0 and out.columns[-1] == "prediction"


def test_renamed_columns(regression, features):
    df = features([(0.1, 0.0)]).withColumnRenamed("features", "my feats.v1")
    out = EnsembleModel(modelPath=regression, featuresCol="my feats.v1",
                        predictionCol="my score.v1").transform(df)
    assert out.columns[-1] == "my score.v1" and "prediction" not in out.columns
    assert out.head()["my score.v1"] == 2.0


def test_output_name_clash_is_an_error(regression, features):
    m = EnsembleModel(modelPath=regression)
    for name in ("prediction", "Prediction"):
        with pytest.raises(InputError, match="already has"):
            m.transform(features([(0.1, 0.0)]).withColumnRenamed("f1", name))


def test_missing_column_names_itself(regression, features):
    with pytest.raises(InputError, match="'X'.*'feats'"):
        EnsembleModel(modelPath=regression, featuresCol="feats").transform(features([(0.1, 0.0)]))


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_wrong_width_names_both(spark, regression, strategy):
    df = spark.createDataFrame([(Vectors.dense(0.1, 0.2, 0.3),)], ["features"])
    with pytest.raises(Exception, match="holds a vector of 3, the model declares 2"):
        EnsembleModel(modelPath=regression, strategy=strategy).transform(df).collect()


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_null_vector_is_an_error(spark, regression, features, strategy):
    df = features([(0.1, 0.0)]).selectExpr("if(f0 < 1, null, features) AS features")
    with pytest.raises(Exception, match="null vector"):
        EnsembleModel(modelPath=regression, strategy=strategy).transform(df).collect()


def test_path_change_changes_the_model(regression, classifier):
    m = EnsembleModel(modelPath=regression)
    assert m.outputColsPerRow == 1
    assert m.setModelPath(classifier).outputColsPerRow == 3
