"""Several outputs: probability vector and argmax."""

import math

import numpy as np
import pytest
from pyspark.ml.linalg import VectorUDT
from pyspark.sql.types import DoubleType

import ensemblescore as es
from ensemblescore import EnsembleModel

# Softmax of the scores (2, 0, -1).
LEFT = [0.8437947, 0.1141952, 0.0420101]
STRATEGIES = ["expr", "arrow", "join"]


def test_widths(classifier):
    m = EnsembleModel.loadFile(classifier)
    assert m.outputColsPerRow == 3 and m.totalInputFeatures == 2


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_schema(classifier, features, strategy):
    df = features([(0.1, 0.0)])
    m = EnsembleModel(modelPath=classifier, strategy=strategy)
    out = m.transform(df)
    assert out.columns == ["f0", "f1", "features", "probability", "prediction"]
    assert isinstance(out.schema["probability"].dataType, VectorUDT)
    assert out.schema["prediction"].dataType == DoubleType()
    assert not out.schema["prediction"].nullable
    assert out.schema == m.transformSchema(df.schema)


def test_renamed_outputs(classifier, features):
    out = EnsembleModel(modelPath=classifier, probabilityCol="chances",
                        predictionCol="class").transform(features([(0.1, 0.0)]))
    assert out.columns[-2:] == ["chances", "class"]


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_values(classifier, features, strategy):
    rows = [(0.0, 0.0), (0.1, 0.0), (0.4, 1.0), (0.5, 0.0), (0.9, 0.0), (1.0, 2.0)]
    out = EnsembleModel(modelPath=classifier, strategy=strategy).transform(features(rows, 3))
    got = out.collect()
    assert len(got) == 6
    for r in got:
        p = r.probability.toArray()
        assert np.allclose(p, LEFT if r.f0 < 0.5 else LEFT[::-1], atol=1e-6)
        assert math.isclose(p.sum(), 1.0, abs_tol=1e-5)
        assert r.prediction == (0.0 if r.f0 < 0.5 else 2.0) == float(np.argmax(p))
        assert all(v == np.float32(v) for v in p)


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_many_partitions(classifier, features, strategy):
    rows = [(0.1 if i % 2 == 0 else 0.9, float(i)) for i in range(60)]
    out = EnsembleModel(modelPath=classifier, strategy=strategy).transform(features(rows, 6))
    assert {r.f1: r.prediction for r in out.collect()} == {
        float(i): 0.0 if i % 2 == 0 else 2.0 for i in range(60)}


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_empty_input(classifier, features, strategy):
    out = EnsembleModel(modelPath=classifier, strategy=strategy).transform(features([]))
    assert out.count() == 0 and out.columns[-2:] == ["probability", "prediction"]


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_first_of_equal_maxima_wins(spark, store, strategy):
    path = store([es.scalar("a")], [es.constant(v) for v in (1, 3, 3, 2)], groups=[0, 1, 2, 3])
    out = EnsembleModel(modelPath=path, strategy=strategy).transform(
        spark.createDataFrame([(0.0,)], "a double")).head()
    assert out.prediction == 1.0 and list(out.probability) == [1, 3, 3, 2]


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_a_tie_made_by_narrowing_goes_to_the_first(spark, store, strategy):
    """2**24 and 2**24 + 1 are one float32."""
    path = store([es.scalar("a")], [es.constant(2.0 ** 24), es.constant(2.0 ** 24), es.constant(1)],
                 groups=[0, 1, 1])
    out = EnsembleModel(modelPath=path, strategy=strategy).transform(
        spark.createDataFrame([(0.0,)], "a double")).head()
    assert out.prediction == 0.0


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_softmax_does_not_overflow_and_spells_out_or_loops_alike(spark, store, strategy):
    df = spark.createDataFrame([(0.0,)], "a double")
    for n in (2, 16, 17, 40):
        path = store([es.scalar("a")], [es.constant(1000.0 + k) for k in range(n)],
                     groups=list(range(n)), post_transform="SOFTMAX")
        out = EnsembleModel(modelPath=path, strategy=strategy).transform(df).head()
        want = np.exp(np.arange(n) - (n - 1.0))
        assert np.allclose(out.probability.toArray(), want / want.sum(), rtol=1e-6)
        assert out.prediction == n - 1


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_an_output_without_trees_scores_zero(spark, store, strategy):
    path = store([es.scalar("a")], [es.constant(-1), es.constant(-2)], groups=[0, 2])
    out = EnsembleModel(modelPath=path, strategy=strategy).transform(
        spark.createDataFrame([(0.0,)], "a double")).head()
    assert list(out.probability) == [-1, 0, -2] and out.prediction == 1.0


def test_softmax_of_one_output_is_one(spark, store):
    path = store([es.scalar("a")], [es.constant(5)], post_transform="SOFTMAX")
    for strategy in STRATEGIES:
        out = EnsembleModel(modelPath=path, strategy=strategy).transform(
            spark.createDataFrame([(0.0,)], "a double"))
        assert out.columns == ["a", "prediction"] and out.head().prediction == 1.0
