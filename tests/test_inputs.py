"""Named scalars, several vectors, strings, coercions, nulls and NaN."""

import datetime
import decimal
import math

import pytest
from pyspark.ml.linalg import Vectors

import ensemblescore as es
from ensemblescore import EnsembleModel, InputError

STRATEGIES = ["expr", "arrow", "join"]
each_strategy = pytest.mark.parametrize("strategy", STRATEGIES)


def run(path, df, strategy):
    return EnsembleModel(modelPath=path, strategy=strategy).transform(df).collect()


@each_strategy
def test_every_numeric_type(spark, store, strategy):
    types = ["tinyint", "smallint", "int", "bigint", "float", "double", "decimal(10,2)"]
    path = store([es.scalar(f"c{k}") for k in range(7)],
                 [es.stump(k, 10, 2.0 ** k, 0) for k in range(7)])
    small = [3, 3, 3, 3, 3.0, 3.0, decimal.Decimal("3.00")]
    large = [30, 30, 30, 30, 30.0, 30.0, decimal.Decimal("10.00")]
    df = spark.createDataFrame([small, large],
                               ", ".join(f"c{k} {t}" for k, t in enumerate(types)))
    assert sorted(r.prediction for r in run(path, df, strategy)) == [0.0, 127.0]


@each_strategy
def test_null_scalar_is_zero_and_nan_is_missing(spark, store, strategy):
    path = store([es.scalar("a")], [es.stump(0, 0.5, 1, 2),
                                    es.Split(0, 0.5, es.Leaf(10), es.Leaf(20), missing="below"),
                                    es.stump(0, -0.5, 100, 200)])
    values = {0: None, 1: float("nan"), 2: 0.0, 3: -0.0, 4: 1.0, 5: float("inf"),
              6: float("-inf")}
    df = spark.createDataFrame(list(values.items()), "k int, a double")
    got = {r.k: r.prediction for r in run(path, df, strategy)}
    assert got == {0: 211, 1: 212, 2: 211, 3: 211, 4: 222, 5: 222, 6: 111}


@each_strategy
def test_comparison_is_float32_on_both_sides(spark, store, strategy):
    """0.05 as a double lies below float32(0.05) but narrows to just that."""
    path = store([es.scalar("a")], [es.stump(0, 0.05, 1, 2)])
    df = spark.createDataFrame([(0.05,), (math.nextafter(0.05, 0),), (0.049,)], "a double")
    assert sorted(r.prediction for r in run(path, df, strategy)) == [1, 2, 2]


@each_strategy
def test_several_vectors_keep_their_offsets(spark, store, strategy):
    path = store([es.vector("u", 3), es.vector("w", 2)],
                 [es.stump(k, 0.5, 0, 2.0 ** k) for k in range(5)])
    df = spark.createDataFrame(
        [(Vectors.dense(1, 0, 1), Vectors.sparse(2, [1], [1.0]))], ["u", "w"])
    assert run(path, df, strategy)[0].prediction == 1 + 4 + 16


@each_strategy
def test_vector_number_and_string_together(spark, store, strategy):
    path = store([es.vector("u", 2), es.scalar("b"), es.category("s", ["x", "y'\\z", "w"])],
                 [es.stump(1, 0.5, 0, 1), es.stump(2, 0.5, 0, 10),
                  es.Split(3, 0.5, es.Leaf(100), es.stump(3, 1.5, 200, 300), missing="below")])
    rows = [(0, Vectors.dense(0, 1), 1.0, "x"), (1, Vectors.dense(0, 0), 0.0, "y'\\z"),
            (2, Vectors.dense(0, 0), None, "w"), (3, Vectors.dense(0, 0), 0.0, "unknown"),
            (4, Vectors.dense(0, 0), 0.0, None)]
    df = spark.createDataFrame(rows, ["k", "u", "b", "s"])
    assert {r.k: r.prediction for r in run(path, df, strategy)} == {
        0: 111, 1: 200, 2: 300, 3: 100, 4: 100}


@each_strategy
def test_long_vocabulary_and_repeated_categories(spark, store, strategy):
    names = [f"name {k}" for k in range(500)] + ["name 3"]
    path = store([es.category("s", names)],
                 [es.Split(0, 250, es.stump(0, 3.5, 1, 2), es.Leaf(3), missing="below")])
    df = spark.createDataFrame(
        [(0, "name 3"), (1, "name 4"), (2, "name 400"), (3, "other"), (4, None)],
        "k int, s string")
    got = {r.k: r.prediction for r in run(path, df, strategy)}
    assert got == {0: 1, 1: 2, 2: 3, 3: 2, 4: 2}


def test_long_vocabulary_goes_to_arrow(spark, store):
    path = store([es.category("s", [str(k) for k in range(500)])], [es.constant(1)])
    out = EnsembleModel(modelPath=path).transform(spark.createDataFrame([("1",)], "s string"))
    assert "ArrowEvalPython" in out._jdf.queryExecution().toString()


@pytest.mark.parametrize("column, value", [
    ("boolean", True), ("date", datetime.date(2020, 1, 1)), ("string", "1"),
    ("timestamp", datetime.datetime(2020, 1, 1)), ("array<int>", [1]), ("map<string,int>", {}),
    ("struct<x:int>", (1,))])
def test_other_types_are_refused_on_the_driver(spark, store, column, value):
    path = store([es.scalar("a")], [es.constant(1)])
    with pytest.raises(InputError, match="needs a number"):
        EnsembleModel(modelPath=path).transform(spark.createDataFrame([(value,)], f"a {column}"))


def test_wrong_kinds_for_vectors_and_strings(spark, store):
    df = spark.createDataFrame([(1.0,)], "a double")
    with pytest.raises(InputError, match="needs a string"):
        EnsembleModel(modelPath=store([es.category("a", ["x"])], [es.constant(1)])).transform(df)
    with pytest.raises(InputError, match="needs a vector"):
        EnsembleModel(modelPath=store([es.vector("X", 1)], [es.constant(1)]),
                      featuresCol="a").transform(df)


def test_untyped_null_counts_as_null(spark, store):
    path = store([es.scalar("a")], [es.stump(0, 0.5, 1, 2)])
    df = spark.sql("SELECT null AS a")
    assert EnsembleModel(modelPath=path).transform(df).head().prediction == 1


def test_missing_named_input(spark, store):
    path = store([es.scalar("a"), es.scalar("b")], [es.constant(1)])
    with pytest.raises(InputError, match="'b'"):
        EnsembleModel(modelPath=path).transform(spark.createDataFrame([(1.0,)], "a double"))


def test_single_scalar_reads_its_own_name_not_features_col(spark, store):
    path = store([es.scalar("a.b c")], [es.stump(0, 0.5, 1, 2)])
    df = spark.createDataFrame([(0.0, 9.0)], ["a.b c", "features"])
    assert EnsembleModel(modelPath=path).transform(df).head().prediction == 1


@pytest.mark.parametrize("strategy", ["expr", "arrow"])
def test_three_hundred_named_inputs(spark, store, strategy):
    path = store([es.scalar(f"c{k}") for k in range(300)],
                 [es.stump(k, 0.5, 0, 1) for k in range(0, 300, 3)])
    df = spark.range(4).selectExpr("id", *[f"cast((id * {k}) % 2 AS double) AS c{k}"
                                           for k in range(300)])
    got = {r.id: r.prediction for r in run(path, df, strategy)}
    assert got == {0: 0.0, 1: 50.0, 2: 0.0, 3: 50.0}
