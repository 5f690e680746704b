"""Rows that name their model: three plans, one answer, hot models and unknown ones."""

import random

import numpy as np
import pytest
from conftest import brute
from pyspark.sql import functions as F

import ensemblescore as es
from ensemblescore import InputError, ModelError, ModelTables, score_registry

PLANS = ["arrow", "group", "join"]
SCHEMA = "k int, m string, a double, b double, s string"


def forest(rng, n, width=2):
    return [es.Split(rng.randrange(width), rng.gauss(0, 1),
                     es.stump(rng.randrange(width), rng.gauss(0, 1), rng.randint(-64, 64) / 64,
                              rng.randint(-64, 64) / 64, rng.choice(["below", "otherwise"])),
                     es.Leaf(rng.randint(-64, 64) / 64), rng.choice(["below", "otherwise"]))
            for _ in range(n)]


@pytest.mark.parametrize("plan", PLANS)
def test_a_hot_model_and_many_cold_ones(spark, plan):
    rng = random.Random(1)
    forests = {f"m{k}": forest(rng, rng.randint(1, 5)) for k in range(30)}
    tables = ModelTables.from_rows(spark, es.merge_rows(*[
        es.model_rows(m, [es.scalar("a"), es.scalar("b")], f) for m, f in forests.items()]))
    rows = []
    for k in range(900):
        # A third of all rows is one copied row of one model; another third is the same model.
        m = "m0" if k < 600 else rng.choice([*forests, "nobody", None])
        a, b = (0.25, 0.5) if k < 300 else (rng.gauss(0, 1), rng.choice([None, float("nan"), 1.0]))
        rows.append((k, m, a, b, "x"))
    df = spark.createDataFrame(rows, SCHEMA)
    out = score_registry(df, tables, "m", strategy=plan, rows_per_group=50)
    assert out.columns == [*df.columns, "prediction"]
    got = {r.k: r.prediction for r in out.collect()}
    assert len(got) == 900
    for k, m, a, b, _ in rows:
        x = [a, 0.0 if b is None else b]
        want = None if m not in forests else float(sum(brute(t, x) for t in forests[m]))
        assert got[k] == want


@pytest.mark.parametrize("plan", PLANS)
def test_models_of_different_kinds(spark, plan):
    tables = ModelTables.from_rows(spark, es.merge_rows(
        es.model_rows("vector", [es.vector("X", 2)],
                      [es.stump(0, 0.5, 2, -1), es.constant(0), es.stump(1, 0.5, -1, 2)],
                      groups=[0, 1, 2], post_transform="SOFTMAX"),
        es.model_rows("text", [es.category("s", ["x", "y"]), es.scalar("a")],
                      [es.Split(0, 0.5, es.Leaf(1), es.stump(1, 0.5, 2, 3), missing="below")]),
        es.model_rows("text2", [es.scalar("b"), es.category("s", ["y", "x"])],
                      [es.stump(1, 0.5, 10, 20), es.stump(0, 0.5, 100, 200)])))
    rows = [(0, "vector", 0.1, 0.1, None), (1, "vector", 0.9, 0.9, "x"), (2, "text", 0.1, 0.0, "x"),
            (3, "text", 0.1, 0.0, "y"), (4, "text", 0.9, 0.0, "y"), (5, "text", 0.9, 0.0, "z"),
            (6, "text2", 0.0, 0.1, "y"), (7, "text2", 0.0, 0.9, "x"), (8, "text2", 0.0, 0.9, None),
            (9, "gone", 0.0, 0.0, "x")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "array(a, b) AS features")
    out = score_registry(df, tables, "m", strategy=plan)
    assert out.columns == [*df.columns, "probability", "prediction"]
    got = {r.k: r for r in out.collect()}
    assert {k: got[k].prediction for k in range(2, 10)} == {
        2: 1, 3: 2, 4: 3, 5: 1, 6: 110, 7: 220, 8: 220, 9: None}
    assert all(got[k].probability is None for k in range(2, 10))
    assert (got[0].prediction, got[1].prediction) == (0, 2)
    left = np.exp([2, 0, -1]) / np.exp([2, 0, -1]).sum()
    assert np.allclose(got[0].probability.toArray(), left, atol=1e-6)
    assert np.allclose(got[1].probability.toArray(), left[::-1], atol=1e-6)


@pytest.mark.parametrize("plan", PLANS)
def test_only_readers_need_the_vector(spark, plan):
    tables = ModelTables.from_rows(spark, es.merge_rows(
        es.model_rows("v", [es.vector("X", 2)], [es.stump(1, 0.5, 1, 2)]),
        es.model_rows("a", [es.scalar("a")], [es.stump(0, 0.5, 10, 20)])))
    df = spark.createDataFrame(
        [(0, "v", 0.0, [0.0, 1.0]), (1, "a", 0.0, None), (2, "a", 1.0, [1.0])],
        "k int, m string, a double, features array<double>")
    got = {r.k: r.prediction for r in score_registry(df, tables, "m", strategy=plan).collect()}
    assert got == {0: 2.0, 1: 10.0, 2: 20.0}
    bad = spark.createDataFrame([(0, "v", 0.0, [1.0])], df.schema)
    with pytest.raises(Exception, match="holds a vector of 1, the model declares 2"):
        score_registry(bad, tables, "m", strategy=plan).collect()


@pytest.mark.parametrize("plan", PLANS)
def test_broken_models_are_refused(spark, plan):
    rows = es.model_rows("m", [es.scalar("a")], [es.stump(0, 1, 2, 3)])
    rows["nodes"][0] = (*rows["nodes"][0][:4], 3, *rows["nodes"][0][5:])
    df = spark.createDataFrame([("m", 1.0)], "m string, a double")
    with pytest.raises(Exception, match="split_feature"):
        score_registry(df, ModelTables.from_rows(spark, rows), "m", strategy=plan).collect()


def test_size_decides_the_plan(spark, monkeypatch):
    from ensemblescore.operators import registry
    bound = registry.MAX_BROADCAST_NODES
    assert registry.choose(bound) == "arrow" and registry.choose(bound + 1) == "group"
    params = spark.range(20).selectExpr("id AS model_id", "0.5 AS threshold", "1.0 AS below",
                                        "2.0 AS otherwise")
    tables = es.stump_registry(params, "a")
    df = spark.createDataFrame([("1", 1.0), ("2", 0.0)], "m string, a double")
    monkeypatch.setattr(registry, "MAX_BROADCAST_NODES", 10)
    monkeypatch.setattr(registry.grouped, "NODES_PER_GROUP", 5)
    assert sorted(r.prediction for r in score_registry(df, tables, "m").collect()) == [1.0, 2.0]
    with pytest.raises(ModelError, match="too large"):
        score_registry(df, tables, "m", strategy="arrow")


def test_refusals(spark):
    tables = ModelTables.from_rows(spark, es.merge_rows(
        es.model_rows("p", [es.scalar("a")], [es.constant(1)]),
        es.model_rows("q", [es.scalar("zz")], [es.constant(1)])))
    df = spark.createDataFrame([(0, "p", 1.0, 1.0, "x")], SCHEMA)
    with pytest.raises(InputError, match="'zz'"):
        score_registry(df, tables, "m")
    with pytest.raises(InputError, match="model id"):
        score_registry(df, tables, "nope")
    with pytest.raises(InputError, match="already"):
        score_registry(df, tables, "m", prediction_col="a")
    with pytest.raises(ModelError, match="unknown registry strategy"):
        score_registry(df, tables, "m", strategy="magic")
    mixed = ModelTables.from_rows(spark, es.merge_rows(
        es.model_rows("p", [es.scalar("s")], [es.constant(1)]),
        es.model_rows("q", [es.category("s", ["x"])], [es.constant(1)])))
    with pytest.raises(ModelError, match="disagree"):
        score_registry(df, mixed, "m")


@pytest.mark.parametrize("plan", PLANS)
def test_columns_keep_their_places_and_names(spark, plan):
    tables = ModelTables.from_rows(spark, es.model_rows("m", [es.scalar("a")], [es.stump(0, 0.5, 1, 2)]))
    df = spark.createDataFrame([(1, "m", 0.0, -7, "p", "q"), (2, "m", 1.0, -8, "r", None)],
                               "k int, m string, a double, __row int, x string, y string").toDF(
        "k", "m", "a", "__row", "dup.name", "dup.name").select("*", F.lit(3).alias("__x"), F.lit(4).alias("__s_"))
    out = score_registry(df, tables, "m", strategy=plan)
    assert out.columns == [*df.columns, "prediction"]
    assert sorted(map(tuple, out.collect()), key=repr) == [
        (1, "m", 0.0, -7, "p", "q", 3, 4, 1.0), (2, "m", 1.0, -8, "r", None, 3, 4, 2.0)]
    read_twice = df.select("*", F.lit(0.0).alias("a"))
    with pytest.raises(InputError, match="several columns are named 'a'"):
        score_registry(read_twice, tables, "m", strategy=plan)


@pytest.mark.parametrize("n_classes", [1, 3])
def test_a_model_larger_than_a_task_may_hold(spark, n_classes):
    """Blocks of its rows meet its trees in chunks, and give what the whole model gives, bit for bit."""
    rng = random.Random(5)
    trees = [es.Split(rng.randrange(2), rng.gauss(0, 1), es.stump(rng.randrange(2), rng.gauss(0, 1), rng.gauss(0, 1), rng.gauss(0, 1)),
                      es.Leaf(rng.gauss(0, 1)), rng.choice(["below", "otherwise"])) for _ in range(60)]
    inputs = [es.scalar("a"), es.scalar("b")]
    tables = ModelTables.from_rows(spark, es.merge_rows(
        es.model_rows("large", inputs, trees, groups=[k % n_classes for k in range(60)],
                      post_transform="SOFTMAX" if n_classes > 1 else "IDENTITY"),
        es.model_rows("unused", inputs, trees), es.model_rows("small", inputs, trees[:2])))
    rows = [(k, ["large", "large", "small", "nobody", None][k % 5], 0.1 if k % 3 else rng.gauss(0, 1),
             rng.choice([None, float("nan"), rng.gauss(0, 1)]), "x") for k in range(500)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = score_registry(df, tables, "m", strategy="arrow")
    for max_nodes in (1, 7, 50, 300):
        got = score_registry(df, tables, "m", strategy="group", max_nodes=max_nodes, rows_per_group=40)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_the_grouped_plan_shuffles_rows_once_and_joins_nothing_back(spark):
    tables = ModelTables.from_rows(spark, es.model_rows("m", [es.scalar("a")], [es.stump(0, 0.5, 1, 2)]))
    df = spark.createDataFrame([("m", 0.0)], "m string, a double")
    plan = score_registry(df, tables, "m", strategy="group")._jdf.queryExecution().optimizedPlan().toString()
    rows = plan[:plan.index("Union")]
    assert "Join" not in rows and rows.count("Repartition") == 1
