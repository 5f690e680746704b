"""Random forests: all plans against a row-by-row walk."""

import random

import numpy as np
import pytest
from conftest import brute
from hypothesis import given, settings
from hypothesis import strategies as st

import ensemblescore as es
from ensemblescore import EnsembleModel
from ensemblescore.functions.trees import double_literal, float_literal


def grow(rng, depth, width):
    """A lopsided tree with thresholds that rows hit exactly."""
    if depth == 0 or rng.random() < 0.2:
        return es.Leaf(rng.randint(-640, 640) / 64 if rng.random() < 0.5 else rng.gauss(0, 1))
    return es.Split(rng.randrange(width), rng.choice([-1.5, 0.0, 0.05, 0.1, 1e-7, 3e9, rng.gauss(0, 1)]),
                    grow(rng, depth - 1, width), grow(rng, depth - 1, width),
                    rng.choice(["below", "otherwise"]))


def rows_of(rng, n):
    value = [None, float("nan"), 0.0, -0.0, 0.05, 0.1, -1.5, 1e-7, 3e9, float("inf"), -float("inf")]
    return [(i, *[rng.choice(value) if rng.random() < 0.5 else rng.gauss(0, 1) for _ in range(4)])
            for i in range(n)]


@pytest.mark.parametrize("seed, n_trees, depth, n_outputs", [
    (1, 1, 1, 1), (2, 7, 5, 1), (3, 12, 4, 3), (4, 3, 12, 2)])
def test_all_plans_equal_a_plain_walk(spark, store, seed, n_trees, depth, n_outputs):
    rng = random.Random(seed)
    trees = [grow(rng, depth, 4) for _ in range(n_trees)]
    groups = [k % n_outputs for k in range(n_trees)]
    path = store([es.scalar(c) for c in "abcd"], trees, groups=groups)
    rows = rows_of(rng, 300)
    df = spark.createDataFrame(rows + rows[:50], "k int, a double, b double, c double, d double")

    want = {}
    for k, *x in rows:
        x = [0.0 if v is None else v for v in x]
        sums = [0.0] * n_outputs
        for tree, g in zip(trees, groups):
            sums[g] += brute(tree, x)
        want[k] = [float(np.float32(s)) for s in sums]
    for strategy in ("expr", "arrow", "join"):
        out = EnsembleModel(modelPath=path, strategy=strategy).transform(df).collect()
        assert len(out) == 350
        for r in out:
            if n_outputs == 1:
                assert [r.prediction] == want[r.k], strategy
            else:
                assert list(r.probability) == want[r.k], strategy
                assert r.prediction == float(np.argmax(want[r.k])), strategy


def test_softmax_is_the_same_in_all_plans(spark, store):
    rng = random.Random(5)
    path = store([es.scalar(c) for c in "abcd"], [grow(rng, 4, 4) for _ in range(10)],
                 groups=[k % 5 for k in range(10)], post_transform="SOFTMAX")
    df = spark.createDataFrame(rows_of(rng, 200), "k int, a double, b double, c double, d double")
    got = []
    for strategy in ("expr", "arrow", "join"):
        out = EnsembleModel(modelPath=path, strategy=strategy).transform(df).orderBy("k")
        got.append([(list(r.probability), r.prediction) for r in out.collect()])
    assert got[0] == got[1] == got[2]


def test_batches_smaller_than_a_partition(spark, store):
    rng = random.Random(6)
    tree = grow(rng, 6, 4)
    path = store([es.scalar(c) for c in "abcd"], [tree] * 3)
    rows = rows_of(rng, 100)
    df = spark.createDataFrame(rows, "k int, a double, b double, c double, d double").coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        out = EnsembleModel(modelPath=path, strategy="arrow").transform(df).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = {k: float(np.float32(3 * brute(tree, [0.0 if v is None else v for v in x])))
            for k, *x in rows}
    assert {r.k: r.prediction for r in out} == pytest.approx(want, rel=1e-6)


@settings(max_examples=200, deadline=None)
@given(st.floats(width=32, allow_nan=False))
def test_float_literals_read_back(value):
    text = float_literal(value)
    if "CAST" not in text:
        assert np.float32(text.removesuffix("F")) == np.float32(value)
        assert float(double_literal(value).removesuffix("D")) == value


def test_float_literals_in_spark(spark):
    values = [np.float32(v) for v in (
        0.05, -0.0, 1e-45, 3.4028235e38, 1e-7, 16777216, float("inf"), -float("inf"), 123456.79)]
    row = spark.sql("SELECT " + ", ".join(
        f"{float_literal(v)} AS c{k}, {double_literal(v)} AS d{k}"
        for k, v in enumerate(values))).head()
    for k, v in enumerate(values):
        assert np.float32(row[f"c{k}"]) == v and row[f"d{k}"] == float(v)


def test_size_decides_the_plan(spark, store):
    from ensemblescore.plans import strategy

    small = store([es.scalar("a")], [es.stump(0, 0.5, 1, 2)])
    df = spark.createDataFrame([(0.0,), (1.0,)], "a double")
    large = store([es.scalar("a")], [es.stump(0, 0.5, 1, 2)] * (strategy.MAX_EXPRESSION_NODES // 2))

    def plan(path):
        return EnsembleModel(modelPath=path).transform(df)._jdf.queryExecution().toString()

    assert "ArrowEvalPython" not in plan(small) and "ArrowEvalPython" in plan(large)
    m = EnsembleModel(modelPath=large, maxBroadcastNodes=100)
    out = m.transform(df)
    text = out._jdf.queryExecution().toString()
    assert "ArrowEvalPython" in text and "Join" not in text and "Exchange" not in text
    assert sorted(r.prediction for r in out.collect()) == [64.0, 128.0]
    with pytest.raises(es.ModelError, match="too large"):
        m.setStrategy("arrow").transform(df)
    with pytest.raises(es.ModelError, match="unknown strategy"):
        m.setStrategy("magic").transform(df)


def test_a_chain_as_one_expression(spark, store):
    tree = es.Leaf(-1)
    for k in range(60):
        tree = es.Split(0, float(k), tree, es.Leaf(k))
    path = store([es.scalar("a")], [tree])
    df = spark.createDataFrame([(v,) for v in (-1.0, 0.5, 30.5, 99.0)], "a double")
    got = [{r.a: r.prediction for r in EnsembleModel(modelPath=path, strategy=s).transform(df)
            .collect()} for s in ("expr", "arrow")]
    assert got[0] == got[1] == {-1.0: -1, 0.5: brute(tree, [0.5]),
                                30.5: brute(tree, [30.5]), 99.0: brute(tree, [99.0])}


def test_a_vocabulary_too_long_to_collect(spark, store, monkeypatch):
    from ensemblescore.sources import spec
    path = store([es.category("s", [f"v{k}" for k in range(200)]), es.scalar("a")],
                 [es.stump(0, 100, 1, 2, missing="below"), es.stump(1, 0.5, 10, 20)])
    monkeypatch.setattr(spec, "MAX_BROADCAST_CHARS", 100)
    m = EnsembleModel.loadFile(path)
    assert m.spec().inputs[0].categories is None
    df = spark.createDataFrame([("v3", 0.0), ("v150", 0.0), ("other", 1.0), (None, 1.0)],
                               "s string, a double")
    assert sorted(r.prediction for r in m.transform(df).collect()) == [11, 12, 21, 21]


def test_a_broken_model_too_large_to_collect(spark):
    from ensemblescore.sources.spec import load_spec
    rows = es.model_rows("m", [es.scalar("a")], [es.stump(0, 1, 2, 3)])
    rows["trees"] = [("m", 0, 5)]
    with pytest.raises(es.ModelError, match="bad_tree_group at tree 0"):
        load_spec(es.ModelTables.from_rows(spark, rows), max_nodes=1)
