"""Registries of forests from rows of preorder arrays, against the builder of nested trees."""

import random

import numpy as np
import pytest

import ensemblescore as es
from ensemblescore.errors import ModelError
from ensemblescore.functions.preorder import number


def grown(rng, depth):
    if depth == 0 or rng.random() < 0.3:
        return es.Leaf(rng.randint(-64, 64) / 64)
    return es.Split(rng.randrange(3), round(rng.gauss(0, 1), 2), grown(rng, depth - 1), grown(rng, depth - 1),
                    rng.choice(["below", "otherwise"]))


SCHEMA = ("model_id string, tree_id int, tree_group int, "
          "nodes array<struct<feature: int, threshold: float, missing: string, value: float>>")


def test_the_tables_are_those_of_the_builder(spark):
    rng = random.Random(2)
    forests = {f"m{k}": [grown(rng, 6) for _ in range(rng.randint(1, 4))] for k in range(20)}
    inputs = [es.scalar("a"), es.vector("v", 2), ]
    rows = [(m, k, k % 2, es.preorder(t)) for m, f in forests.items() for k, t in enumerate(f)]
    built = es.forest_registry(spark.createDataFrame(rows, SCHEMA).repartition(3), inputs)
    want = es.ModelTables.from_rows(spark, es.merge_rows(*[
        es.model_rows(m, inputs, f, groups=[k % 2 for k in range(len(f))]) for m, f in forests.items()]))
    for name in ("header", "inputs", "trees", "nodes"):
        a, b = getattr(built, name), getattr(want, name)
        assert a.columns == b.columns
        assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))
    assert es.violations(built).isEmpty()


def test_a_deep_tree_is_numbered(spark):
    chain = es.Leaf(0.0)
    for k in range(300):
        chain = es.Split(0, float(k), chain, es.Leaf(float(k)))
    built = es.forest_registry(spark.createDataFrame([("m", 0, 0, es.preorder(chain))], SCHEMA), [es.scalar("a")])
    df = spark.createDataFrame([("m", float(k)) for k in (-1, 0, 150, 299, 400)], "m string, a double")
    assert {r.a: r.prediction for r in es.score_registry(df, built, "m").collect()} == {
        -1: 0.0, 0: 0.0, 150: 150.0, 299: 299.0, 400: 299.0}


@pytest.mark.parametrize("leaf", [[False, True], [True, True], [False, True, True, True], [False], []])
def test_entries_that_are_no_tree(leaf):
    with pytest.raises(ModelError):
        number(np.array(leaf, bool), np.array([len(leaf)]))


def test_faults_are_named(spark):
    def build(entries):
        return es.forest_registry(spark.createDataFrame([("m", 0, 0, entries)], SCHEMA), [es.scalar("a")]).nodes.collect()

    leaf = (None, None, None, 1.0)
    for entries, message in (([(0, 1.0, "below", None), leaf], "preorder"), ([(0, 1.0, "left", None), leaf, leaf], "missing must"),
                             ([(0, None, "below", None), leaf, leaf], "no threshold"), ([], "no nodes")):
        with pytest.raises(Exception, match=message):
            build(entries)
    assert es.forest_registry(spark.createDataFrame([], SCHEMA), [es.scalar("a")]).nodes.count() == 0
