"""Trees split over tasks: exact sums in any order. Leaf boxes: the leaves of the other plans."""

import math
import random

import numpy as np
import pytest
from conftest import brute

import ensemblescore as es
from ensemblescore.plans import trees


def test_limbs_hold_every_float():
    rng = np.random.default_rng(1)
    bits = np.concatenate([rng.integers(0, 1 << 32, 5000, dtype=np.uint64).astype(np.uint32), np.arange(50, dtype=np.uint32),
                           np.array([0x00800000, 0x7F7FFFFF, 0xFF7FFFFF, 0x80000000, 0x007FFFFF], np.uint32)])
    values = bits.view(np.float32)
    values = values[np.isfinite(values)]
    limbs = trees.exact_limbs(values)
    assert (np.abs(limbs) < 1 << 32).all()
    assert [trees.rounded(column.tolist()) for column in limbs.T] == values.astype(np.float64).tolist()


def test_sums_are_exact_in_any_order():
    rng = random.Random(3)
    for _ in range(20):
        values = np.array([rng.choice([1, -1]) * rng.random() * 10.0 ** rng.randint(-40, 37) for _ in range(500)], np.float32)
        limbs = sum(trees.exact_limbs(values[k::7]).sum(axis=1) for k in rng.sample(range(7), 7))
        assert trees.rounded(limbs.tolist()) == math.fsum(values.astype(np.float64).tolist())


def forest(rng, n):
    def grow(depth):
        if depth == 0 or rng.random() < 0.2:
            return es.Leaf(rng.gauss(0, 1) * 10.0 ** rng.randint(-6, 6))
        return es.Split(rng.randrange(3), rng.choice([-0.5, 0.0, 0.25, rng.gauss(0, 1)]), grow(depth - 1), grow(depth - 1),
                        rng.choice(["below", "otherwise"]))
    return [grow(4) for _ in range(n)]


@pytest.fixture(scope="module")
def case(spark, store):
    rng = random.Random(8)
    grown = forest(rng, 40)
    nan = float("nan")
    rows = [(k, *(rng.choice([nan, -0.5, 0.0, 0.25, rng.gauss(0, 1)]) for _ in range(3))) for k in range(200)] * 2
    df = spark.createDataFrame(rows, "k int, a float, b float, c float")
    inputs = [es.scalar(n) for n in "abc"]
    return grown, rows, df, store(inputs, grown), store(inputs, grown, groups=[k % 3 for k in range(40)], post_transform="SOFTMAX")


def test_trees_in_parts_give_the_exact_sum(spark, case, monkeypatch):
    grown, rows, df, path, classes = case
    monkeypatch.setattr(trees, "NODES_AT_ONCE", 20)
    want = {r[0]: float(np.float32(math.fsum(brute(t, r[1:]) for t in grown))) for r in rows}
    out = es.EnsembleModel.loadFile(path).setStrategy("trees").transform(df)
    assert out.columns == [*df.columns, "prediction"]
    got = out.collect()
    assert len(got) == len(rows) and {r.k: r.prediction for r in got} == want
    several = es.EnsembleModel.loadFile(classes).setStrategy("trees").transform(df).select("k", "prediction", "probability")
    usual = es.EnsembleModel.loadFile(classes).setStrategy("arrow").transform(df).select("k", "prediction", "probability")
    for a, b in zip(sorted(several.collect()), sorted(usual.collect())):
        assert a[:2] == b[:2] and np.allclose(a[2].toArray(), b[2].toArray(), atol=1e-6)
    monkeypatch.setattr(trees, "MAX_VALUES", 10)
    with pytest.raises(es.ModelError, match="too many to send"):
        es.EnsembleModel.loadFile(path).setStrategy("trees").transform(df)


def test_boxes_find_the_leaves_of_the_walk(spark, case):
    _, _, df, path, classes = case
    for p in (path, classes):
        boxed, walked = (es.EnsembleModel.loadFile(p).setStrategy(s).transform(df).select("k", "prediction")
                         for s in ("boxes", "arrow"))
        assert sorted(map(tuple, boxed.collect())) == sorted(map(tuple, walked.collect()))
        plan = es.EnsembleModel.loadFile(p).setStrategy("boxes").transform(df)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
