"""The parity report counts what it should and never pairs copies."""

import math
import random
from collections import Counter

import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql.types import IntegerType, StructField, StructType

import ensemblescore as es


def report(spark, left, right, **kwargs):
    a = spark.createDataFrame(left, "k int, prediction double")
    b = spark.createDataFrame(right, "k int, prediction double")
    return es.parity_report(a, b, ["k"], **kwargs).head().asDict()


def test_counts(spark):
    r = report(spark, [(1, 1.0), (2, 2.0), (3, 3.0), (4, float("nan")), (5, float("nan")), (9, 1.0)],
               [(1, 1.0), (2, 2.5), (3, 3.000001), (4, float("nan")), (5, 1.0), (8, 1.0)])
    assert r == dict(rows_left=6, rows_right=6, keys_met=5, only_left=1, only_right=1,
                     repeated_keys=0, uneven_keys=0, max_abs_diff=float("inf"), over_tolerance=2,
                     argmax_disagreements=0)


def test_copies_are_counted_not_paired(spark):
    r = report(spark, [(1, 1.0)] * 500 + [(2, 1.0)], [(1, 1.0)] * 400 + [(1, 3.0), (2, 1.0)])
    assert (r["keys_met"], r["repeated_keys"], r["uneven_keys"]) == (2, 1, 1)
    assert r["max_abs_diff"] == 2.0 and r["over_tolerance"] == 1


def test_missing_outputs_are_rows_too(spark):
    r = report(spark, [(1, None), (2, None), (3, 1.0)], [(1, None), (2, 1.0), (3, 1.0)])
    assert (r["rows_left"], r["rows_right"], r["keys_met"], r["over_tolerance"]) == (3, 3, 3, 1)
    r = report(spark, [(1, None), (1, 2.0)], [(1, 2.0), (1, 2.0)])
    assert r["over_tolerance"] == 1


def test_noise_does_not_hide_a_changed_value(spark):
    noisy = [(k, v + 1e-6) for k in (None, 1, 2) for v in (1.0, 2.9 if k == 1 else 2.0, 3.0)]
    r = report(spark, [(k, v) for k in (None, 1, 2) for v in (1.0, 2.0, 3.0)], noisy)
    assert r["max_abs_diff"] == pytest.approx(0.900001) and r["over_tolerance"] == 1
    # Values held by many rows, in unlike numbers on the two sides.
    r = report(spark, [(1, 1.0)] * 300 + [(1, 5.0)] * 100, [(1, 1.5)] * 100 + [(1, 4.0)] * 300)
    assert (r["max_abs_diff"], r["over_tolerance"]) == (3.0, 1)


def test_noise_does_not_hide_a_changed_vector(spark):
    def scored(rows):
        return spark.createDataFrame([(1, Vectors.dense(v)) for v in rows], StructType([
            StructField("k", IntegerType()), StructField("prediction", VectorUDT())]))

    a = scored([(0.1, 0.9), (0.6, 0.4), (0.8, 0.2)])
    b = scored([(0.1 + 1e-7, 0.9), (0.3, 0.7), (0.8 + 1e-7, 0.2)])
    r = es.parity_report(a, b, ["k"]).head()
    assert (r.max_abs_diff, r.over_tolerance, r.argmax_disagreements) == (pytest.approx(0.3), 1, 1)


@pytest.mark.parametrize("seed", range(3))
def test_uneven_keys_are_aligned_as_far_as_can_be(spark, seed):
    """Against the largest matching of each key, and keys cut into segments and over range partitions."""
    rng = random.Random(seed)

    def draw():
        return [(rng.choice([1, 1, 1, 2, 3, None]), rng.choice([None, float("nan"), float("inf")]) if rng.random() < 0.05
                 else round(rng.uniform(0, 12), 1)) for _ in range(rng.choice([0, 40, 150]))]

    left, right = draw() + [(1, 0.0), (2, 1.0)], draw() + [(1, 0.0), (2, 1.05), (3, 1.0)]

    def best(a, b):
        """(pairs, largest difference of each pair in order) by dynamic programming over sorted lists."""
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = max(table[i][j + 1], table[i + 1][j], table[i][j] + (abs(x - y) <= 0.15))
        return table[-1][-1]

    unmatched = 0
    for k in {k for k, _ in left} & {k for k, _ in right}:
        a, b = (Counter(repr(v) for x, v in rows if x == k) for rows in (left, right))
        if sum(a.values()) == sum(b.values()):
            continue
        only = [sorted(float(v) for v in (x - y).elements() if v != "None") for x, y in ((a, b), (b, a))]
        finite = [[v for v in o if math.isfinite(v)] for o in only]
        unmatched += sum(map(len, only)) - 2 * best(*finite)
    sides = [spark.createDataFrame(rows, "k int, prediction double") for rows in (left, right)]
    r = es.parity_report(*sides, ["k"], tolerance=0.15, align_uneven=True).head()
    assert r.unmatched_outputs == unmatched and (r.max_aligned_diff or 0.0) <= 0.15
    with pytest.raises(es.InputError, match="no order"):
        vectors = spark.createDataFrame([(1, Vectors.dense([0.0]))], StructType([
            StructField("k", IntegerType()), StructField("prediction", VectorUDT())]))
        es.parity_report(vectors, vectors, ["k"], align_uneven=True)


def test_empty_sides(spark):
    r = report(spark, [], [(1, 1.0)])
    assert (r["rows_left"], r["rows_right"], r["only_right"], r["max_abs_diff"]) == (0, 1, 1, None)
    assert report(spark, [], [])["keys_met"] == 0


def test_vectors_and_argmax(spark, store, features):
    a = store([es.vector("X", 2)], [es.stump(0, 0.5, 2, 0), es.stump(0, 0.5, 0, 2)], groups=[0, 1])
    b = store([es.vector("X", 2)], [es.stump(0, 0.7, 2, 0), es.stump(0, 0.7, 0, 2)], groups=[0, 1])
    df = features([(v / 10, 0.0) for v in range(10)])
    r = es.parity_report(es.EnsembleModel.loadFile(a).transform(df),
                         es.EnsembleModel.loadFile(b).transform(df), ["f0"],
                         output="probability").head()
    assert (r.keys_met, r.max_abs_diff, r.over_tolerance, r.argmax_disagreements) == (10, 2.0, 2, 2)


def test_missing_columns(spark):
    df = spark.createDataFrame([(1, 1.0)], "k int, prediction double")
    with pytest.raises(es.InputError, match="right"):
        es.parity_report(df, df.drop("prediction"), ["k"])
