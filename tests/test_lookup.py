"""Strings coded by a join: frequent values and nulls apart, and the same codes as ever."""

import math

import pytest

import ensemblescore as es
from ensemblescore.operators import lookup
from pyspark.sql import functions as F


@pytest.mark.parametrize("frequent", [1, 100])
def test_codes_do_not_depend_on_who_is_frequent(spark, monkeypatch, frequent):
    monkeypatch.setattr(lookup, "FREQUENT", frequent)
    rows = [(k, "hot" if k % 3 else None if k % 2 else f"v{k % 50}") for k in range(900)] + [(900, ""), (901, "gone")] * 20
    known = spark.createDataFrame([(f"v{k}", float(k)) for k in range(0, 50, 4)] + [("hot", 77.0), ("", 5.0)],
                                  "value string, code float")
    df = spark.createDataFrame(rows, "k int, s string").repartition(5).withColumn("code_hit", F.lit("kept"))
    out = lookup.coded(df, F.col("s"), known, "code")
    assert out.columns == [*df.columns, "code"]
    table = {r.value: r.code for r in known.collect()}
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        want = table.get(r.s)
        assert math.isnan(r.code) if want is None else r.code == want


def test_a_hot_value_is_not_one_task(spark):
    known = spark.range(100).select(F.concat(F.lit("v"), "id").alias("value"), F.col("id").cast("float").alias("code"))
    df = spark.range(0, 8000, 1, 8).select(F.when(F.col("id") % 2 == 0, "v1").otherwise(F.concat(F.lit("x"), "id")).alias("s"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = lookup.coded(df, F.col("s"), known, "code")
        assert out.where("code = 1").count() == 4000
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 1 and "BroadcastHashJoin" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_pairs_of_a_registry_are_not_mixed_up(spark):
    tables = es.ModelTables.from_rows(spark, es.merge_rows(
        es.model_rows("a", [es.category("s", ["bc", "c"])], [es.stump(0, 0.5, 1, 2)]),
        es.model_rows("ab", [es.category("s", ["c", "bc"])], [es.stump(0, 0.5, 10, 20)])))
    df = spark.createDataFrame([("a", "bc"), ("a", "c"), ("ab", "c"), ("ab", "bc"), ("a", None), (None, "c")], "m string, s string")
    got = {(r.m, r.s): r.prediction for r in es.score_registry(df, tables, "m").collect()}
    assert got == {("a", "bc"): 1, ("a", "c"): 2, ("ab", "c"): 10, ("ab", "bc"): 20, ("a", None): 2, (None, "c"): None}
