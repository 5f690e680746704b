"""What reaches the scan, and that scoring shuffles nothing."""

import pytest
from pyspark.sql import functions as F

import ensemblescore as es
from ensemblescore.plans.spread import spread_small

LINEITEM = "/root/testdata/sf0.001/lineitem.parquet"


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def model(store):
    return es.EnsembleModel.loadFile(store(
        [es.scalar("l_discount"), es.scalar("l_tax")],
        [es.stump(0, 0.05, 2, -2), es.stump(1, 0.02, 1, -1)]))


@pytest.mark.parametrize("strategy", ["expr", "arrow"])
def test_filter_and_columns_reach_the_scan(spark, model, strategy):
    scored = model.copy({model.strategy: strategy}).transform(spark.read.parquet(LINEITEM))
    plan = physical(scored.where("l_quantity > 10").select("l_orderkey", "prediction"))
    assert "GreaterThan(l_quantity,10.0)" in plan
    schema = plan.split("ReadSchema: ")[1]
    assert schema.startswith(
        "struct<l_orderkey:bigint,l_quantity:double,l_discount:double,l_tax:double>")
    assert "Exchange" not in plan


@pytest.mark.parametrize("strategy", ["expr", "arrow"])
def test_unused_scores_cost_nothing(spark, model, strategy):
    scored = model.copy({model.strategy: strategy}).transform(spark.read.parquet(LINEITEM))
    plan = physical(scored.select("l_orderkey"))
    assert "ArrowEvalPython" not in plan and "CASE" not in plan
    assert "ReadSchema: struct<l_orderkey:bigint>" in plan


def test_small_models_stay_in_codegen(spark, model):
    plan = physical(model.transform(spark.read.parquet(LINEITEM)).select("prediction"))
    assert "ArrowEvalPython" not in plan and "*(1) Project" in plan


def test_classifier_runs_python_once(spark, store):
    path = store([es.scalar("l_discount")], [es.constant(k) for k in range(3)], groups=[0, 1, 2],
                 post_transform="SOFTMAX")
    out = es.EnsembleModel.loadFile(path).setStrategy("arrow").transform(
        spark.read.parquet(LINEITEM)).select("probability", "prediction")
    assert physical(out).count("ArrowEvalPython") == 1


def test_broadcast_registry_does_not_shuffle_rows(spark, model):
    df = spark.read.parquet(LINEITEM).withColumn("model", F.lit("m"))
    tables = es.ModelTables.read(spark, model.getModelPath())
    assert "Exchange" not in physical(es.score_registry(df, tables, "model"))


def test_spread_touches_small_inputs_only(spark):
    df = spark.read.parquet(LINEITEM)
    assert "Exchange" in physical(spread_small(df))
    assert "Exchange" not in physical(spread_small(df, max_bytes=1000))


def test_unread_scalars_are_not_scanned(spark, store):
    path = store([es.scalar("l_discount"), es.scalar("l_tax"), es.scalar("l_quantity")],
                 [es.stump(2, 10, 1, 2)] * 60)
    m = es.EnsembleModel.loadFile(path).setStrategy("arrow")
    out = m.transform(spark.read.parquet(LINEITEM)).select("l_orderkey", "prediction")
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in physical(out)
    low = spark.read.parquet(LINEITEM).where("l_quantity < 10").count()
    assert out.where("prediction = 60").count() == low


def test_model_is_broadcast_once(spark, model):
    m, df = model.copy({model.strategy: "arrow"}), spark.read.parquet(LINEITEM)
    m.transform(df)
    first = m._prepared[2]
    m.transform(df)
    assert m._prepared[2] is first
