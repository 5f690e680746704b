"""Eager and deferred opening, registries on disk, saving a stage."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark import SparkContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Binarizer, VectorAssembler

import ensemblescore as es
from ensemblescore import EnsembleModel, ModelError


def test_load_file_builds_a_usable_stage(regression, features):
    m = EnsembleModel.loadFile(regression)
    assert m.getModelPath() == regression and m.copy().getModelPath() == regression
    assert m.getFeaturesCol() == EnsembleModel().setModelPath(regression).getFeaturesCol()
    assert m.transform(features([(0.1, 0.0)])).head().prediction == 2.0


def test_missing_model_fails_at_once_or_when_used(tmp_path, features):
    missing = str(tmp_path / "nothing")
    with pytest.raises(ModelError):
        EnsembleModel.loadFile(missing)
    deferred = EnsembleModel(modelPath=missing)
    assert deferred.getModelPath() == missing
    with pytest.raises(ModelError):
        deferred.transform(features([(0.1, 0.0)]))


def test_unreadable_model_fails_at_once(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "m" / "header"))
    with pytest.raises(ModelError):
        EnsembleModel.loadFile(str(tmp_path / "m"))


def test_load_file_needs_a_session(monkeypatch, regression):
    monkeypatch.setattr(SparkContext, "_active_spark_context", None)
    with pytest.raises(RuntimeError, match="modelPath="):
        EnsembleModel.loadFile(regression)
    assert EnsembleModel(modelPath=regression).getModelPath() == regression


def test_load_file_in_worker_threads(spark, regression):
    with ThreadPoolExecutor(2) as pool:
        loaded = list(pool.map(EnsembleModel.loadFile, [regression, regression]))
    assert [m.outputColsPerRow for m in loaded] == [1, 1]


def test_no_path_at_all(features):
    with pytest.raises(ValueError, match="modelPath"):
        EnsembleModel().transform(features([(0.1, 0.0)]))


def test_one_of_several_models(spark, tmp_path):
    path = es.write_models(
        spark, str(tmp_path / "m"),
        es.model_rows("one", [es.scalar("a")], [es.constant(1)]),
        es.model_rows("two", [es.scalar("a")], [es.constant(2)]))
    df = spark.createDataFrame([(0.0,)], "a double")
    with pytest.raises(ModelError, match="several models"):
        EnsembleModel.loadFile(path)
    with pytest.raises(ModelError, match="no model 'three'"):
        EnsembleModel.loadFile(path, "three")
    m = EnsembleModel.loadFile(path, "one")
    assert m.transform(df).head().prediction == 1.0
    assert m.setModelId("two").transform(df).head().prediction == 2.0


def test_tables_round_trip(spark, tmp_path):
    rows = es.model_rows("m", [es.vector("X", 2), es.category("s", ["a"])],
                         [es.stump(0, 0.5, 2, -2, missing="below"), es.constant(1)],
                         groups=[0, 1])
    tables = es.ModelTables.from_rows(spark, rows)
    back = es.ModelTables.read(spark, tables.write(str(tmp_path / "m")))
    for name in ("header", "inputs", "trees", "nodes"):
        got = [tuple(r) for r in getattr(back, name).collect()]
        assert sorted(map(str, got)) == sorted(str(tuple(r)) for r in rows[name])
    with pytest.raises(Exception, match="exists"):
        tables.write(str(tmp_path / "m"))


def test_builder_refuses_nonsense():
    with pytest.raises(ModelError):
        es.model_rows("m", [es.scalar("a")], [es.constant(1)], groups=[0, 1])
    with pytest.raises(ModelError):
        es.model_rows("m", [es.scalar("a")], [es.stump(0, 1, 2, 3, missing="left")])


def test_registry_from_a_dataframe(spark, tmp_path):
    params = spark.createDataFrame([("u", 1.0, 10.0, 20.0), ("v", 2.0, 30.0, 40.0)],
                                   "model_id string, threshold double, below double, otherwise double")
    path = es.stump_registry(params, "a").write(str(tmp_path / "m"))
    df = spark.createDataFrame([(1.5,)], "a double")
    assert EnsembleModel.loadFile(path, "u").transform(df).head().prediction == 20.0
    assert EnsembleModel.loadFile(path, "v").transform(df).head().prediction == 30.0
    assert es.violations(es.ModelTables.read(spark, path)).count() == 0


def test_in_a_pipeline_saved_and_loaded(spark, store, tmp_path):
    path = store([es.vector("X", 2)], [es.stump(0, 0.5, 2.0, -2.0)])
    df = spark.createDataFrame([(0.1, 0.0), (0.9, 0.0)], "f0 double, f1 double")
    fitted = Pipeline(stages=[
        VectorAssembler(inputCols=["f0", "f1"], outputCol="features"),
        EnsembleModel.loadFile(path).setPredictionCol("score"),
        Binarizer(inputCol="score", outputCol="positive", threshold=0.0)]).fit(df)
    want = [(0.1, 2.0, 1.0), (0.9, -2.0, 0.0)]
    assert sorted((r.f0, r.score, r.positive) for r in fitted.transform(df).collect()) == want
    fitted.write().save(str(tmp_path / "p"))
    again = PipelineModel.load(str(tmp_path / "p"))
    assert sorted((r.f0, r.score, r.positive) for r in again.transform(df).collect()) == want
    EnsembleModel.loadFile(path).save(str(tmp_path / "s"))
    assert EnsembleModel.load(str(tmp_path / "s")).getModelPath() == path


def test_scratch_lies_in_the_shared_folder(spark):
    from ensemblescore.sources.scratch import scratch_path
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(shared)
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_a_model_longer_than_a_glance(spark, store, monkeypatch):
    from ensemblescore.sources import spec
    path = store([es.scalar("a")], [es.stump(0, k, 1, 2) for k in range(10)])
    df = spark.createDataFrame([(4.5,)], "a double")
    for glance in (5, 15, 30, 31):
        monkeypatch.setattr(spec, "GLANCE", glance)
        m = EnsembleModel.loadFile(path)
        assert m.spec().n_nodes == 30 and m.transform(df).head().prediction == 15.0
