"""A stream gives what a batch gives, once, across restarts."""

import pytest

import ensemblescore as es


@pytest.mark.parametrize("strategy", ["expr", "arrow"])
def test_stream_equals_batch_across_restarts(spark, store, tmp_path, strategy):
    path = store([es.scalar("a"), es.category("s", ["x", "y"])],
                 [es.stump(0, 5, 1, 2), es.stump(1, 0.5, 10, 20)])
    model = es.EnsembleModel.loadFile(path).setStrategy(strategy)
    source, out, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    schema = "k int, a double, s string"

    def arrive(first, last):
        spark.createDataFrame([(k, float(k % 10), "xyz"[k % 3]) for k in range(first, last)],
                              schema).write.mode("append").parquet(source)

    def run():
        stream = spark.readStream.schema(schema).parquet(source)
        es.score_stream(model, stream, out, log, columns=["k", "prediction"],
                        available_now=True).awaitTermination()

    arrive(0, 50)
    run()
    arrive(50, 80)
    run()
    run()
    batch = model.transform(spark.read.schema(schema).parquet(source)).select("k", "prediction")
    got = spark.read.parquet(out)
    assert got.count() == 80
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))


def test_a_batch_is_not_a_stream(spark, regression, features):
    with pytest.raises(ValueError, match="streaming"):
        es.score_stream(es.EnsembleModel.loadFile(regression), features([(0.1, 0.0)]), "o", "c")
    stream = spark.readStream.format("rate").load().selectExpr("array(0D, 0D) AS features")
    with pytest.raises(es.ModelError, match="a stream cannot do"):
        es.EnsembleModel.loadFile(regression).setStrategy("join").transform(stream)
