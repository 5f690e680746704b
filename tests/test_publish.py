"""Versions of model tables appear at once, and a stream of rows follows them."""

import pytest

import ensemblescore as es


def tables(spark, below):
    return es.ModelTables.from_rows(spark, es.merge_rows(
        *[es.model_rows(m, [es.scalar("a")], [es.stump(0, 0.5, below + k, -1)]) for k, m in enumerate("pq")]))


def scores(df, found):
    return sorted(map(tuple, es.score_registry(df, found, "m").select("m", "prediction").collect()))


def test_a_reader_sees_one_version(spark, tmp_path):
    root = str(tmp_path / "models")
    with pytest.raises(es.ModelError, match="nothing has been published"):
        es.published_models(spark, root)
    df = spark.createDataFrame([("p", 0.0), ("q", 0.0)], "m string, a double")
    assert es.publish_models(tables(spark, 10), root) == 1
    open_ = es.published_models(spark, root)
    # A version that is half written has folders but no row in the manifest.
    tables(spark, 99).header.write.parquet(f"{root}/versions/half/header")
    assert scores(df, es.published_models(spark, root)) == [("p", 10.0), ("q", 11.0)]
    assert es.publish_models(tables(spark, 20), root) == 2
    assert scores(df, open_) == scores(df, es.published_models(spark, root, 1)) == [("p", 10.0), ("q", 11.0)]
    assert scores(df, es.published_models(spark, root)) == [("p", 20.0), ("q", 21.0)]
    assert sorted(r.version for r in es.published_versions(spark, root).collect()) == [1, 2]
    with pytest.raises(es.ModelError, match="no version 7"):
        es.published_models(spark, root, 7)


def test_a_stream_takes_the_newest_version_per_batch(spark, tmp_path):
    root, source, out, log = (str(tmp_path / n) for n in ("models", "in", "out", "log"))
    schema = "k int, m string, a double"

    def arrive(first, last):
        spark.createDataFrame([(k, "pqx"[k % 3], 0.0) for k in range(first, last)], schema).write.mode(
            "append").parquet(source)

    def run(**options):
        stream = spark.readStream.schema(schema).parquet(source)
        es.score_registry_stream(stream, root, out, log, model_id_col="m", columns=["k", "prediction"],
                                 available_now=True, **options).awaitTermination()

    es.publish_models(tables(spark, 10), root)
    arrive(0, 6)
    run()
    es.publish_models(tables(spark, 20), root)
    arrive(6, 12)
    run(strategy="group")
    run()
    got = {r.k: r.prediction for r in spark.read.parquet(out).collect()}
    assert got == {k: [10 + 10 * (k >= 6), 11 + 10 * (k >= 6), None][k % 3] for k in range(12)}
    with pytest.raises(ValueError, match="streaming"):
        es.score_registry_stream(spark.createDataFrame([], schema), root, out, log)
