import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import ensemblescore as es  # noqa: E402
from ensemblescore.sources.build import Leaf  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.default.parallelism", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    es.ship(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def store(spark, tmp_path_factory):
    """Write one model and return its directory."""
    def write(inputs, trees, model_id="m", **kwargs):
        path = str(tmp_path_factory.mktemp("model") / "tables")
        return es.write_models(spark, path, es.model_rows(model_id, inputs, trees, **kwargs))
    return write


@pytest.fixture(scope="session")
def regression(store):
    """x0 < 0.5 gives 2, anything else -2; x1 is not looked at."""
    return store([es.vector("X", 2, "FLOAT64")], [es.stump(0, 0.5, 2.0, -2.0)])


@pytest.fixture(scope="session")
def classifier(store):
    """Three classes: scores (2, 0, -1) for x0 < 0.5 and (-1, 0, 2) otherwise."""
    return store(
        [es.vector("X", 2)],
        [es.stump(0, 0.5, 2.0, -1.0), es.constant(0.0), es.stump(0, 0.5, -1.0, 2.0)],
        groups=[0, 1, 2], post_transform="SOFTMAX")


@pytest.fixture(scope="session")
def features(spark):
    def make(rows, partitions=2):
        df = spark.createDataFrame(rows, "f0 float, f1 float").repartition(partitions)
        return VectorAssembler(inputCols=["f0", "f1"], outputCol="features").transform(df)
    return make


def brute(node, x):
    """Follow one row down one tree, in float32."""
    while not isinstance(node, Leaf):
        value = np.float32(x[node.feature])
        if np.isnan(value):
            node = node.below if node.missing == "below" else node.otherwise
        else:
            node = node.below if value < np.float32(node.threshold) else node.otherwise
    return float(np.float32(node.value))
