"""The bounds that choose a plan change no answer."""

import itertools

import numpy as np
import pytest

import ensemblescore as es
from ensemblescore import EnsembleModel
from ensemblescore.sources import spec
from workload.models import forest

NAMES = ["a", "b", "c"]


def scores(model, df):
    return {tuple(r)[:-1]: r.prediction for r in model.transform(df).select(*df.columns, "prediction").collect()}


@pytest.mark.parametrize("vocabularies", [(NAMES,), ([f"v{k}" for k in range(200)],), (NAMES, [f"w{k}" for k in range(90)])])
def test_string_inputs_below_and_above_every_bound(spark, store, monkeypatch, vocabularies):
    inputs = [es.category(f"s{i}", v) for i, v in enumerate(vocabularies)]
    trees = [es.Split(i, 0.5, es.Leaf(10.0 ** i), es.stump(i, 1.5, 2 * 10.0 ** i, 3 * 10.0 ** i), missing="otherwise")
             for i in range(len(inputs))]
    path = store(inputs, trees)
    values = [[*v[:4], "unknown", "", None] for v in vocabularies]
    df = spark.createDataFrame(list(itertools.product(*values)), ", ".join(f"s{i} string" for i in range(len(inputs))))
    want = scores(EnsembleModel(modelPath=path), df)
    assert len(set(want.values())) >= 3
    for bound, nodes, strategy in ((64_000_000, 1, "auto"), (1, 4_000_000, "auto"), (1, 1, "auto"), (1, 1, "join"),
                                   (64_000_000, 1, "join"), (64_000_000, 1, "chunked"), (1, 4_000_000, "arrow"),
                                   (1, 4_000_000, "expr")):
        monkeypatch.setattr(spec, "MAX_BROADCAST_CHARS", bound)
        m = EnsembleModel(modelPath=path, maxBroadcastNodes=nodes, strategy=strategy)
        assert scores(m, df) == want, (bound, nodes, strategy)


def test_chunks_agree_bit_for_bit_and_move_nothing(spark, store, tmp_path):
    trees = forest(5, 40, 4)
    path = store([es.scalar(n) for n in "abcd"], trees, groups=[k % 3 for k in range(40)], post_transform="SOFTMAX")
    rng = np.random.default_rng(1)
    rows = [(float(a), float(b), float(c), None if i % 7 == 0 else float("nan") if i % 5 == 0 else float(d)) for i, (a, b, c, d) in enumerate(
        rng.uniform([1, 900, 0, 0], [50, 105_000, 0.1, 0.08], (500, 4)))]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(3)

    def bits(m):
        return sorted((r.a, r.probability.toArray().tobytes(), r.prediction) for r in m.transform(df).collect())

    want = bits(EnsembleModel(modelPath=path, strategy="arrow"))
    for nodes in (1, 100, 4_000_000):
        m = EnsembleModel(modelPath=path, maxBroadcastNodes=nodes, strategy="chunked")
        assert bits(m) == want
        plan = m.transform(df)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "Join" not in plan and "Cartesian" not in plan  # the repartition above
    df.write.parquet(str(tmp_path / "rows"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "rows"))
    es.score_stream(EnsembleModel(modelPath=path, maxBroadcastNodes=100), stream, str(tmp_path / "out"), str(tmp_path / "log"),
                    available_now=True).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.a for r in got.collect()) == sorted(a for a, *_ in rows)


def test_duplicate_names_pass_through(spark, store):
    path = store([es.scalar("x")], [es.stump(0, 0.5, 1, 2)])
    left = spark.createDataFrame([(1, 0.1)], "id int, x double")
    right = spark.createDataFrame([(1, "r")], "id int, note string")
    for strategy in ("expr", "arrow", "chunked", "join"):
        out = EnsembleModel(modelPath=path, strategy=strategy).transform(left.join(right, left["id"] == right["id"]))
        assert out.columns == ["id", "x", "id", "note", "prediction"] and tuple(out.first()) == (1, 0.1, 1, "r", 1.0)


@pytest.mark.parametrize("change, rule", [
    (lambda r: r.update(trees=[], nodes=[]), "no_trees"),
    (lambda r: r.update(inputs=[(*row[:-1], ["a", None]) for row in r["inputs"]]), "null_category")])
def test_loader_and_integrity_share_rules(spark, change, rule):
    rows = es.model_rows("m", [es.category("s", ["a", "b"])], [es.stump(0, 1, 2, 3)])
    change(rows)
    tables = es.ModelTables.from_rows(spark, rows)
    assert rule in [v.rule for v in es.violations(tables).collect()]
    for bound in (1, 4_000_000):
        if rule == "no_trees" and bound == 1:
            continue  # a model without nodes is never above a bound
        with pytest.raises(es.ModelError):
            spec.load_spec(tables, max_nodes=bound)


def test_parity_sees_a_difference_in_the_middle(spark):
    left = spark.createDataFrame([(1, v) for v in (1.0, 2.0, 3.0)], "k int, prediction double")
    right = spark.createDataFrame([(1, v) for v in (1.0, 2.9, 3.0)], "k int, prediction double")
    r = es.parity_report(left, right, ["k"], tolerance=0.0, count_outputs=True).first()
    assert (r.max_abs_diff, r.over_tolerance, r.differing_outputs) == (pytest.approx(0.9), 1, 2)
