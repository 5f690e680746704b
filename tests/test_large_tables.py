"""What large tables need: no join gathers them, no task holds them, no worker keeps them."""

import pytest
from pyspark.sql import functions as F

import ensemblescore as es
from ensemblescore import ModelTables, score_registry
from ensemblescore.sources import tables as T


def stumps(spark, n):
    return es.stump_registry(spark.range(n).coalesce(1).selectExpr(
        "id AS model_id", "id / 2 AS threshold", "1.0 AS below", "2.0 AS otherwise"), "a")


@pytest.fixture
def stored(spark, tmp_path):
    return ModelTables.read(spark, stumps(spark, 50).write(str(tmp_path / "stumps")))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_many_models_are_not_gathered_by_joins(spark, stored, monkeypatch):
    """Tables that take few bytes on disk are merged, not broadcast, if they have many rows."""
    df = spark.range(50).selectExpr("cast(id AS string) AS m", "cast(id % 7 AS double) AS a")
    want = sorted(map(tuple, score_registry(df, stored, "m", strategy="join").collect()))
    widths = sorted(map(tuple, es.model_widths(stored).collect()))
    monkeypatch.setattr(T, "MAX_BROADCAST_ROWS", 10)
    assert "BroadcastHashJoin" not in plan(es.model_widths(stored))
    assert "BroadcastHashJoin" not in plan(es.violations(stored))
    assert es.violations(stored).count() == 0
    assert sorted(map(tuple, es.model_widths(stored).collect())) == widths
    for strategy in ("join", "group", "arrow"):
        assert sorted(map(tuple, score_registry(df, stored, "m", strategy=strategy).collect())) == want


def test_a_registry_derived_from_one_task_is_written_by_many(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = stumps(spark, 1000).write(str(tmp_path / "dealt"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for name in T.TABLES:
        assert len(spark.read.parquet(f"{path}/{name}").inputFiles()) > 1, name
    assert ModelTables.read(spark, path).nodes.count() == 3000


def test_a_registry_kept_by_all_workers_is_small():
    """Each Python worker of an executor keeps the models of every scoring in its stage."""
    from ensemblescore.operators import registry
    assert registry.MAX_BROADCAST_NODES <= 1_000_000


def test_few_and_many_trees_of_a_point_are_added_alike(spark, store, monkeypatch):
    """Equal points are found by their hash first; trees come from columns, or from a sorted list if they are many."""
    from ensemblescore.plans import boxes, relational
    assert relational.POINT[0] == "h"
    trees = [es.Split(k % 2, k / 7, es.Leaf(0.1 * k), es.stump(1, k / 5, 0.3, -1e16 if k == 2 else 0.7), "below") for k in range(9)]
    df = spark.range(300).selectExpr("cast(if(id % 11 = 0, 'nan', id % 13 / 10) AS double) AS a", "id % 17 / -9 AS b", "id")
    for groups in ([0] * 9, [k % 3 for k in range(9)]):
        path = store([es.scalar("a"), es.scalar("b")], trees, groups=groups)
        for strategy, cells, columns in (("join", 0, 16), ("join", 0, 3), ("boxes", 50_000, 16), ("boxes", 0, 3)):
            monkeypatch.setattr(relational, "MAX_TREE_COLUMNS", columns)
            monkeypatch.setattr(boxes, "MAX_BROADCAST_CELLS", cells)
            got, want = (sorted((r.id, r.prediction) for r in es.EnsembleModel(modelPath=path, strategy=s).transform(df).collect())
                         for s in (strategy, "arrow"))
            assert got == want, (groups, strategy, cells, columns)


def test_short_segments_are_settled_as_the_walk_in_order_settles_them():
    """Batches of one row have no inner segments, so they take every row through the walk."""
    import random

    import pyarrow as pa

    from ensemblescore.operators.parity import _paired_in_order
    rng, rows = random.Random(3), []
    for segment in range(400):
        value = rng.random()
        for _ in range(rng.choice([1, 1, 2, 2, 2, 3, 5])):
            n = rng.choice([1, 1, 4])
            rows.append((segment, value, *((n, 0) if rng.random() < 0.5 else (0, n))))
            value += rng.random() * 1e-3
    table = pa.table(list(zip(*rows)), names=["segment", "value", "more_a", "more_b"])

    def found(size):
        (out,) = _paired_in_order(1e-3)(iter(table.to_batches(max_chunksize=size)))
        return out.to_pylist()

    assert found(1) == found(7) == found(len(rows)) == found(100)


def test_a_registry_above_the_bound_is_broadcast_in_deals(spark, tmp_path, monkeypatch):
    """Tables reach the driver compressed and whole, and the query asks for no more than the bound at once."""
    from ensemblescore.operators import registry
    from ensemblescore.sources.spec import packed
    from workload import queries
    spark.range(60).selectExpr("id AS p_partkey", "cast(1 + id % 50 AS int) AS p_size", "950.0 + id * 2 AS p_retailprice").write.parquet(
        str(tmp_path / "part.parquet"))
    table = spark.range(100).repartition(3).selectExpr("id", "if(id % 3 = 0, null, cast(id AS string)) AS s")
    assert sorted(packed(table).to_pylist(), key=lambda r: r["id"]) == [
        {"id": k, "s": None if k % 3 == 0 else str(k)} for k in range(100)]
    assert packed(table.where("id < 0")).num_rows == 0
    want = sorted(map(tuple, queries.QUERIES["registry_mixed_widths_group"](spark, str(tmp_path)).collect()))
    monkeypatch.setattr(registry, "MAX_BROADCAST_NODES", 120)
    monkeypatch.setattr(queries, "MAX_BROADCAST_NODES", 120)
    monkeypatch.setattr(registry.grouped, "NODES_PER_GROUP", 20)
    assert sorted(map(tuple, queries.QUERIES["registry_mixed_widths_arrow"](spark, str(tmp_path)).collect())) == want


def test_groups_hold_few_nodes():
    from ensemblescore.plans import grouped
    assert grouped.NODES_PER_GROUP <= 200_000
