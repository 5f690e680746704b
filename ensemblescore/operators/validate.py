"""Integrity of model tables: one row per violation, for one model or a registry of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ensemblescore.errors import ModelError
from ensemblescore.operators.trees import tree_violations
from ensemblescore.sources import schema as S
from ensemblescore.sources.tables import ModelTables, beside


def _faults(rules: dict[str, Column]) -> Column:
    """The rules broken, tested in one pass; a null test counts as broken."""
    return F.array_compact(F.array(*[
        F.when(~F.coalesce(ok, F.lit(False)), F.lit(rule)) for rule, ok in rules.items()]))


def _broken(df: DataFrame, rules: dict[str, Column], tree_id=None, node_id=None) -> DataFrame:
    found = _faults(rules)
    return df.select(
        "model_id",
        (F.lit(None) if tree_id is None else F.col(tree_id)).cast("int").alias("tree_id"),
        (F.lit(None) if node_id is None else F.col(node_id)).cast("int").alias("node_id"),
        F.explode(found).alias("rule"))


def violations(tables: ModelTables) -> DataFrame:
    """``model_id, tree_id, node_id, rule`` for everything wrong with the tables."""
    header, inputs, trees, nodes = tables.header, tables.inputs, tables.trees, tables.nodes
    shape, size = F.col("shape"), F.size("shape")
    width = F.when(size == 1, 1).otherwise(F.get(shape, F.lit(1)))
    n = header.count() + inputs.count()
    limits = (
        header.groupBy("model_id").agg(
            F.count("*").alias("headers"), F.max("n_outputs").alias("n_outputs"))
        .join(beside(inputs.groupBy("model_id").agg(F.sum(width).alias("width")), n), "model_id", "full"))

    parts = [
        _broken(header, {
            "unknown_aggregation": F.col("aggregation").isin(*S.AGGREGATIONS),
            "unknown_post_transform": F.col("post_transform").isin(*S.POST_TRANSFORMS),
            "no_outputs": F.col("n_outputs") >= 1,
        }),
        _broken(limits, {
            "duplicate_model": F.coalesce("headers", F.lit(1)) == 1,
            "no_header": F.col("headers").isNotNull(),
            "no_inputs": F.col("width").isNotNull(),
        }),
        _broken(header.select("model_id").distinct().join(
            beside(trees.select("model_id", F.lit(True).alias("has")).distinct(), n), "model_id", "left"),
            {"no_trees": F.col("has")}),
        _broken(inputs, {
            "unknown_dtype": F.col("dtype").isin(*S.DTYPES),
            "bad_shape": (size == 1) | (F.get(shape, F.lit(1)) >= 1),
            "no_categories": (F.col("dtype") != S.STRING)
            | (F.col("categories").isNotNull() & (size == 1)),
            "null_category": F.col("categories").isNull()
            | ~F.exists("categories", lambda c: c.isNull()),
        }),
        _broken(inputs.groupBy("model_id", "ordinal").count(),
                {"duplicate_input": F.col("count") == 1}),
        _broken(trees.groupBy("model_id", "tree_id").count(),
                {"duplicate_tree": F.col("count") == 1}, "tree_id"),
        _broken(trees.join(beside(limits, n), "model_id", "left"), {
            "bad_tree_group": F.col("tree_group").between(0, F.col("n_outputs") - 1),
        }, "tree_id"),
        tree_violations(nodes, trees, limits, _node_faults(), n),
    ]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def refuse_broken(tables: ModelTables) -> None:
    """Raise for the first violation found, for models no executor could hold and check."""
    broken = violations(tables).head()
    if broken:
        raise ModelError(f"model {broken.model_id!r}: {broken.rule} at tree {broken.tree_id}, "
                         f"node {broken.node_id}")


def _node_faults() -> Column:
    """The rules that a node breaks by itself; what needs its model or its tree is found there."""
    branch, n_children = F.col("kind") == S.BRANCH, F.size("children")
    return _faults({
        "unknown_kind": F.col("kind").isin(*S.NODE_KINDS),
        "unknown_split_op": F.when(branch, F.col("split_op") == S.LESS_THAN)
        .otherwise(F.col("split_op").isin(*S.SPLIT_OPS)),
        "leaf_has_children": (F.col("kind") != S.LEAF) | (n_children == 0),
        "branch_without_two_children": ~branch | (n_children == 2),
        "nan_threshold": ~branch | ~F.isnan("split_threshold"),
        "null_threshold": ~branch | F.col("split_threshold").isNotNull(),
        "null_leaf": branch | F.col("leaf_value").isNotNull(),
        "negative_node": F.col("node_id") >= 0,
        "bad_default_child": ~branch | F.array_contains("children", F.col("default_child")),
    })
