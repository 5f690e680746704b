"""How far every node lies below its root, for a registry of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ensemblescore.sources import schema as S
from ensemblescore.sources.scratch import ensure_checkpoint_dir
from ensemblescore.sources.tables import ModelTables, beside

NODE = ["model_id", "tree_id", "node_id"]


def edges(nodes: DataFrame) -> DataFrame:
    """One row per parent-child pair: the child's key and its ``parent``."""
    return nodes.where(F.col("kind") == S.BRANCH).select(
        "model_id", "tree_id", F.col("node_id").alias("parent"),
        F.explode("children").alias("node_id"))


def node_depths(tables: ModelTables) -> DataFrame:
    """``model_id, tree_id, node_id, depth``; depth is null for a node no root leads to.

    Each round doubles the distance a node has looked up, so a tree of depth ``d``
    takes ``log2(d)`` joins. Nodes that have met their root drop out of the join.
    """
    nodes, n = tables.nodes, tables.nodes.count()
    ensure_checkpoint_dir(nodes.sparkSession)
    parents = edges(nodes).groupBy(*NODE).agg(F.min("parent").alias("up"))
    state = (
        nodes.select(*NODE).distinct().join(beside(parents, n), NODE, "left")
        .select(*NODE,
                F.when(F.col("node_id") == 0, 0).otherwise(F.col("up")).alias("up"),
                F.when(F.col("node_id") == 0, 0).when(F.col("up").isNotNull(), 1)
                .alias("depth"))
        .checkpoint())
    largest = state.groupBy("model_id", "tree_id").count().agg(F.max("count")).head()[0] or 0
    looked = 1
    while looked < largest:
        open_ = state.where("up != 0")
        if open_.isEmpty():
            break
        above = state.select(
            "model_id", "tree_id", F.col("node_id").alias("up"),
            F.col("up").alias("next_up"), F.col("depth").alias("more"))
        moved = open_.join(beside(above, n), ["model_id", "tree_id", "up"], "left").select(
            *NODE, F.col("next_up").alias("up"), (F.col("depth") + F.col("more")).alias("depth"))
        state = state.where("up = 0 OR up IS NULL").unionByName(moved).checkpoint()
        looked *= 2
    return state.select(*NODE, F.when(F.col("up") == 0, F.col("depth")).alias("depth"))
