"""Forests of any size, scored by equi-joins with the node table.

The model never leaves its tables, so its size is bounded by nothing. Equal
feature rows get equal scores, so each distinct one walks the trees once and the
result is joined back: no row number is needed, and copies of a row cost nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ensemblescore.operators.depths import node_depths
from ensemblescore.operators.inputs import BoundInput, coded_by_join
from ensemblescore.sources import schema as S
from ensemblescore.sources.tables import ModelTables, beside

# A list of at most this many trees is sent to every executor.
MAX_BROADCAST_TREES = 100_000
# Up to so many trees, each has columns of its own where the trees of a point are gathered.
MAX_TREE_COLUMNS = 16

# A hash comes first: equal in equal points, it settles nearly all comparisons of a sort by itself.
POINT = ["h", "model_id", "x"]
NODE = ["model_id", "tree_id", "node_id"]


def walk(points: DataFrame, tables: ModelTables) -> DataFrame:
    """Leaves reached by each distinct ``points(h, model_id, x)`` in each tree of its model."""
    depth = node_depths(tables).agg(F.max("depth")).head()[0] or 0
    n_trees, n_nodes = tables.trees.count(), tables.nodes.count()
    splits = tables.nodes.where(F.col("kind") == S.BRANCH).select(
        *NODE, "split_feature", "split_threshold", "children", "default_child")
    roots = tables.trees.join(
        beside(splits.where("node_id = 0").drop("node_id"), n_trees), ["model_id", "tree_id"], "left")
    forest = roots.groupBy("model_id").agg(F.collect_list(F.struct(
        "tree_id", "tree_group", F.lit(0).alias("node_id"), "split_feature", "split_threshold",
        "children", "default_child")).alias("forest"))
    forest = F.broadcast(forest) if n_trees <= MAX_BROADCAST_TREES else beside(forest, n_trees)
    state = points.join(forest, "model_id").select(*POINT, F.inline("forest"))
    for level in range(depth):
        if level:
            state = state.join(beside(splits, n_nodes), NODE, "left")
        value = F.get("x", F.col("split_feature"))
        state = state.select(
            *POINT, "tree_id", "tree_group",
            F.when(F.col("split_feature").isNull(), F.col("node_id"))
            .when(F.isnan(value), F.col("default_child"))
            .when(value < F.col("split_threshold"), F.get("children", F.lit(0)))
            .otherwise(F.get("children", F.lit(1))).alias("node_id"))
    leaves = tables.nodes.where(F.col("kind") == S.LEAF).select(*NODE, "leaf_value")
    return state.join(beside(leaves, n_nodes), NODE).select(
        *POINT, "tree_id", "tree_group", F.col("leaf_value").cast("double").alias("value"))


def sums(points: DataFrame, tables: ModelTables, walked_by=walk) -> DataFrame:
    """``h, model_id, x, sums array<double>``: trees added in ascending order, as the other plans do."""
    last = tables.trees.agg(F.max("tree_id")).head()[0] or 0
    n_models, most = tables.header.agg(F.count("*"), F.max("n_outputs")).head()
    if last < MAX_TREE_COLUMNS and most == 1:
        # A tree that a model lacks adds 0.0, which changes no sum that began with 0.0.
        total = F.lit(0.0)
        for t in range(last + 1):
            total = total + F.coalesce(F.col(f"value{t}"), F.lit(0.0))
        own = [F.max(F.when(F.col("tree_id") == t, F.col("value"))).alias(f"value{t}") for t in range(last + 1)]
        return walked_by(points, tables).groupBy(*POINT).agg(*own).select(*POINT, F.array(total).alias("sums"))
    walked = _by_point(walked_by(points, tables), last)

    def output(k):
        mine = F.filter("trees", lambda t: t["tree_group"] == k)
        return F.aggregate(mine, F.lit(0.0), lambda total, t: total + t["value"])

    outputs = F.transform(F.sequence(F.lit(0), F.col("n_outputs") - 1), output)
    header = tables.header.select("model_id", "n_outputs")
    return walked.join(beside(header, n_models), "model_id").select(
        *POINT, outputs.alias("sums"))


def _by_point(walked: DataFrame, last: int) -> DataFrame:
    """``trees`` of each point in ascending order. Few trees have columns of their own, which a hash aggregate
    fills; a list is gathered by a sort."""
    if last >= MAX_TREE_COLUMNS:
        return walked.groupBy(*POINT).agg(
            F.array_sort(F.collect_list(F.struct("tree_id", "tree_group", "value"))).alias("trees"))
    own = [F.max(F.when(F.col("tree_id") == t, F.col(c))).alias(f"{c}{t}")
           for t in range(last + 1) for c in ("tree_group", "value")]
    trees = F.array(*[F.struct(F.lit(t).alias("tree_id"), F.col(f"tree_group{t}").alias("tree_group"),
                               F.col(f"value{t}").alias("value")) for t in range(last + 1)])
    return walked.groupBy(*POINT).agg(*own).select(
        *POINT, F.filter(trees, lambda t: t["tree_group"].isNotNull()).alias("trees"))


def features_of(df: DataFrame, bound: list[BoundInput], tables: ModelTables, name: str) -> tuple[str, DataFrame]:
    """The name of a column with all features as ``array<float>``, and ``df`` with it."""
    key, keyed, parts, codes = f"{name}_x", df, [], []
    for k, item in enumerate(bound):
        if item.has_long_vocabulary:
            codes.append(f"{name}_code{k}")
            keyed = coded_by_join(keyed, item, tables, codes[-1])
            parts.append(F.array(F.col(codes[-1])))
        else:
            parts.append(item.array)
    features = parts[0] if len(parts) == 1 else F.concat(*parts)
    return key, keyed.select("*", features.alias(key)).drop(*codes)


def add_sums(df: DataFrame, bound: list[BoundInput], tables: ModelTables, n_outputs: int,
             name: str, walked_by=walk) -> DataFrame:
    """Append ``name``: the sums as ``array<double>``, or a plain double for one output."""
    key, keyed = features_of(df, bound, tables, name)
    # Not a literal, which Catalyst would take out of the join and leave a product of all rows.
    model = F.when(F.size(F.col(key)) >= 0, F.lit(tables.header.head().model_id))
    own, h = f"{name}_model", f"{name}_h"
    keyed = keyed.select("*", F.xxhash64(key).alias(h), model.alias(own))
    points = keyed.select(F.col(h).alias("h"), F.col(own).alias("model_id"), F.col(key).alias("x")).distinct()
    scored = sums(points, tables, walked_by).select(
        F.col("h").alias(h), F.col("model_id").alias(own), F.col("x").alias(key), F.col("sums").alias(name))
    joined = keyed.join(scored, [h, own, key], "left").drop(h, own)
    result = F.get(name, F.lit(0)) if n_outputs == 1 else F.col(name)
    return joined.withColumn(name, result)
