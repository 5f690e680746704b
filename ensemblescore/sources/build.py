"""Build models: by hand from nested splits, or many at once from a DataFrame."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ensemblescore.errors import ModelError
from ensemblescore.functions.preorder import number
from ensemblescore.sources import schema as S
from ensemblescore.sources.tables import ModelTables


@dataclass(frozen=True)
class Leaf:
    value: float


@dataclass(frozen=True)
class Split:
    """``x[feature] < threshold`` goes to ``below``, anything else to ``otherwise``.

    ``missing`` names the side a NaN takes.
    """

    feature: int
    threshold: float
    below: Leaf | Split
    otherwise: Leaf | Split
    missing: str = "otherwise"


@dataclass(frozen=True)
class Input:
    """One declared model input; a ``width`` makes it a vector, ``categories`` a string."""

    name: str
    dtype: str = S.FLOAT32
    width: int | None = None
    categories: tuple[str, ...] | None = None

    @property
    def shape(self) -> list[int]:
        return [-1] if self.width is None else [-1, self.width]


def stump(feature: int, threshold: float, below: float, otherwise: float,
          missing: str = "otherwise") -> Split:
    return Split(feature, threshold, Leaf(below), Leaf(otherwise), missing)


def constant(value: float) -> Leaf:
    return Leaf(value)


def vector(name: str, width: int, dtype: str = S.FLOAT32) -> Input:
    return Input(name, dtype, width)


def scalar(name: str, dtype: str = S.FLOAT32) -> Input:
    return Input(name, dtype)


def category(name: str, values) -> Input:
    return Input(name, S.STRING, None, tuple(values))


def _number(model_id: str, tree_id: int, root) -> list[tuple]:
    """Node rows of one tree, numbered as they are met, the root being node 0."""
    rows, queue, next_id = [], [(0, root)], 1
    for node_id, node in queue:  # grows while it is walked
        if isinstance(node, Leaf):
            rows.append((model_id, tree_id, node_id, S.LEAF, 0, S.SPLIT_OP_UNSPECIFIED,
                         0.0, [], 0, float(node.value)))
            continue
        if node.missing not in ("below", "otherwise"):
            raise ModelError(f"missing must be 'below' or 'otherwise', not {node.missing!r}")
        below, otherwise, next_id = next_id, next_id + 1, next_id + 2
        queue += [(below, node.below), (otherwise, node.otherwise)]
        rows.append((model_id, tree_id, node_id, S.BRANCH, node.feature, S.LESS_THAN,
                     float(node.threshold), [below, otherwise],
                     below if node.missing == "below" else otherwise, 0.0))
    return rows


def model_rows(model_id: str, inputs: list[Input], trees: list, *, groups: list[int] | None = None,
               post_transform: str = S.IDENTITY, output_names: list[str] | None = None) -> dict:
    """Rows of the four tables for one ensemble; ``groups[k]`` is the output tree ``k`` adds to."""
    groups = [0] * len(trees) if groups is None else list(groups)
    if len(groups) != len(trees):
        raise ModelError(f"{len(trees)} trees but {len(groups)} groups")
    n_outputs = max(groups, default=0) + 1
    names = output_names or ["score" if n_outputs == 1 else f"p{k}" for k in range(n_outputs)]
    return {
        "header": [(model_id, S.SUM, post_transform, n_outputs, names)],
        "inputs": [(model_id, k, i.name, i.dtype, i.shape,
                    None if i.categories is None else list(i.categories))
                   for k, i in enumerate(inputs)],
        "trees": [(model_id, k, g) for k, g in enumerate(groups)],
        "nodes": [row for k, t in enumerate(trees) for row in _number(model_id, k, t)],
    }


def merge_rows(*models: dict) -> dict:
    return {name: [r for m in models for r in m[name]] for name in S.TABLES}


def write_models(spark: SparkSession, path: str, *models: dict, mode: str = "errorifexists") -> str:
    """Write hand-built models into one model directory."""
    return ModelTables.from_rows(spark, merge_rows(*models)).write(path, mode)


def preorder(root: Leaf | Split) -> list[tuple]:
    """A nested tree as entries of ``PREORDER``."""
    entries, stack = [], [root]
    while stack:
        node = stack.pop()
        if isinstance(node, Leaf):
            entries.append((None, None, None, float(node.value)))
        else:
            entries.append((node.feature, float(node.threshold), node.missing, None))
            stack += [node.otherwise, node.below]
    return entries


def stump_registry(params: DataFrame, input_name: str) -> ModelTables:
    """One stump per row of ``params(model_id, threshold, below, otherwise)``, as a Spark job.

    Every table is derived from ``params`` by projections alone, so a registry of
    millions of models never passes through the driver.
    """
    base = params.select(
        F.col("model_id").cast("string").alias("model_id"),
        F.col("threshold").cast("float").alias("threshold"),
        F.col("below").cast("float").alias("below"),
        F.col("otherwise").cast("float").alias("otherwise"),
    )

    def ints(*values: int) -> Column:
        return F.array(*[F.lit(v) for v in values]).cast("array<int>")

    header = base.select(
        "model_id", F.lit(S.SUM).alias("aggregation"), F.lit(S.IDENTITY).alias("post_transform"),
        F.lit(1).alias("n_outputs"), F.array(F.lit("score")).alias("output_names"))
    inputs = base.select(
        "model_id", F.lit(0).alias("ordinal"), F.lit(input_name).alias("name"),
        F.lit(S.FLOAT32).alias("dtype"), ints(-1).alias("shape"),
        F.lit(None).cast("array<string>").alias("categories"))
    trees = base.select("model_id", F.lit(0).alias("tree_id"), F.lit(0).alias("tree_group"))

    def node(node_id, kind, op, threshold, children, default, value):
        return F.struct(
            F.lit(node_id).alias("node_id"), F.lit(kind).alias("kind"),
            F.lit(0).alias("split_feature"), F.lit(op).alias("split_op"),
            threshold.alias("split_threshold"), children.alias("children"),
            F.lit(default).alias("default_child"), value.alias("leaf_value"))

    zero, none = F.lit(0.0).cast("float"), ints()
    three = F.array(
        node(0, S.BRANCH, S.LESS_THAN, F.col("threshold"), ints(1, 2), 2, zero),
        node(1, S.LEAF, S.SPLIT_OP_UNSPECIFIED, zero, none, 0, F.col("below")),
        node(2, S.LEAF, S.SPLIT_OP_UNSPECIFIED, zero, none, 0, F.col("otherwise")))
    nodes = base.select("model_id", F.lit(0).alias("tree_id"), F.inline(three))
    return ModelTables(header, inputs, trees, nodes)


#: An entry of a tree in preorder. A leaf has no feature; ``missing`` is 'below' or 'otherwise'.
PREORDER = "array<struct<feature: int, threshold: float, missing: string, value: float>>"


def forest_registry(trees: DataFrame, inputs: list[Input], *, post_transform: str = S.IDENTITY) -> ModelTables:
    """Any number of forests over the same inputs, from one row per tree, as a Spark job.

    ``trees`` has ``model_id``, ``tree_id``, ``nodes`` and, for models with several outputs,
    ``tree_group``. ``nodes`` is a tree in preorder, an array of structs as in ``PREORDER``: a branch, the
    tree taken where the feature is below the threshold, the other tree; a leaf is an entry without a
    feature. Trees are numbered level by level where they are, by an Arrow UDF, so nodes are
    neither shuffled nor seen by the driver; only model ids are, to count outputs. A tree whose
    entries do not add up, or a null threshold, side or value, fails the task that reads it.
    """
    rows = trees.select(
        F.col("model_id").cast("string").alias("model_id"), F.col("tree_id").cast("int").alias("tree_id"),
        (F.col("tree_group").cast("int") if "tree_group" in trees.columns else F.lit(0)).alias("tree_group"),
        F.col("nodes").cast(PREORDER).alias("nodes"))
    models = rows.groupBy("model_id").agg((F.max("tree_group") + 1).alias("n_outputs"))
    names = F.when(F.col("n_outputs") == 1, F.array(F.lit("score"))).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("n_outputs") - 1), lambda k: F.concat(F.lit("p"), k.cast("string"))))
    header = models.select(
        "model_id", F.lit(S.SUM).alias("aggregation"), F.lit(post_transform).alias("post_transform"),
        "n_outputs", names.alias("output_names"))
    declared = [F.struct(
        F.lit(k).alias("ordinal"), F.lit(i.name).alias("name"), F.lit(i.dtype).alias("dtype"),
        F.array(*[F.lit(n) for n in i.shape]).alias("shape"),
        (F.lit(None) if i.categories is None else F.array(*[F.lit(c) for c in i.categories]))
        .cast("array<string>").alias("categories")) for k, i in enumerate(inputs)]
    numbered = F.arrow_udf(_number_batch, NUMBERED)
    nodes = rows.select("model_id", "tree_id", F.inline(numbered("nodes")))
    return ModelTables(header, models.select("model_id", F.inline(F.array(*declared))),
                       rows.select("model_id", "tree_id", "tree_group"), nodes)


NUMBERED = ("array<struct<node_id: int, kind: string, split_feature: int, split_op: string, split_threshold: float, "
            "children: array<int>, default_child: int, leaf_value: float>>")


def _number_batch(trees: pa.Array) -> pa.Array:
    """Node rows of each tree, as ``model_rows`` numbers them."""
    if trees.null_count:
        raise ModelError("a tree has no nodes")
    entries, sizes = trees.flatten(), pc.list_value_length(trees).to_numpy()
    feature, threshold, missing, value = (entries.field(k) for k in range(4))
    leaf = feature.is_null().to_numpy(zero_copy_only=False)
    numbered = number(leaf, sizes)
    below = pc.equal(missing, "below")
    known = pc.fill_null(pc.or_(below, pc.equal(missing, "otherwise")), False).to_numpy(zero_copy_only=False)
    empty = np.where(leaf, value.is_null().to_numpy(zero_copy_only=False),
                     threshold.is_null().to_numpy(zero_copy_only=False))
    if empty.any():
        raise ModelError("a branch has no threshold or a leaf no value")
    if (~known & ~leaf).any():
        raise ModelError("missing must be 'below' or 'otherwise'")
    side = pc.fill_null(below, False).to_numpy(zero_copy_only=False)
    default = np.where(leaf, 0, np.where(side, numbered.below, numbered.otherwise))
    n_children = np.where(leaf, 0, 2)
    children = np.stack([numbered.below, numbered.otherwise], axis=1)[~leaf].reshape(-1)
    which = pa.array(leaf)
    rows = pa.StructArray.from_arrays([
        pa.array(numbered.node, pa.int32()),
        pc.if_else(which, S.LEAF, S.BRANCH), pc.fill_null(feature, 0),
        pc.if_else(which, S.SPLIT_OP_UNSPECIFIED, S.LESS_THAN),
        pc.if_else(which, pa.scalar(0, pa.float32()), threshold),
        pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n_children)]), pa.int32()),
                                 pa.array(children, pa.int32())),
        pa.array(default, pa.int32()), pc.if_else(which, value, pa.scalar(0, pa.float32()))],
        names=["node_id", "kind", "split_feature", "split_op", "split_threshold", "children",
               "default_child", "leaf_value"])
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), rows)
