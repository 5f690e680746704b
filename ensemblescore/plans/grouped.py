"""Registries too large to broadcast: models and the rows that name them meet in groups, as streams.

One shuffle brings rows with all their columns, and the nodes of their models, to groups, and
a sort lays each group's nodes before its rows. An Arrow UDF goes through that order: it lays the
group's models out and scores the rows that follow batch by batch, so a group may have any number
of rows. A model above the bound comes the other way round: a bounded block of rows first, and then the
model's trees in ascending order, of which a chunk at a time is in memory and adds to running
sums. Scores follow from content alone, and the group of a row from its model, features and input
partition, so that a task run again sends the same rows to the same groups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ensemblescore.functions.coerce import unused
from ensemblescore.functions.forest import lay_out
from ensemblescore.functions.models import Models
from ensemblescore.functions.walk import Rows, add_trees
from ensemblescore.sources import schema as S
from ensemblescore.sources.scratch import ensure_checkpoint_dir
from ensemblescore.sources.spec import node_columns
from ensemblescore.sources.tables import ModelTables, beside

# What a group's models take at a time, on average over the groups.
NODES_PER_GROUP = 200_000
# Models with groups of their own are sent to every executor up to so many, and joined beyond.
MAX_BROADCAST_MODELS = 200_000

# Where in a group a record comes: the rows of a block before a large model, nodes, and other rows.
BLOCK_ROW, NODE, ROW = -1, 0, 1

SCORE = "struct<row: boolean, sums: array<double>, softmax: boolean>"
_SUMS = pa.list_(pa.float64())
_SCORE = pa.struct([("row", pa.bool_()), ("sums", _SUMS), ("softmax", pa.bool_())])
PER_NODE = ["tree_id", "tree_group", "n_outputs", "softmax", "node_id", "branch", "known_kind", "less_than",
             "split_feature", "split_threshold", "n_children", "below", "otherwise", "default_child", "leaf_value"]


def add_sums(keyed: DataFrame, model: str, x: str, score: str, names: DataFrame, tables: ModelTables, width: int,
             n_models: int, n_nodes: int, largest: int, max_nodes: int, rows_per_group: int) -> DataFrame:
    """``keyed`` without ``model`` and ``x``, and with ``score``: the sums of the model named in ``model`` over ``x``.

    ``names`` has the model names of all rows as its only column and is read beforehand, to find the
    models that need groups of their own; ``keyed`` is read once. Its other columns may have any names,
    and lose only the knowledge that they hold no nulls."""
    spark = keyed.sparkSession
    ensure_checkpoint_dir(spark)
    special, n_special, n_rows = _apart(names, tables, n_models, largest, max_nodes, rows_per_group)
    buckets = max(spark.sparkContext.defaultParallelism, 1 + n_rows // rows_per_group, 1 + n_nodes // NODES_PER_GROUP)
    bucket = F.pmod(F.xxhash64(model), F.lit(buckets)).cast("int")
    # Copies of a row spread by the input partitions they come from. Rows without a model go anywhere.
    spread = F.xxhash64(x, F.spark_partition_id())
    nobody = F.pmod(spread, F.lit(buckets)).cast("int")

    trees = tables.trees.join(beside(tables.header.select(
        "model_id", "n_outputs", (F.col("post_transform") == S.SOFTMAX).alias("softmax")), n_models), "model_id")
    nodes = node_columns(tables.nodes).join(beside(trees, n_nodes), ["model_id", "tree_id"]).select(
        F.col("model_id").alias(model), F.struct(*PER_NODE).alias("node"))
    if n_special:
        own = unused(keyed.columns, "__own")
        special = special.select(F.col("model_id").alias(model), F.struct("parts", "block").alias(own))
        special = F.broadcast(special) if n_special <= MAX_BROADCAST_MODELS else special
        keyed, nodes = (df.join(special, model, "left") for df in (keyed, nodes))
        alone = F.when(F.col(own).isNotNull(), F.col(model))
        parts, block = F.coalesce(F.col(own)["parts"], F.lit(1)), F.coalesce(F.col(own)["block"], F.lit(False))
    else:
        own, alone, parts, block = model, F.lit(None).cast("string"), F.lit(1), F.lit(False)

    def met(bucket, part, place, x, node):
        return F.struct(bucket.alias("bucket"), alone.alias("alone"), part.cast("int").alias("part"),
                        place.alias("place"), F.col(model).alias("model"), x.alias("x"), node.alias("node"))

    # By position, since columns of the input may share a name: what meets comes first.
    node_type = nodes.schema["node"].dataType
    rows = keyed.select(
        met(F.when(F.col(model).isNull(), nobody).otherwise(bucket), F.pmod(spread, parts),
            F.when(block, BLOCK_ROW).otherwise(ROW), F.col(x), F.lit(None).cast(node_type)).alias(score), "*"
    ).drop(model, x, own)
    nodes = nodes.select("*", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    nodes = nodes.select(
        met(bucket, F.col("part"), F.lit(NODE), F.lit(None).cast(keyed.schema[x].dataType), F.col("node")).alias(score),
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields[1:]])
    group = [F.col(score)[c] for c in ("bucket", "alone", "part")]
    ordered = rows.union(nodes).repartition(*group).sortWithinPartitions(
        *group, F.col(score)["place"], F.col(score)["node"]["tree_id"])
    # Not deterministic, so that neither the order nor the nodes are optimised away beneath it.
    scored = _udf(width, max_nodes).asNondeterministic()
    values = [F.col(score)[c] for c in ("bucket", "alone", "part", "place", "model", "x", "node")]
    # The column keeps its place, and gives way to the score behind the others.
    done = unused(ordered.columns, f"{score}_done")
    return ordered.select("*", scored(*values).alias(done)).where(F.col(done)["row"]).drop(score).withColumnRenamed(
        done, score)


def _apart(names: DataFrame, tables: ModelTables, n_models: int, largest: int, max_nodes: int,
           rows_per_group: int) -> tuple[DataFrame | None, int, int]:
    """Models with more rows than a group or more nodes than a task: how many parts, and whether in blocks.

    Returned with how many there are and the number of rows."""
    (name,) = names.columns
    counts = names.where(F.col(name).isNotNull()).groupBy(F.col(name).alias("model_id")).count().checkpoint()
    hot = F.col("count") > rows_per_group
    n_rows, n_hot = counts.agg(F.sum("count"), F.count(F.when(hot, 1))).head()
    if not n_hot and largest <= max_nodes:
        return None, 0, n_rows or 0
    large = tables.nodes.groupBy("model_id").agg((F.count("*") > max_nodes).alias("block")).where("block")
    special = counts.join(beside(large, n_models), "model_id", "left").where(hot | F.col("block")).select(
        "model_id", F.ceil(F.col("count") / rows_per_group).cast("int").alias("parts"),
        F.coalesce("block", F.lit(False)).alias("block")).checkpoint()
    return special, special.count(), n_rows or 0


class _Block:
    """Rows that wait for a large model, and their running sums over its trees."""

    def __init__(self, width: int, max_nodes: int):
        self.width, self.max_nodes = width, max_nodes
        self.rows, self.outs, self.held, self.n_held = [], None, [], 0

    def add_rows(self, x: pa.Array) -> None:
        self.rows.append(Rows(x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), self.width)))

    def add_nodes(self, nodes: pa.Table) -> None:
        """Nodes come in ascending order of their trees; whole trees beyond the bound are walked and let go."""
        self.held.append(nodes)
        self.n_held += len(nodes)
        if self.n_held > self.max_nodes:
            nodes = pa.concat_tables(self.held)
            tree = nodes["tree_id"].to_numpy()
            last = int(np.searchsorted(tree, tree[-1]))
            if last:
                self._walk(nodes.slice(0, last))
                nodes = nodes.slice(last)
            self.held, self.n_held = [nodes], len(nodes)

    def _walk(self, nodes: pa.Table) -> None:
        n_outputs = nodes["n_outputs"][0].as_py()
        self.softmax = nodes["softmax"][0].as_py()
        if self.outs is None:
            self.outs = [np.zeros((n_outputs, r.n)) for r in self.rows]
        trees = nodes.group_by(["tree_id", "tree_group"]).aggregate([])
        forest = lay_out(trees, nodes, width=self.width, n_outputs=n_outputs)
        for r, out in zip(self.rows, self.outs):
            add_trees(forest, r, out)

    def scores(self) -> Iterator[pa.Array]:
        if self.n_held:
            self._walk(pa.concat_tables(self.held))
        for out in self.outs:
            ends = np.arange(0, out.size + 1, len(out), dtype=np.int32)
            yield _scores(pa.ListArray.from_arrays(ends, np.ascontiguousarray(out.T).reshape(-1)),
                          np.full(out.shape[1], self.softmax))


def _scores(sums: pa.Array, softmax: np.ndarray) -> pa.Array:
    return pa.StructArray.from_arrays([pa.array(np.ones(len(sums), bool)), sums, pa.array(softmax, pa.bool_())],
                                      fields=list(_SCORE))


def _runs(*columns: pa.Array) -> Iterator[tuple[int, int]]:
    """Runs of rows that are equal in all columns, a null being equal to a null."""
    n = len(columns[0])
    differ = np.zeros(n + 1, bool)
    differ[[0, n]] = True
    for column in columns:
        codes = column.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        differ[1:n] |= codes[1:] != codes[:-1]
    at = np.flatnonzero(differ)
    yield from zip(at[:-1].tolist(), at[1:].tolist())


def _udf(width: int, max_nodes: int):
    def scores(batches: Iterator) -> Iterator[pa.Array]:
        group, held, models, block, n_nodes = None, [], None, None, 0

        def finished():
            """What a block and the nodes behind it give when their group is over."""
            if block is not None:
                yield from block.scores()
                yield pa.nulls(n_nodes, _SCORE)

        for bucket, alone, part, place, model, x, node in batches:
            for lo, hi in _runs(bucket, alone, part, place) if len(bucket) else ():
                key = (bucket[lo].as_py(), alone[lo].as_py(), part[lo].as_py())
                if key != group:
                    yield from finished()
                    group, held, models, block, n_nodes = key, [], None, None, 0
                kind, n = place[lo].as_py(), hi - lo
                if kind == NODE:
                    own = node.slice(lo, n)
                    table = pa.table([model.slice(lo, n), *own.flatten()], names=["model_id", *PER_NODE])
                    if block is not None:
                        block.add_nodes(table)
                        n_nodes += n
                    else:
                        held.append(table)
                        yield pa.nulls(n, _SCORE)
                elif kind == BLOCK_ROW:
                    block = block or _Block(width, max_nodes)
                    block.add_rows(x.slice(lo, n))
                else:
                    if held:
                        models, held = _laid_out(pa.concat_tables(held), width), []
                    if models is None:
                        yield _scores(pa.nulls(n, _SUMS), np.zeros(n, bool))
                    else:
                        sums, own = models[0].sums(model.slice(lo, n), x.slice(lo, n))
                        yield _scores(sums, models[1][own])
        yield from finished()

    scores.__annotations__ = {"batches": Iterator[tuple[(pa.Array,) * 7]], "return": Iterator[pa.Array]}
    return F.arrow_udf(scores, SCORE)


def _laid_out(nodes: pa.Table, width: int) -> tuple[Models, np.ndarray]:
    header = nodes.group_by(["model_id", "n_outputs", "softmax"]).aggregate([])
    trees = nodes.group_by(["model_id", "tree_id", "tree_group"]).aggregate([])
    return Models.build(header, trees, nodes, width), header.column("softmax").to_numpy()
