"""Forests too large to broadcast whole, as one Arrow UDF over chunks of trees.

The forest is cut by tree into chunks below the broadcast bound. A task buffers a bounded block
of batches and takes the chunks in ascending tree order, one in memory at a time, into running
sums, so the result equals that of the ``arrow`` plan bit for bit. Narrow: one scan, no shuffle,
and it works on streams.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ensemblescore.functions.forest import Forest, lay_out
from ensemblescore.functions.walk import Rows, add_trees, matrix
from ensemblescore.operators.inputs import BoundInput
from ensemblescore.plans.arrow import Lookups, arguments
from ensemblescore.sources.spec import ModelSpec, at_once, node_columns
from ensemblescore.sources.tables import ModelTables

# Numbers a task buffers: features, kept twice for the walk, and sums.
VALUES_PER_BLOCK = 8_000_000


def prepare(tables: ModelTables, spec: ModelSpec, max_nodes: int) -> list[Broadcast]:
    """One broadcast per chunk. The driver holds a node count per tree, and one chunk at a time."""
    spark = tables.nodes.sparkSession
    sizes = tables.nodes.groupBy("tree_id").count().toArrow().sort_by("tree_id")
    tree, size = sizes.column("tree_id").to_numpy(), sizes.column("count").to_numpy()
    chunks, start = [], 0
    while start < len(tree):
        stop = start + max(1, int(np.searchsorted(np.cumsum(size[start:]), max_nodes, side="right")))
        mine = F.col("tree_id").between(int(tree[start]), int(tree[stop - 1]))
        trees, nodes = at_once(
            spark, tables.trees.where(mine).select("tree_id", "tree_group").toArrow,
            node_columns(tables.nodes.where(mine)).toArrow)
        chunks.append(spark.sparkContext.broadcast(
            lay_out(trees, nodes, width=spec.input_width, n_outputs=spec.n_outputs)))
        start = stop
    return chunks


def _taken_out(chunk: Broadcast) -> Forest:
    """The chunk's trees; the worker reads them from its disk and does not keep them."""
    forest = chunk.value
    chunk.__dict__.pop("_value", None)
    return forest


def _blocks(batches: Iterator, n_values: int) -> Iterator[list[tuple]]:
    """Batches in runs of bounded size; a larger batch is a run of its own."""
    held, n = [], 0
    for batch in batches:
        columns = batch if isinstance(batch, tuple) else (batch,)
        if held and n + len(columns[0]) * n_values > VALUES_PER_BLOCK:
            yield held
            held, n = [], 0
        held.append(columns)
        n += len(columns[0]) * n_values
    if held:
        yield held


def add_sums(df: DataFrame, bound: list[BoundInput], chunks: list[Broadcast], lookups: Broadcast,
             n_outputs: int, name: str) -> DataFrame:
    """Append ``name``: the sums as ``array<double>``, or a plain double for one output."""
    columns, layout = arguments(bound)
    n_values = 2 * sum(item.width for item in bound) + n_outputs

    def sums(batches: Iterator) -> Iterator[pa.Array]:
        known: Lookups = lookups.value
        for block in _blocks(batches, n_values):
            rows = [Rows(matrix(columns, layout, known)) for columns in block]
            outs = [np.zeros((n_outputs, r.n)) for r in rows]
            for chunk in chunks:
                forest = _taken_out(chunk)
                for r, out in zip(rows, outs):
                    add_trees(forest, r, out)
            for out in outs:
                if n_outputs == 1:
                    yield pa.array(out[0])
                else:
                    ends = np.arange(0, out.size + 1, n_outputs, dtype=np.int32)
                    yield pa.ListArray.from_arrays(ends, np.ascontiguousarray(out.T).reshape(-1))

    kind = pa.Array if len(columns) == 1 else tuple[(pa.Array,) * len(columns)]
    sums.__annotations__ = {"batches": Iterator[kind], "return": Iterator[pa.Array]}
    score = F.arrow_udf(sums, "double" if n_outputs == 1 else "array<double>")
    return df.select("*", score(*columns).alias(name))
