"""Larger forests as an Arrow UDF: the broadcast model meets bounded column batches.

An Arrow UDF, unlike ``mapInArrow``, is a column expression, so filters and column
pruning pass through scoring to the scan.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import SparkContext
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ensemblescore.functions.coerce import MAX_CASE_CATEGORIES, column
from ensemblescore.functions.walk import Lookups, Rows, add_trees, matrix
from ensemblescore.operators.inputs import BoundInput
from ensemblescore.sources.spec import ModelSpec


@dataclass(frozen=True)
class Prepared:
    """A model ready for batches: the forest on every executor, and which inputs it looks at."""

    forest: Broadcast
    lookups: Broadcast
    read: tuple[int, ...]
    n_outputs: int

    def release(self) -> None:
        """Let executors forget a model that is no longer set."""
        self.forest.unpersist()
        self.lookups.unpersist()


def prepare(context: SparkContext, spec: ModelSpec) -> Prepared:
    """Broadcast the forest, renumbered to the inputs some split reads.

    Unread scalars are never sent to Python, nor even scanned. Vectors stay: their
    width is checked whether they are read or not.
    """
    forest = spec.forest
    looked_at = np.zeros(spec.input_width, bool)
    looked_at[forest.feature[forest.branches]] = True
    ends = np.cumsum([i.width for i in spec.inputs])
    read = [k for k, (i, end) in enumerate(zip(spec.inputs, ends))
            if i.is_vector or looked_at[end - 1]] or [0]
    kept = np.zeros(spec.input_width, bool)
    for k in read:
        kept[ends[k] - spec.inputs[k].width:ends[k]] = True
    position = np.maximum(np.cumsum(kept) - 1, 0)
    return Prepared(context.broadcast(replace(forest, feature=position[forest.feature])),
                    context.broadcast(lookups(spec)), tuple(read), spec.n_outputs)


def lookups(spec: ModelSpec) -> Lookups:
    """The category lists that Python looks values up in."""
    return Lookups({k: i.categories for k, i in enumerate(spec.inputs)
                    if i.n_categories > MAX_CASE_CATEGORIES and i.categories is not None})


def arguments(bound: list[BoundInput], read: tuple[int, ...] | None = None) -> tuple[list, list]:
    """The UDF's columns, and of each (name, vector width or 0, input to look up or None)."""
    columns, layout = [], []
    for k in range(len(bound)) if read is None else read:
        item = bound[k]
        columns.append(column(item.column).cast("string") if item.has_long_vocabulary else item.floats)
        layout.append((item.column, item.width if item.spec.is_vector else 0,
                       k if item.has_long_vocabulary else None))
    return columns, layout


def add_sums(df: DataFrame, bound: list[BoundInput], prepared: Prepared, name: str) -> DataFrame:
    """Append ``name``: the sums as ``array<double>``, or a plain double for one output."""
    shared, known, n_outputs = prepared.forest, prepared.lookups, prepared.n_outputs
    columns, layout = arguments(bound, prepared.read)

    def sums(batches: Iterator) -> Iterator[pa.Array]:
        forest = shared.value
        for batch in batches:
            rows = Rows(matrix(batch if isinstance(batch, tuple) else (batch,), layout, known.value))
            out = np.zeros((n_outputs, rows.n))
            add_trees(forest, rows, out)
            if n_outputs == 1:
                yield pa.array(out[0])
            else:
                ends = np.arange(0, out.size + 1, n_outputs, dtype=np.int32)
                yield pa.ListArray.from_arrays(ends, np.ascontiguousarray(out.T).reshape(-1))

    # Typed here, since annotations on a local function cannot name the number of inputs.
    kind = pa.Array if len(columns) == 1 else tuple[(pa.Array,) * len(columns)]
    sums.__annotations__ = {"batches": Iterator[kind], "return": Iterator[pa.Array]}
    score = F.arrow_udf(sums, "double" if n_outputs == 1 else "array<double>")
    return df.select("*", score(*columns).alias(name))
