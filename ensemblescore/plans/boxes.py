"""Forests as tables of leaf boxes, matched by equi-joins on grid cells. A check on the other plans.

Each leaf is a box: per feature on its path an interval and whether a missing value may pass. Per
tree, the feature with the most thresholds is the grid's axis; its thresholds cut the axis into cells, and
missing values have a cell of their own. A box is sent to every cell that it covers, a row to the one
cell that it is in, and of the boxes met there the one whose other intervals hold the row is its leaf.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ensemblescore.operators.inputs import BoundInput
from ensemblescore.plans import relational
from ensemblescore.sources.scratch import ensure_checkpoint_dir
from ensemblescore.sources.spec import node_columns
from ensemblescore.sources.tables import ModelTables, beside

#: Rows of one cell, and rows of one model, are spread over so many keys.
SPREAD = 16

#: Boxes that cover at most so many cells together are sent to every executor, and nothing is spread.
MAX_BROADCAST_CELLS = 50_000

TREE = ["model_id", "tree_id"]
BOX = ("model_id string, tree_id int, tree_group int, axis int, marks array<float>, cells array<int>, value double, "
       "sides array<struct<feature: int, low: float, high: float, missing: boolean>>")
_SIDE = pa.struct([("feature", pa.int32()), ("low", pa.float32()), ("high", pa.float32()), ("missing", pa.bool_())])
_BOX = pa.schema([("model_id", pa.string()), ("tree_id", pa.int32()), ("tree_group", pa.int32()), ("axis", pa.int32()),
                  ("marks", pa.list_(pa.float32())), ("cells", pa.list_(pa.int32())), ("value", pa.float64()),
                  ("sides", pa.list_(_SIDE))])

#: The cell of rows whose axis feature is missing.
MISSING = -1


def boxes(tables: ModelTables) -> DataFrame:
    """One row per leaf: its tree's grid, the cells that its box covers, its value and its intervals."""
    nodes = node_columns(tables.nodes).join(tables.trees, TREE)
    return nodes.repartition(*TREE).sortWithinPartitions(*TREE, "node_id").mapInArrow(_boxed, BOX)


def _boxed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, nodes = None, {}
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if (row["model_id"], row["tree_id"]) != key:
                out += _of_tree(nodes)
                key, nodes = (row["model_id"], row["tree_id"]), {}
            nodes[row["node_id"]] = row
        yield pa.RecordBatch.from_pylist(out, schema=_BOX)
    yield pa.RecordBatch.from_pylist(_of_tree(nodes), schema=_BOX)


def _of_tree(nodes: dict[int, dict]) -> list[dict]:
    """The boxes of a tree's leaves, found along the paths from its root."""
    if not nodes:
        return []
    thresholds: dict[int, set] = {}
    for n in nodes.values():
        if n["branch"]:
            thresholds.setdefault(n["split_feature"], set()).add(n["split_threshold"])
    axis = max(thresholds, key=lambda f: (len(thresholds[f]), -f), default=0)
    marks = sorted(thresholds.get(axis, ()))
    place = {t: i for i, t in enumerate(marks)}
    out, stack = [], [(0, {})]
    while stack:
        node_id, path = stack.pop()
        n = nodes[node_id]
        if n["branch"]:
            f, t = n["split_feature"], n["split_threshold"]
            low, high, missing = path.get(f, (-np.inf, np.inf, True))
            for child, side in ((n["below"], (low, min(high, t))), (n["otherwise"], (max(low, t), high))):
                # Both children may be one node's default only if they differ, which loading has checked.
                stack.append((child, {**path, f: (*side, missing and n["default_child"] == child)}))
            continue
        low, high, missing = path.pop(axis, (-np.inf, np.inf, True))
        first = 0 if low == -np.inf else place[low] + 1
        last = len(marks) if high == np.inf else place[high]
        cells = [*range(first, last + 1), *([MISSING] if missing else [])]
        sides = [{"feature": f, "low": a, "high": b, "missing": m} for f, (a, b, m) in path.items()]
        out.append({"model_id": n["model_id"], "tree_id": n["tree_id"], "tree_group": n["tree_group"], "axis": axis,
                    "marks": marks, "cells": cells, "value": float(np.float32(n["leaf_value"])), "sides": sides})
    return out


def walk(points: DataFrame, tables: ModelTables) -> DataFrame:
    """Leaves of each distinct ``points(h, model_id, x)`` in each tree of its model, as ``relational.walk`` finds them."""
    ensure_checkpoint_dir(tables.nodes.sparkSession)
    leaves = boxes(tables).checkpoint()  # read by both joins
    n_trees, n_cells = leaves.agg(F.countDistinct(*TREE), F.sum(F.size("cells"))).head()
    if (n_cells or 0) <= MAX_BROADCAST_CELLS:
        return _met(points, leaves, F.broadcast, F.broadcast)
    spread = F.pmod(F.xxhash64("x"), F.lit(SPREAD)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1)))
    return _met(points.withColumn("spread", spread), leaves.withColumn("spread", every),
                lambda grids: beside(grids, n_trees * SPREAD), lambda covered: covered)


def _met(points: DataFrame, leaves: DataFrame, as_grids, as_covered) -> DataFrame:
    """Points with the leaves whose cell and intervals hold them; of both, ``spread`` is a key if it is there."""
    apart = [c for c in ("spread",) if c in points.columns]
    grids = leaves.groupBy(*TREE, *apart).agg(F.first("axis").alias("axis"), F.first("marks").alias("marks"))
    met = points.join(as_grids(grids), ["model_id", *apart])
    along = F.get("x", F.col("axis"))
    met = met.select(*relational.POINT, "tree_id", *apart, F.when(F.isnan(along), MISSING).otherwise(
        F.size(F.filter("marks", lambda t: t <= along))).alias("cell"))
    covered = leaves.select(*TREE, *apart, "tree_group", "value", "sides", F.explode("cells").alias("cell"))

    def holds(side):
        v = F.get("x", side["feature"])
        return F.when(F.isnan(v), side["missing"]).otherwise((v >= side["low"]) & (v < side["high"]))

    return met.join(as_covered(covered), [*TREE, *apart, "cell"]).where(F.forall("sides", holds)).select(
        *relational.POINT, "tree_id", "tree_group", "value")


def add_sums(df: DataFrame, bound: list[BoundInput], tables: ModelTables, n_outputs: int, name: str) -> DataFrame:
    """As ``relational.add_sums``, with leaves found by their boxes."""
    return relational.add_sums(df, bound, tables, n_outputs, name, walk)
