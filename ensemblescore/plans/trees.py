"""Few rows under a forest of any size: the rows go to the trees.

Distinct feature rows, up to a checked number, are sent to every executor, and trees are dealt to
tasks. A task walks its trees a part at a time and adds their leaves up exactly: a float32 is a whole
number of units of 2**-149, kept in limbs of 32 bits, and limbs are whole numbers whose sums do not
depend on any order. Partial sums of tasks are added by Spark, and the total is rounded once. So trees may
be split over any number of tasks, and the result is that of an exact sum.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ensemblescore.errors import ModelError
from ensemblescore.functions.forest import lay_out
from ensemblescore.functions.walk import Rows, descend
from ensemblescore.operators.inputs import BoundInput
from ensemblescore.plans.relational import features_of
from ensemblescore.sources.scratch import ensure_checkpoint_dir
from ensemblescore.sources.spec import ModelSpec, at_once, node_columns
from ensemblescore.sources.tables import ModelTables

#: Features of all distinct rows together, and nodes that a task holds at a time.
MAX_VALUES, NODES_AT_ONCE = 4_000_000, 1_000_000

#: Limbs of 32 bits for float32 in units of 2**-149: 277 bits, and one more limb for carries.
LIMBS = 10
UNIT = -149


def exact_limbs(values: np.ndarray) -> np.ndarray:
    """(limb, value): finite float32 values as signed limbs, each below 2**32 in size, the lowest first."""
    mantissa, exponent = np.frexp(values.astype(np.float64))
    # A float32 is a whole number below 2**24 times 2**shift, and shift is not below 0 in units of 2**-149.
    whole = np.ldexp(mantissa, 24).astype(np.int64)
    shift = exponent.astype(np.int64) - 24 - UNIT
    below = np.minimum(shift, 0)  # subnormals have fewer bits than 24
    whole, shift = whole >> -below, shift - below
    limb, bit = np.divmod(shift, 32)
    sign, size = np.sign(whole), np.abs(whole)
    out = np.zeros((LIMBS, len(values)), np.int64)
    at = np.arange(len(values))
    spread = size << bit  # below 2**56
    out[limb, at] = sign * (spread & 0xFFFFFFFF)
    out[np.minimum(limb + 1, LIMBS - 1), at] += sign * (spread >> 32)
    return out


def rounded(limbs: list[int]) -> float:
    """The double nearest to a sum of limbs."""
    total = sum(int(limb) << (32 * k) for k, limb in enumerate(limbs))
    return total / (1 << -UNIT)  # true division of whole numbers rounds once


def add_sums(df: DataFrame, bound: list[BoundInput], tables: ModelTables, spec: ModelSpec, name: str) -> DataFrame:
    """Append ``name``: the exact sums as ``array<double>``, or a plain double for one output."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    key, keyed = features_of(df, bound, tables, name)
    points = keyed.select(F.col(key).alias("x")).distinct().checkpoint()
    n_points, width, n_outputs = points.count(), spec.input_width, spec.n_outputs
    if n_points * width > MAX_VALUES:
        raise ModelError(f"{n_points} distinct rows of {width} features are too many to send to the trees; "
                         "use 'chunked'")
    found = points.toArrow()
    matrix = found.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n_points, width)
    shared = spark.sparkContext.broadcast(matrix)
    numbered = spark.createDataFrame(found.append_column("point", pa.array(np.arange(n_points), pa.int64())))

    nodes = node_columns(tables.nodes).join(tables.trees.select("tree_id", "tree_group"), "tree_id")
    partial = nodes.repartition("tree_id").sortWithinPartitions("tree_id").mapInArrow(
        _walked(shared, n_outputs), "point bigint, output int, " + ", ".join(f"l{k} bigint" for k in range(LIMBS)))
    total = partial.groupBy("point", "output").agg(*[F.sum(f"l{k}").alias(f"l{k}") for k in range(LIMBS)])

    @F.arrow_udf("double")
    def as_double(limbs: pa.Array) -> pa.Array:
        return pa.array([rounded(x) for x in limbs.to_pylist()], pa.float64())

    sums = total.select("point", "output", as_double(F.array(*[f"l{k}" for k in range(LIMBS)])).alias("sum"))
    sums = sums.groupBy("point").agg(F.map_from_entries(F.collect_list(F.struct("output", "sum"))).alias("by")).select(
        "point", F.transform(F.sequence(F.lit(0), F.lit(n_outputs - 1)),
                             lambda k: F.coalesce(F.col("by")[k], F.lit(0.0))).alias("sums"))
    result = F.get("sums", F.lit(0)) if n_outputs == 1 else F.col("sums")
    # The rows go back by their features, as many as were sent out.
    scored = numbered.join(sums, "point").select(F.col("x").alias(key), result.alias(name))
    return keyed.join(F.broadcast(scored), key, "left").drop(key)


def _walked(shared, n_outputs: int):
    """Exact partial sums of a task's trees for every point, from nodes sorted by tree."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = shared.value
        n, width = features.shape
        rows, sums = Rows(features), np.zeros((n_outputs, LIMBS, n), np.int64)
        held, n_held, any_tree = [], 0, False

        def walk(table):
            trees = table.group_by(["tree_id", "tree_group"]).aggregate([])
            forest = lay_out(trees, table, width=width, n_outputs=n_outputs)
            for root, group, depth in zip(forest.root, forest.group, forest.depth):
                leaf = descend(forest, rows, np.full(n, root, np.intp), int(depth))
                if not np.isfinite(leaf).all():
                    raise ModelError("a leaf that is not finite has no exact sum")
                sums[group] += exact_limbs(leaf)
            # Carries go up now and then, so that limbs stay far from 63 bits.
            for k in range(LIMBS - 1):
                carry = sums[:, k] >> 32
                sums[:, k] -= carry << 32
                sums[:, k + 1] += carry

        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            n_held += batch.num_rows
            if n_held > NODES_AT_ONCE:
                table = pa.concat_tables(held)
                tree = table["tree_id"].to_numpy()
                last = int(np.searchsorted(tree, tree[-1]))
                if last:
                    walk(table.slice(0, last))
                    any_tree, table = True, table.slice(last)
                held, n_held = [table], table.num_rows
        if n_held:
            walk(pa.concat_tables(held))
            any_tree = True
        for output in range(n_outputs) if any_tree else ():
            for lo in range(0, n, 1 << 16):
                part = sums[output, :, lo:lo + (1 << 16)]
                yield pa.record_batch(
                    [pa.array(np.arange(lo, lo + part.shape[1]), pa.int64()),
                     pa.array(np.full(part.shape[1], output), pa.int32()), *(pa.array(limb) for limb in part)],
                    names=["point", "output", *(f"l{k}" for k in range(LIMBS))])
    return run
