"""Embedding near-duplicates by sorted projection passes.

Each pass orders the vectors lexicographically by concatenated random hashes, the signs of random
projections from the vectors' mean, and compares every vector with a bounded window of its
neighbours in that order. Where more vectors share leading hashes than a window holds, as in a hot
topic, that run is ordered again by hashes from its own mean, which tell its vectors apart
where those of all vectors cannot, and so on. How many passes a run gets follows from its size and
its own density. Verified pairs of all passes are joined to components, and the links inside each component are
counted in full: two vectors whose angles to the component's centre add up to less than the
threshold angle are linked, and only bins of angles that this leaves open are compared vector
by vector, in bounded blocks.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ensemblescore.llm.components import connected_components
from ensemblescore.sources.scratch import ensure_checkpoint_dir

THRESHOLD = 0.95

#: Least passes over all vectors, hashes concatenated, and neighbours a vector is compared with on either side.
PASSES, BITS, WINDOW = 12, 48, 512

#: The chance that all passes over even vectors miss a pair just at the threshold. A run of m vectors at mean cosine
#: s puts such a pair at the cosine r = 1 - (1 - threshold) / (1 - s) around its mean, and one pass leaves it
#: together with a chance of (1 - acos(r) / pi) ** log2(m / WINDOW), however others lie.
MISS = 0.001

#: The least r planned for: in runs denser than that, chains of links join what one pass misses.
LEAST = 0.5

#: Runs within runs at most; deeper ones have their windows only.
DEPTH = 8
SEED = 17

#: Vectors of one order compared in a task, and in a block of one angle's bin; the width of a bin.
BLOCK, BIN_BLOCK, BIN = 4096, 1024, 0.001
_SLACK = 1e-7

#: Rows of one run or component are dealt to so many tasks when they meet its centre.
SPREAD = 16


def _matrix(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors as rows, padded with zeros to one width, and their own widths."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    widths = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(vectors), int(widths.max()) if len(widths) else 0))
    out[np.arange(out.shape[1])[None, :] < widths[:, None]] = flat
    out /= np.abs(out).max(axis=1, keepdims=True)
    return out / np.linalg.norm(out, axis=1, keepdims=True), widths


def _unit() -> Column:
    def run(vectors: pa.Array) -> pa.Array:
        unit, widths = _matrix(vectors)
        flat = unit[np.arange(unit.shape[1])[None, :] < widths[:, None]]
        return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(widths)), pa.int32()), pa.array(flat))
    return F.arrow_udf(run, "array<double>")("v")


def _hashes(level: int, bits: int) -> Column:
    """For each of a vector's ``passes`` the signs of projections from its run's mean, the first hash highest."""
    def run(vectors: pa.Array, means: pa.Array, passes: pa.Array) -> pa.Array:
        unit, widths = _matrix(vectors)
        passes = passes.to_numpy(zero_copy_only=False).astype(np.int64)
        flat = means.flatten().to_numpy(zero_copy_only=False)
        starts = np.cumsum(passes) - passes
        out = np.zeros(int(passes.sum()), np.int64)
        at = np.cumsum(widths) - widths
        for width in np.unique(widths).tolist():
            rows = np.flatnonzero(widths == width)
            apart = unit[rows, :width] - flat[at[rows][:, None] + np.arange(width)]
            for k in range(int(passes[rows].max())):
                some = passes[rows] > k
                planes = np.random.default_rng([SEED, level, width, k]).standard_normal((width, bits))
                signs = apart[some] @ planes > 0
                out[starts[rows[some]] + k] = (signs.astype(np.int64) << np.arange(bits - 1, -1, -1)).sum(axis=1)
        return pa.ListArray.from_arrays(pa.array(np.append(starts, len(out)), pa.int32()), pa.array(out))
    return F.arrow_udf(run, "array<bigint>")("v", "mean", "passes")


def _planned(rows: DataFrame, level: int, threshold: float, passes: int, bits: int, window: int) -> DataFrame:
    """One row per run of (run, node, v): its ``mean``, its ``passes``, and the leading hashes its vectors part by.

    A run within a run whose mean cosine is at the threshold needs none: most of its pairs are linked, and the
    windows it has already chain them."""
    runs = rows.select("run", _unit().alias("unit")).groupBy("run").agg(
        F.count("*").alias("m"), vector_to_array(Summarizer.mean(array_to_vector("unit"))).alias("mean"))
    dense = F.aggregate("mean", F.lit(0.0), lambda s, x: s + x * x)
    r = F.greatest(F.lit(LEAST), 1 - (1 - threshold) / F.greatest(1 - dense, F.lit(1e-12)))
    needed = F.greatest(F.lit(0.0), F.log2(F.col("m") / window))
    caught = F.pow(1 - F.acos(r) / math.pi, needed)
    wanted = F.when(dense < threshold, 1 / caught).otherwise(0)
    if level == 0:
        wanted = F.greatest(F.lit(float(passes)), F.when(caught < 1, math.log(MISS) / F.log1p(-caught)).otherwise(0.0))
    return runs.select("run", "mean", F.ceil(wanted).cast("int").alias("passes"),
                       F.least(F.ceil(needed), F.lit(bits)).cast("int").alias("leading"))


def _neighbours(threshold: float, window: int, block: int):
    """Links of a block of one order, and of its last vectors to the first of the next block, reduced to stars."""
    def run(table):
        table = table.sort_by("place")
        unit, widths = _matrix(table["v"])
        labels = np.arange(len(unit))
        step = max(window, 256)
        for lo in range(0, min(len(unit), block), step):
            hi = min(lo + step + window, len(unit))
            near = (unit[lo:lo + step] @ unit[lo:hi].T >= threshold) & (widths[lo:lo + step, None] == widths[lo:hi])
            for k in np.flatnonzero(near.sum(axis=1) > 1).tolist():
                met = labels[lo:hi][near[k]]
                if (met != met[0]).any():
                    to = np.arange(len(unit))
                    to[met] = met.min()
                    labels = to[labels]
        node, linked = table["node"].to_numpy(), labels != np.arange(len(labels))
        return pa.table({"a": node[linked], "b": node[labels[linked]]})
    return run


def _windows(order: DataFrame, classes: DataFrame, threshold: float, window: int, block: int) -> DataFrame:
    """Links of all (run, pass, signs, node) to their neighbours in that order."""
    keys = ["run", "pass", "signs", "node"]
    order = order.repartitionByRange(*keys).withColumn("chunk", F.spark_partition_id()).checkpoint()
    total, starts = 0, []
    for r in order.groupBy("chunk").count().orderBy("chunk").collect():
        starts.append((r["chunk"], total))
        total += r["count"]
    if not total:
        return order.sparkSession.createDataFrame([], "a bigint, b bigint")
    begin = F.element_at(F.create_map(*[F.lit(x) for pair in starts for x in pair]), F.col("chunk"))
    place = begin + F.row_number().over(Window.partitionBy("chunk").orderBy(*keys)) - 1
    placed = order.select("node", place.cast("bigint").alias("place"))
    number = F.floor(F.col("place") / block)
    also = F.when((number > 0) & (F.col("place") % block < window), F.array(number, number - 1)).otherwise(F.array(number))
    return placed.select("node", "place", F.explode(also).alias("block")).join(classes.select("node", "v"), "node") \
        .groupBy("block").applyInArrow(_neighbours(threshold, window, block), "a bigint, b bigint")


def _links(classes: DataFrame, threshold: float, passes: int, bits: int, window: int, block: int) -> DataFrame:
    """Links that join every group found by any pass. Runs of all depths are put in order and compared together."""
    rows = classes.select(F.size("v").cast("bigint").alias("run"), "node", "v")
    orders = []
    for level in range(DEPTH):
        runs = _planned(rows, level, threshold, passes, bits, window).withColumn(
            "spread", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
        order = rows.withColumn("spread", F.pmod(F.xxhash64("node"), F.lit(SPREAD)).cast("int")).join(
            runs, ["run", "spread"]).select(
            "run", "node", "leading", F.posexplode(_hashes(level, bits)).alias("pass", "signs")).withColumn(
            "inner", F.xxhash64("run", "pass", F.expr(f"shiftright(signs, {bits} - leading)"))).checkpoint()
        orders.append(order.select("run", "pass", "signs", "node"))
        crowded = order.groupBy("inner").count().where(F.col("count") > 2 * window).select("inner").checkpoint()
        if crowded.isEmpty():
            break
        rows = order.join(crowded, "inner", "left_semi").select(F.col("inner").alias("run"), "node").join(
            classes.select("node", "v"), "node").checkpoint()
    return _windows(reduce(DataFrame.unionByName, orders), classes, threshold, window, block)


def _angle() -> Column:
    """The angle between a vector and its component's centre; the first axis stands in for a centre at zero."""
    def run(vectors: pa.Array, centres: pa.Array) -> pa.Array:
        unit, widths = _matrix(vectors)
        out = np.zeros(len(unit))
        for i, centre in enumerate(centres.to_pylist()):
            c = np.array(centre)
            size = np.linalg.norm(c)
            c = c / size if size > 1e-9 else np.eye(1, len(c))[0]
            u = unit[i, :len(c)]
            out[i] = 2 * math.atan2(np.linalg.norm(u - c), np.linalg.norm(u + c))
        return pa.array(out)
    return F.arrow_udf(run, "double")("v", "centre")


def _compared(threshold: float):
    """Weights linked to each vector of two blocks of undecided vectors, or within one."""
    def run(table):
        side, node, n = (table[c].to_numpy() for c in ("side", "node", "n"))
        unit, _ = _matrix(table["v"])
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        if not len(right):
            near = unit @ unit.T >= threshold
            np.fill_diagonal(near, False)
            return pa.table({"node": node, "more": near @ n})
        near = unit[left] @ unit[right].T >= threshold
        return pa.table({"node": np.concatenate([node[left], node[right]]),
                         "more": np.concatenate([near @ n[right], n[left] @ near])})
    return run


def _counted(members: DataFrame, threshold: float) -> DataFrame:
    """(node, linked): for (node, component, n, v), the weight of other nodes linked to each."""
    theta = math.acos(threshold)
    centres = members.groupBy("component").agg(vector_to_array(Summarizer.mean(array_to_vector(_unit()))).alias("centre"))
    centres = centres.withColumn("spread", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    placed = members.withColumn("spread", F.pmod(F.xxhash64("node"), F.lit(SPREAD)).cast("int")).join(
        centres, ["component", "spread"]).select(
        "node", "component", "n", "v", F.floor(_angle() / BIN).cast("int").alias("bin")).checkpoint()

    # Per component at most one entry for each bin of angles.
    bins = placed.groupBy("component", "bin").agg(F.count("*").alias("rows"), F.sum("n").alias("weight"))
    bins = bins.groupBy("component").agg(F.collect_list(F.struct("bin", "rows", "weight")).alias("bins"))
    high = (F.col("own.bin") + 1) * BIN + _SLACK
    low = F.col("own.bin") * BIN - _SLACK
    each = bins.withColumn("own", F.explode("bins"))

    def sure(other):
        return high + (other["bin"] + 1) * BIN + _SLACK <= theta

    def open_(other):
        return (~sure(other)) & (other["bin"] * BIN - _SLACK - high <= theta) & (other["bin"] >= F.col("own.bin"))

    certain = each.select("component", F.col("own.bin").alias("bin"), F.aggregate(
        F.filter("bins", sure), F.lit(0).cast("bigint"), lambda s, b: s + b["weight"]).alias("certain"),
        (2 * high <= theta).alias("with_own"))
    undecided = each.select("component", F.col("own").alias("i"), F.explode(F.filter("bins", open_)).alias("j"))

    def blocks_of(rows):
        return F.sequence(F.lit(0), F.floor((rows - 1) / BIN_BLOCK))

    pairs = undecided.select(
        "component", F.col("i.bin").alias("i"), F.col("j.bin").alias("j"), F.col("i.rows").alias("ni"),
        F.col("j.rows").alias("nj")).withColumn("si", F.explode(blocks_of(F.col("ni")))).withColumn(
        "sj", F.explode(blocks_of(F.col("nj")))).where("i < j or si <= sj")
    parts = placed.join(each.select("component", F.col("own.bin").alias("bin"), F.col("own.rows").alias("rows")),
                        ["component", "bin"]).withColumn("part", F.pmod(
                            F.xxhash64("node"), F.floor((F.col("rows") - 1) / BIN_BLOCK) + 1))
    pair = ["component", "i", "si", "j", "sj"]
    left = pairs.join(parts.select("component", F.col("bin").alias("i"), F.col("part").alias("si"), "node", "n", "v"),
                      ["component", "i", "si"]).withColumn("side", F.lit(0))
    right = pairs.where("i < j or si < sj").join(
        parts.select("component", F.col("bin").alias("j"), F.col("part").alias("sj"), "node", "n", "v"),
        ["component", "j", "sj"]).withColumn("side", F.lit(1))
    wanted = [*pair, "side", "node", "n", "v"]
    more = left.select(*wanted).unionByName(right.select(*wanted)).groupBy(*pair).applyInArrow(
        _compared(threshold), "node bigint, more bigint").groupBy("node").agg(F.sum("more").alias("more"))
    return placed.join(certain, ["component", "bin"]).join(more, "node", "left").select(
        "node", (F.col("certain") - F.when(F.col("with_own"), F.col("n")).otherwise(0)
                 + F.coalesce("more", F.lit(0))).alias("linked"))


def near_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD,
                 passes: int = PASSES, bits: int = BITS, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """One row per vector: ``vec_id``, ``n_links``, ``component_id`` and ``kept``.

    ``n_links`` counts the other rows whose cosine is at least ``threshold``, copies included;
    ``component_id`` is the smallest key reachable by links; ``kept`` says that it is the row's
    own. Vectors that are null, empty, zero or hold a null or non-finite component link with
    nothing, nor do rows with a null key, nor vectors of different widths. Copies meet in
    one class first. Repeated rows are kept, and an empty table gives no rows. At least ``passes``
    passes over all vectors order them by ``bits`` hashes (62 at most) and compare each with ``window``
    neighbours on either side, ``block`` vectors to a task.
    """
    ensure_checkpoint_dir(df.sparkSession)
    v = F.col("v")
    rows = df.select(df[key].alias("vec_id"), df[vector].alias("v"))
    usable = (F.col("vec_id").isNotNull() & v.isNotNull()
              & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
              & F.exists(v, lambda x: x != 0))
    rows = rows.select("vec_id", "v", F.coalesce(usable, F.lit(False)).alias("usable"),
                       F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(SEED), "v").alias("h2"))
    classes = rows.where("usable").groupBy("h1", "h2").agg(
        F.first("v").alias("v"), F.min("vec_id").alias("first"), F.count("*").alias("n")).withColumn(
        "node", F.monotonically_increasing_id()).checkpoint()
    found = connected_components(_links(classes, threshold, passes, bits, window, block))
    roots = found.select(F.col("component").alias("node"), "component").distinct()
    members = classes.join(found.unionByName(roots), "node").checkpoint()
    counted = _counted(members.select("node", "component", "n", "v"), threshold)
    smallest = members.groupBy("component").agg(F.min("first").alias("component_id"))
    grouped = members.select("node", "component").join(smallest, "component").join(counted, "node").select(
        "node", "component_id", "linked")
    named = classes.select("h1", "h2", "node", "first", "n").join(grouped, "node", "left").select(
        "h1", "h2", F.coalesce("component_id", "first").alias("component_id"),
        (F.col("n") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), F.lit(True).alias("usable"))
    return rows.select("vec_id", "h1", "h2", "usable").join(named, ["h1", "h2", "usable"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id")).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
