"""Centroid clustering of integer vectors, with centroids filtered by n-simplex projection.

A few pivots span a simplex. A vector's distances to them, cached once, fix the apex of a simplex
above that base: its coordinates in the base's space and its height. Between two vectors, the
distance of the apexes on one side of the base is at most their distance, and that with one
apex on the other side is at least it. Each round the apexes of the centroids are put beside those of
the vectors; a centroid whose lower bound is above the smallest upper bound cannot be nearest, and the
others are compared exactly, in integers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ensemblescore.llm.text import named
from ensemblescore.sources.scratch import ensure_checkpoint_dir

#: Components of a vector, the scale before rounding down, centroids, rounds and the seed of the first centroids.
DIMENSIONS, SCALE, CENTROIDS, ROUNDS, SEED = 64, 64, 16, 3, "1"

#: Pivots at most, and their least height above those before as a share of the first distance. Low heights
#: would magnify the rounding of apex coordinates.
PIVOTS, LEAST_HEIGHT = 8, 0.05

#: Integers beyond this would have squared distances that 64 bits cannot hold.
MOST = 1 << 27

#: Bounds are widened by this share of a row's largest squared distance to a pivot, and more for rows far
#: outside the base. Doubles lose some 1e-11 of it over so few pivots of such heights (a coordinate's error is
#: at most 2^i rounding errors over its height), so no nearest centroid is ever filtered out.
SLACK = 1e-7

#: Rows handled at a time.
ROWS = 4096


class Simplex:
    """A base of pivots, chosen greedily by height among candidates, and the apexes above it."""

    def __init__(self, candidates: list[list[int]]):
        self.pivots, self.widest = np.zeros((0, 0), np.int64), 0.0
        rows = np.array(candidates, np.int64)
        if not len(rows):
            return
        # The greatest height above the pivots so far is the next pivot; the first is the first candidate.
        chosen, self.base = [0], np.zeros((1, 0))
        at = np.zeros((len(rows), 0))
        squared = squared_distances(rows, rows[0])
        self.widest = widest = float(squared.max())
        while len(chosen) < min(PIVOTS, len(rows)):
            heights = np.maximum(squared - (at ** 2).sum(axis=1), 0)
            best = int(heights.argmax())
            if heights[best] <= (LEAST_HEIGHT ** 2) * widest or widest == 0:
                break
            chosen.append(best)
            # Each pivot adds an axis: its own height along it, and where all others lie on it.
            height = math.sqrt(heights[best])
            to_best = squared_distances(rows, rows[best]).astype(np.float64)
            axis = (squared + height ** 2 + (at[best] ** 2).sum() - to_best - 2 * at @ at[best]) / (2 * height)
            at = np.hstack([at, axis[:, None]])
            self.base = np.hstack([np.vstack([self.base, at[best][None, :-1]]),
                                   np.append(np.zeros(len(chosen) - 1), height)[:, None]])
        self.pivots = rows[chosen]

    def distances(self, rows: np.ndarray) -> np.ndarray:
        """Squared distances to the pivots, a column for each."""
        return np.stack([squared_distances(rows, p) for p in self.pivots], axis=1)

    def slack(self, squared: np.ndarray) -> np.ndarray:
        """What rounding may take from the bounds of rows of squared distances, at most."""
        most = squared.max(axis=1).astype(np.float64)
        return SLACK * most * np.maximum(1, np.sqrt(most / self.widest) if self.widest else 1)

    def apexes(self, squared: np.ndarray) -> np.ndarray:
        """Coordinates over the base, and last the height, of rows of squared distances to the pivots."""
        squared = squared.astype(np.float64)
        n = len(self.pivots)
        at = np.zeros((len(squared), n))
        for i in range(1, n):
            row = self.base[i]
            at[:, i - 1] = (squared[:, 0] + (row ** 2).sum() - squared[:, i] - 2 * at[:, :i - 1] @ row[:i - 1]) / (
                2 * row[i - 1])
        at[:, n - 1] = np.sqrt(np.maximum(squared[:, 0] - (at[:, :n - 1] ** 2).sum(axis=1), 0))
        return at


def squared_distances(rows: np.ndarray, to: np.ndarray) -> np.ndarray:
    difference = rows - to
    return np.einsum("ij,ij->i", difference, difference)


def bounds(apexes: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared lower and upper bounds between each row of ``apexes`` and each row of ``of``."""
    flat = ((apexes[:, None, :-1] - of[None, :, :-1]) ** 2).sum(axis=2)
    low = flat + (apexes[:, None, -1] - of[None, :, -1]) ** 2
    high = flat + (apexes[:, None, -1] + of[None, :, -1]) ** 2
    return low, high


def nearest(rows: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, of: np.ndarray,
            slack: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The nearest centroid of each row, ties to the smaller number; its squared distance; distances computed."""
    low, high = bounds(apexes, of)
    open_ = low <= (high.min(axis=1) + slack)[:, None]
    best = np.full(len(rows), np.iinfo(np.int64).max)
    cluster = np.zeros(len(rows), np.int32)
    for c in range(len(centroids)):
        at = np.flatnonzero(open_[:, c])
        distance = squared_distances(rows[at], centroids[c])
        nearer = distance < best[at]
        best[at[nearer]], cluster[at[nearer]] = distance[nearer], c
    return cluster, best, int(open_.sum())


def _matrix(lists: pa.Array, kind) -> np.ndarray:
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return flat.reshape(len(lists), -1)


def integer_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding", dimensions: int = DIMENSIONS,
                    scale: int = SCALE) -> DataFrame:
    """``vec_id`` and ``ints``: floor(scale * x) of vectors of so many components, none null or non-finite.

    Others are left out. A component whose integer is beyond ``MOST`` fails the task with a message, as no
    long holds the distances that such vectors have."""
    x = named(vector)
    scaled = F.transform(x, lambda v: v.cast("double") * F.lit(float(scale)))
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) != float("inf")))
    far = F.exists(scaled, lambda v: F.abs(v) >= MOST)
    return df.where(x.isNotNull()).where(F.size(x) == dimensions).where(finite).select(
        named(key).alias("vec_id"),
        F.when(far, F.raise_error(F.lit(f"a component times {scale} is beyond {MOST}"))).otherwise(
            F.transform(scaled, lambda v: F.floor(v).cast("int"))).alias("ints"))


def cluster(df: DataFrame, key: str = "vec_id", vector: str = "embedding", centroids: int = CENTROIDS,
            rounds: int = ROUNDS, seed: str = SEED, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """One row per kept vector: ``vec_id``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia``, ``centroid``.

    The first centroids are the kept vectors of the smallest SHA-256 of ``<seed>:<vec_id>``, in that order; ids
    that tie (a null id counts as empty) go by their vectors. Each round assigns every vector to the
    nearest centroid, ties to the smaller number, and replaces centroids that have vectors by the componentwise
    floor of their mean; then all are assigned once more. Distances are squared and exact, and the
    centroids of repeated vectors may be equal, of which the smaller number gets all. Repeated
    rows are vectors of their own; fewer vectors than centroids are fewer centroids; without any there are
    no rows; other columns are not read. A task sends one row of sums per cluster and component,
    and the driver sees only those added up, so a cluster that holds most vectors is no task of its own.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    kept = integer_vectors(df, key, vector, dimensions, scale)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = kept.select(digest.alias("digest"), "ints").orderBy("digest", "ints").limit(centroids).collect()
    simplex, middle = Simplex([r.ints for r in first]), [list(r.ints) for r in first]

    def cached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            squared = simplex.distances(_matrix(batch.column(1), np.int64))
            offsets = np.arange(0, squared.size + 1, squared.shape[1], dtype=np.int32)
            yield pa.record_batch(
                [*batch.columns, pa.ListArray.from_arrays(pa.array(offsets), pa.array(squared.reshape(-1)))],
                names=["vec_id", "ints", "to_pivots"])

    kind = kept.schema["vec_id"].dataType.simpleString()
    points = kept.mapInArrow(cached, f"vec_id {kind}, ints array<int>, to_pivots array<bigint>").checkpoint()

    def assigned(batches, to):
        """(batch, its integers, clusters, distances) under the centroids ``to``."""
        of = simplex.apexes(simplex.distances(to)) if len(to) else None
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                rows = _matrix(part.column("ints"), np.int64)
                squared = _matrix(part.column("to_pivots"), np.int64)
                yield part, rows, *nearest(rows, simplex.apexes(squared), to, of, simplex.slack(squared))[:2]

    def summing(to):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums, n = np.zeros(to.shape, np.int64), np.zeros(len(to), np.int64)
            for _, rows, clusters, _ in assigned(batches, to):
                n += np.bincount(clusters, minlength=len(to))
                np.add.at(sums, clusters, rows)
            number, component = np.indices(to.shape).reshape(2, -1)
            held = n[number] > 0
            yield pa.record_batch(
                [pa.array(number[held], pa.int32()), pa.array(component[held], pa.int32()),
                 pa.array(sums.reshape(-1)[held]), pa.array(n[number][held])],
                names=["cluster", "component", "total", "n"])
        return run

    for _ in range(rounds if middle else 0):
        sums = points.select("ints", "to_pivots").mapInArrow(
            summing(np.array(middle, np.int64)), "cluster int, component int, total bigint, n bigint").groupBy(
            "cluster", "component").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
        for r in sums.collect():
            middle[r.cluster][r.component] = int(r.total) // r.n

    to = np.array(middle, np.int64).reshape(len(middle), dimensions)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, clusters, distances in assigned(batches, to):
            yield pa.record_batch([part.column("vec_id"), pa.array(clusters, pa.int32()), pa.array(distances, pa.int64())],
                                  names=["vec_id", "cluster", "distance"])

    result = points.mapInArrow(placed, f"vec_id {kind}, cluster int, distance bigint").checkpoint()
    inertia = {r.cluster: r.inertia for r in result.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    about = spark.createDataFrame(  # a row per centroid
        [(c, inertia.get(c, 0), sum(inertia.values()), v) for c, v in enumerate(middle)],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid array<bigint>")
    return result.join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")
