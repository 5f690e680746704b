"""Compare two scorings of the same rows."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ensemblescore.errors import InputError
from ensemblescore.functions.coerce import column
from ensemblescore.functions.post import argmax
from ensemblescore.sources.scratch import ensure_checkpoint_dir

#: Ranks of one value made at once.
RANKS = 1 << 16


def _difference(a: Column, b: Column) -> Column:
    """Absolute difference; equal infinities and two NaNs differ by 0, one NaN by infinity."""
    return F.when(a == b, F.lit(0.0)).when(
        F.isnan(a) | F.isnan(b), F.lit(float("inf"))).otherwise(F.abs(a - b))


def _null_safe(a: Column, b: Column, difference) -> Column:
    """Two missing outputs differ by 0, one missing by infinity."""
    return F.when(a.isNull() & b.isNull(), F.lit(0.0)).when(
        a.isNull() | b.isNull(), F.lit(float("inf"))).otherwise(difference(a, b))


def _largest_difference(a: Column, b: Column) -> Column:
    """The same over two arrays; unequal lengths differ by infinity."""
    return F.when(F.size(a) != F.size(b), F.lit(float("inf"))).otherwise(
        F.array_max(F.zip_with(a, b, _difference)))


def _ranks(runs: DataFrame, before: Column, count: str, until: Column, *keep: Column) -> DataFrame:
    """One row for each of the ``count`` places of a value among its side's sorted outputs."""
    end = before + until
    start = end - F.col(count)
    steps = F.explode(F.sequence(F.floor(start / RANKS), F.floor((end - 1) / RANKS)))
    return runs.where(F.col(count) > 0).select(*keep, start.alias("start"), end.alias("end"), steps.alias("step")).select(
        "*", F.explode(F.sequence(F.greatest("start", F.col("step") * RANKS),
                                  F.least("end", (F.col("step") + 1) * RANKS) - 1)).alias("rank")).drop("start", "end", "step")


def _matched(runs: DataFrame, names: list[str], compare) -> DataFrame:
    """``diff`` of every key of (names, value, more_a, more_b), its outputs paired in sorted order.

    Every key has as many outputs on one side as on the other, so places counted over all
    keys pair the same keys, and ranges of keys and values are counted apart."""
    order = [*names, "value"]
    placed = runs.repartitionByRange(*order).withColumn("chunk", F.spark_partition_id()).checkpoint()
    sizes = {r["chunk"]: r for r in placed.groupBy("chunk").agg(
        F.sum("more_a").alias("a"), F.sum("more_b").alias("b")).collect()}
    window = Window.partitionBy("chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    placed = placed.withColumn("until_a", F.sum("more_a").over(window)).withColumn(
        "until_b", F.sum("more_b").over(window))

    def before(side):
        sums, total = [], 0
        for chunk in range(max(sizes, default=0) + 1):
            sums.append(F.lit(total).cast("bigint"))
            total += sizes[chunk][side] if chunk in sizes else 0
        return F.element_at(F.array(*sums), F.col("chunk") + 1)

    a = _ranks(placed, before("a"), "more_a", F.col("until_a"), *map(F.col, names), F.col("value").alias("a"))
    b = _ranks(placed, before("b"), "more_b", F.col("until_b"), F.col("value").alias("b"))
    return a.join(b, "rank").groupBy(*names).agg(F.max(compare(F.col("a"), F.col("b"))).alias("diff"))


def _aligned(runs: DataFrame, names: list[str], tolerance: float) -> DataFrame:
    """One row: ``unmatched_outputs`` and ``max_aligned_diff`` of (names, value, more_a, more_b).

    Outputs of a key are paired within the tolerance, as many as can be. Sorted outputs farther apart than the
    tolerance never meet, so a key is cut at such gaps and its segments go to tasks of their own, where
    one pass in order holds only what is still within reach."""
    order = [*names, "value"]
    beyond = F.isnan("value") | (F.abs("value") == float("inf"))  # equal ones are settled, others meet nothing
    lost = runs.where(beyond).select((F.col("more_a") + F.col("more_b")).alias("unmatched"), F.lit(None).cast("double").alias("most"))
    placed = runs.where(~beyond).repartitionByRange(*order).withColumn("chunk", F.spark_partition_id()).checkpoint()
    window = Window.partitionBy("chunk").orderBy(*order)
    before = F.lag(F.struct(*order)).over(window)
    same = F.lit(True)
    for k in names:
        same = same & F.col(k).eqNullSafe(F.col("before")[k])
    near = F.coalesce(F.col("before").isNotNull() & same & (F.col("value") - F.col("before")["value"] <= tolerance), F.lit(False))
    marked = placed.withColumn("before", before).withColumn("opens", F.when(near, 0).otherwise(1)).drop("before")
    marked = marked.withColumn("local", F.sum("opens").over(window.rowsBetween(Window.unboundedPreceding, 0)))

    # A chunk may go on with the last segment of the one before: one row per chunk tells.
    edges = {r["chunk"]: r for r in marked.groupBy("chunk").agg(
        F.min(F.struct(*order)).alias("first"), F.max(F.struct(*order)).alias("last"), F.max("local").alias("n")).collect()}
    offsets, total, last = [], 0, None
    for chunk in range(max(edges, default=-1) + 1):
        if chunk in edges:
            e = edges[chunk]
            goes_on = (last is not None and [e["first"][k] for k in names] == [last[k] for k in names]
                       and e["first"]["value"] - last["value"] <= tolerance)
            total -= goes_on
            offsets.append(total)
            total, last = total + e["n"], e["last"]
        else:
            offsets.append(total)
    if offsets:
        marked = marked.withColumn("segment", F.col("local") + F.element_at(
            F.array(*[F.lit(o).cast("bigint") for o in offsets]), F.col("chunk") + 1))
        paired = marked.select("segment", "value", "more_a", "more_b").repartition("segment").sortWithinPartitions(
            "segment", "value").mapInArrow(_paired_in_order(tolerance), "unmatched bigint, most double")
        lost = lost.unionByName(paired)
    return lost.agg(F.coalesce(F.sum("unmatched"), F.lit(0)).cast("long").alias("unmatched_outputs"),
                    F.max("most").alias("max_aligned_diff"))


def _short_segments(batch: pa.RecordBatch) -> tuple[float | None, int, pa.RecordBatch]:
    """Segments of one or two values settled at once: the largest difference met, the rows unmatched, and all other rows.

    The first and the last segment may go on in other batches and are among the others."""
    segment, value, a, b = (c.to_numpy() for c in batch.columns)
    starts = np.flatnonzero(np.append(True, segment[1:] != segment[:-1])) if len(segment) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(starts, len(segment)))
    inner = np.ones(len(starts), bool)
    inner[:1] = inner[-1:] = False
    one, two = starts[inner & (sizes == 1)], starts[inner & (sizes == 2)]
    n = np.where(a > 0, a, b)  # a value is left over on one side only
    across = (a[two] > 0) != (a[two + 1] > 0)
    pairs = two[across]
    met = np.minimum(n[pairs], n[pairs + 1])
    lost = int(n[one].sum() + n[two].sum() + n[two + 1].sum() - 2 * met.sum())
    rest = np.ones(len(segment), bool)
    rest[one] = rest[two] = rest[two + 1] = False
    most = float((value[pairs + 1] - value[pairs]).max()) if len(pairs) else None
    return most, lost, batch.filter(pa.array(rest))


def _paired_in_order(tolerance: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, side, current = deque(), 0, None  # values of one side that wait, with how many rows
        unmatched, most = 0, None
        for batch in batches:
            met, lost, rest = _short_segments(batch)
            unmatched += lost
            most = met if most is None else most if met is None else max(most, met)
            for segment, value, a, b in zip(*(c.to_pylist() for c in rest.columns)):
                if segment != current:
                    unmatched += sum(n for _, n in open_)
                    open_.clear()
                    current = segment
                own, n = (1, a) if a else (-1, b)  # a value is left over on one side only
                if open_ and own != side:
                    while open_ and n:
                        first, held = open_[0]
                        if value - first > tolerance:
                            unmatched += held
                            open_.popleft()
                            continue
                        met = min(held, n)
                        most, n = max(most or 0.0, value - first), n - met
                        if met == held:
                            open_.popleft()
                        else:
                            open_[0] = (first, held - met)
                if n:
                    side = own
                    open_.append((value, n))
        unmatched += sum(n for _, n in open_)
        yield pa.record_batch([pa.array([unmatched], pa.int64()), pa.array([most], pa.float64())], names=["unmatched", "most"])
    return run


def _classes(runs: DataFrame, names: list[str]) -> DataFrame:
    """``disagree`` of every key: whether one side has some argmax more often."""
    per_class = runs.groupBy(*names, argmax(F.col("value")).alias("top")).agg(
        F.sum(F.col("more_a") - F.col("more_b")).alias("more"))
    return per_class.groupBy(*names).agg(F.max(F.col("more") != 0).alias("disagree"))


def parity_report(left: DataFrame, right: DataFrame, keys: list[str], *,
                  output: str = "prediction", tolerance: float = 1e-5,
                  count_outputs: bool = False, align_uneven: bool = False) -> DataFrame:
    """One row: how many keys met, how far their outputs differ, how many argmaxes disagree.

    Both sides are reduced per key and output before they meet, so a key held by many rows
    is counted in ``repeated_keys`` instead of being paired with itself. Outputs that a key
    has equally often on both sides are settled; what is left is paired in sorted order, vectors
    by their first unequal component, and argmaxes disagree if one is more frequent. A key with more rows on one side is
    in ``uneven_keys``; its smallest and largest outputs are compared. With ``count_outputs``
    there is one more column, ``differing_outputs``: the pairs of key and output that one
    side has more often, exactly. With ``align_uneven``, for outputs that are numbers, there are two more:
    the outputs of uneven keys are paired within the tolerance, as many as can be; ``unmatched_outputs``
    counts the rows left and ``max_aligned_diff`` is the largest difference of a pair, equal outputs apart.
    Outputs are reduced, once, when this is called.
    """
    ensure_checkpoint_dir(left.sparkSession)
    for df, side in ((left, "left"), (right, "right")):
        missing = [c for c in [*keys, output] if c not in df.columns]
        if missing:
            raise InputError(f"the {side} side lacks {missing}")

    vectors = [isinstance(df.schema[output].dataType, VectorUDT) for df in (left, right)]
    if vectors[0] != vectors[1]:
        raise InputError(f"{output!r} is a vector on one side only")
    vector = vectors[0]
    if vector and align_uneven:
        raise InputError("vectors have no order to align them in")
    dtype = "array<double>" if vector else "double"

    def tagged(df, mine, other):
        key = [column(k).alias(f"k{i}") for i, k in enumerate(keys)]
        outputs = vector_to_array(column(output)) if vector else column(output).cast("double")
        return df.select(
            *key, outputs.alias(mine), F.lit(None).cast(dtype).alias(other),
            F.lit(1).alias(f"in_{mine}"), F.lit(0).alias(f"in_{other}"))

    both = tagged(left, "a", "b").unionByName(tagged(right, "b", "a"))
    names = [f"k{i}" for i in range(len(keys))]
    per_output = both.groupBy(*names, F.coalesce("a", "b").alias("value")).agg(
        F.sum("in_a").alias("in_a"), F.sum("in_b").alias("in_b")).checkpoint()
    value = F.col("value")

    def left_over(mine, other):
        return F.when(F.col(mine) > F.col(other), value)

    per_key = per_output.groupBy(*names).agg(
        F.sum("in_a").alias("n_a"), F.sum("in_b").alias("n_b"),
        F.sum(F.when(value.isNotNull(), F.col("in_a")).otherwise(0)).alias("valued_a"),
        F.sum(F.when(value.isNotNull(), F.col("in_b")).otherwise(0)).alias("valued_b"),
        F.count_if(F.col("in_a") != F.col("in_b")).alias("differing"),
        *[F.count(left_over(f"in_{s}", f"in_{o}")).alias(f"runs_{s}") for s, o in ("ab", "ba")],
        *[f(F.when(F.col(f"in_{s}") > 0, value)).alias(f"all_{n}_{s}")
          for s in "ab" for n, f in (("min", F.min), ("max", F.max))],
        *[f(left_over(f"in_{s}", f"in_{o}")).alias(f"left_{n}_{s}")
          for s, o in ("ab", "ba") for n, f in (("min", F.min), ("max", F.max))])
    even = F.col("n_a") == F.col("n_b")
    # One value against several numbers differs most at their ends; one against one, anyhow.
    several = (F.greatest if vector else F.least)("runs_a", "runs_b") > 1
    paired = even & (F.col("valued_a") == F.col("valued_b")) & several
    per_key = per_key.select(
        *names, "n_a", "n_b", "valued_a", "valued_b", "differing", paired.alias("paired"),
        *[F.when(even, F.col(f"left_{n}_{s}")).otherwise(F.col(f"all_{n}_{s}")).alias(f"{n}_{s}")
          for s in "ab" for n in ("min", "max")])
    met = (F.col("n_a") > 0) & (F.col("n_b") > 0)
    compare = _largest_difference if vector else _difference
    uneven_nulls = (F.col("n_a") == F.col("n_b")) & (F.col("valued_a") != F.col("valued_b"))
    diff = F.when(met, F.when(uneven_nulls, F.lit(float("inf"))).otherwise(F.greatest(
        _null_safe(F.col("min_a"), F.col("min_b"), compare),
        _null_safe(F.col("max_a"), F.col("max_b"), compare))))
    disagree = F.lit(False)
    if vector:
        disagree = met & F.col("min_a").isNotNull() & F.col("min_b").isNotNull() & ((argmax(F.col("min_a")) != argmax(F.col("min_b")))
                          | (argmax(F.col("max_a")) != argmax(F.col("max_b"))))

    def total(test):
        return F.coalesce(F.sum(F.when(test, 1).otherwise(0)), F.lit(0)).cast("long")

    found = per_key.select("n_a", "n_b", "differing", met.alias("met"),
                           F.when(~F.col("paired"), diff).alias("diff"),
                           (~F.col("paired") & F.coalesce(disagree, F.lit(False))).alias("disagree"))
    same = F.lit(True)
    for k in names:
        same = same & F.col(k).eqNullSafe(F.col(f"p{k}"))

    # Outputs that one side has more often, of keys to pair or to align: kept, since range sorts read them twice.
    uneven = met & (F.col("n_a") != F.col("n_b")) if align_uneven else F.lit(False)
    use = F.when(F.col("paired"), "pair").when(uneven, "align")
    keyed = per_key.select(*[F.col(k).alias(f"p{k}") for k in names], use.alias("use")).where("use IS NOT NULL")
    kept = per_output.where(value.isNotNull() & (F.col("in_a") != F.col("in_b"))).join(keyed.hint("merge"), same).select(
        *names, "value", *[F.greatest(F.col(f"in_{s}") - F.col(f"in_{o}"), F.lit(0)).cast("bigint").alias(f"more_{s}")
                           for s, o in ("ab", "ba")], "use").checkpoint()

    def leftovers(which):
        return kept.where(F.col("use") == which).drop("use")

    runs = leftovers("pair")
    found = found.unionByName(_matched(runs, names, compare).select("diff"), allowMissingColumns=True)
    if vector:
        found = found.unionByName(_classes(runs, names).select("disagree"), allowMissingColumns=True)
    report = found.agg(
        F.coalesce(F.sum("n_a"), F.lit(0)).cast("long").alias("rows_left"),
        F.coalesce(F.sum("n_b"), F.lit(0)).cast("long").alias("rows_right"),
        total(F.col("met")).alias("keys_met"),
        total(F.col("n_b") == 0).alias("only_left"),
        total(F.col("n_a") == 0).alias("only_right"),
        total((F.col("n_a") > 1) | (F.col("n_b") > 1)).alias("repeated_keys"),
        total(F.col("met") & (F.col("n_a") != F.col("n_b"))).alias("uneven_keys"),
        *([F.coalesce(F.sum("differing"), F.lit(0)).cast("long").alias("differing_outputs")]
          if count_outputs else []),
        F.max("diff").alias("max_abs_diff"),
        total(F.col("diff") > tolerance).alias("over_tolerance"),
        total(F.col("disagree")).alias("argmax_disagreements"))
    if align_uneven:  # one row beside one row
        aligned = _aligned(leftovers("align"), names, tolerance)
        report = report.withColumn("one", F.lit(1)).join(aligned.withColumn("one", F.lit(1)), "one").drop("one")
    return report
