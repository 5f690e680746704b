"""From summed trees to outputs: post transform, narrowing, argmax."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column
from pyspark.sql import functions as F

from ensemblescore.sources import schema as S

# Up to here softmax is spelled out and compiled; beyond, it is a higher-order function.
SPELLED_OUT = 16


def softmax(sums: Column, n: int | None = None) -> Column:
    """Softmax of an ``array<double>``, shifted by its maximum so that nothing overflows."""
    top = F.array_max(sums)
    if n is not None and n <= SPELLED_OUT:
        exps = [F.exp(F.get(sums, F.lit(k)) - top) for k in range(n)]
        total = exps[0]
        for e in exps[1:]:
            total = total + e
        return F.array(*[e / total for e in exps])
    exps = F.transform(sums, lambda s: F.exp(s - top))
    total = F.aggregate(exps, F.lit(0.0), lambda a, e: a + e)
    return F.transform(exps, lambda e: e / total)


def narrowed(sums: Column, post_transform: str, n: int | None = None) -> Column:
    """Outputs as ``array<float>``: the precision a model answers in."""
    outputs = softmax(sums, n) if post_transform == S.SOFTMAX else sums
    return outputs.cast("array<float>")


def argmax(outputs: Column) -> Column:
    """Index of the first maximum, as a double; a NaN counts as the greatest."""
    return (F.array_position(outputs, F.array_max(outputs)) - 1).cast("double")


def as_vector(outputs: Column) -> Column:
    return array_to_vector(outputs.cast("array<double>"))
