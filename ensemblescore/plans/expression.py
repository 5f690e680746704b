"""Small forests as SQL expressions: no Python worker, inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ensemblescore.functions import coerce
from ensemblescore.functions.trees import output_sql
from ensemblescore.operators.inputs import BoundInput
from ensemblescore.functions.forest import Forest


def add_sums(df: DataFrame, bound: list[BoundInput], forest: Forest, n_outputs: int,
             name: str) -> DataFrame:
    """Append ``name``: the sums as ``array<double>``, or a plain double for one output."""
    staged, features = [], []
    for k, item in enumerate(bound):
        staged.append(item.floats.alias(f"{name}_in{k}"))
        source = f"`{name}_in{k}`"
        features += ([f"coalesce(get({source}, {i}), 0.0F)" for i in range(item.width)]
                     if item.spec.is_vector else [source])
    df = df.select("*", *staged)
    sums = [F.expr(s) for s in output_sql(forest, n_outputs, features)]
    return df.select("*", _checked(df, bound, name, sums))


def _checked(df: DataFrame, bound: list[BoundInput], name: str, sums: list[Column]) -> Column:
    """The sums, behind one width test per vector input."""
    result = sums[0] if len(sums) == 1 else F.array(*sums)
    for k, item in enumerate(bound):
        if item.spec.is_vector:
            size = F.size(F.col(f"{name}_in{k}"))
            result = F.when(size == item.width, result).otherwise(
                coerce.wrong_width(item.column, size, item.width))
    return result.alias(name)
