"""A forest as SQL text: one CASE per branch, one sum per output."""

from __future__ import annotations

import math

import numpy as np

from ensemblescore.functions.forest import Forest


def float_literal(value) -> str:
    """A float32 as SQL text that reads back to the same float32."""
    number = np.float32(value)
    if not math.isfinite(number):
        return f"CAST('{float(number)}' AS FLOAT)"
    return f"{float(number)!r}F"


def double_literal(value) -> str:
    number = float(value)
    if not math.isfinite(number):
        return f"CAST('{number}' AS DOUBLE)"
    return f"{number!r}D"


def tree_sql(forest: Forest, first: int, last: int, feature_sql: list[str]) -> str:
    """The tree in nodes ``first`` to ``last - 1`` as one expression giving its leaf value.

    Children come after their parents in the layout, so one pass from the back
    finds every child already written.
    """
    text: dict[int, str] = {}
    for node in range(last - 1, first - 1, -1):
        if not forest.branches[node]:
            text[node] = double_literal(forest.value[node])
            continue
        x = feature_sql[forest.feature[node]]
        below = int(forest.first_child[node])
        holds = f"{x} < {float_literal(forest.threshold[node])}"
        if not forest.missing_right[node]:
            holds += f" OR isnan({x})"
        text[node] = f"CASE WHEN {holds} THEN {text.pop(below)} ELSE {text.pop(below + 1)} END"
    return text[first]


def output_sql(forest: Forest, n_outputs: int, feature_sql: list[str]) -> list[str]:
    """Per output, the sum of its trees in ascending tree order, in double."""
    ends = [*forest.root[1:], forest.n_nodes]
    sums = ["0.0D"] * n_outputs
    for first, last, group in zip(forest.root, ends, forest.group):
        sums[group] += f" + {tree_sql(forest, int(first), int(last), feature_sql)}"
    return sums
