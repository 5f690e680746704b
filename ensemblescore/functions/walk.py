"""Vectorised descent: every row of a batch takes one step per level."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from ensemblescore.functions.forest import Forest


class Lookups:
    """Category lists by input, each indexed once per Python worker and not once per batch."""

    def __init__(self, categories: dict[int, tuple[str, ...]]):
        self.categories, self._codes = categories, {}

    def __getstate__(self):
        return self.categories

    def __setstate__(self, categories):
        self.__init__(categories)

    def codes(self, k: int, values: pa.Array) -> np.ndarray:
        """Position of each value among the categories of input ``k``; NaN if it is null or unknown."""
        if k not in self._codes:
            self._codes[k] = {c: float(i) for i, c in reversed(list(enumerate(self.categories[k])))}
        known, nan = self._codes[k], float("nan")
        coded = values.dictionary_encode()
        own = np.array([known.get(v, nan) for v in coded.dictionary.to_pylist()] + [nan], np.float32)
        return own[coded.indices.fill_null(len(own) - 1).to_numpy(zero_copy_only=False)]


def matrix(columns: tuple[pa.Array, ...], layout: list[tuple], lookups: Lookups) -> np.ndarray:
    """Input columns side by side as one ``(rows, width)`` float32 matrix."""
    n = len(columns[0])
    if len(layout) == 1 and layout[0][1]:
        return _vectors(columns[0], *layout[0][:2])
    out = np.empty((n, sum(width or 1 for _, width, _ in layout)), np.float32)
    at = 0
    for values, (name, width, looked_up) in zip(columns, layout):
        if width:
            out[:, at:at + width] = _vectors(values, name, width)
        elif looked_up is not None:
            out[:, at] = lookups.codes(looked_up, values)
        else:
            out[:, at] = values.to_numpy(zero_copy_only=False)
        at += width or 1
    return out


def _vectors(values: pa.Array, name: str, width: int) -> np.ndarray:
    sizes = np.diff(values.offsets.to_numpy())
    wrong = sizes != width
    if wrong.any():
        raise ValueError(f"column {name!r} holds a vector of {sizes[wrong][0]}, "
                         f"the model declares {width}")
    flat = values.flatten()
    if flat.null_count:
        flat = flat.fill_null(0.0)
    return flat.to_numpy(zero_copy_only=False).reshape(len(values), width)


class Rows:
    """A feature matrix prepared for lookups by (row, feature), with room to work in."""

    def __init__(self, features: np.ndarray):
        n, width = features.shape
        self._prepare(features.reshape(-1), np.arange(n, dtype=np.intp) * width)
        self.columns = np.ascontiguousarray(features.T)
        missing = np.isnan(self.flat)
        self.missing = missing if missing.any() else None

    def _prepare(self, flat: np.ndarray, start: np.ndarray) -> None:
        self.flat, self.start, self.n = flat, start, len(start)
        self.at = np.empty(self.n, np.intp)
        self.x, self.threshold = np.empty((2, self.n), np.float32)
        self.right = np.empty(self.n, bool)

    def subset(self, rows: np.ndarray) -> Rows:
        part = object.__new__(Rows)
        part._prepare(self.flat, self.start[rows])
        part.missing = self.missing
        return part


def descend(forest: Forest, rows: Rows, node: np.ndarray, depth: int) -> np.ndarray:
    """Leaf values reached from the start nodes, which are overwritten, in ``depth`` steps."""
    at, x, threshold, right = rows.at, rows.x, rows.threshold, rows.right
    for _ in range(depth):
        forest.feature.take(node, out=at, mode="clip")
        at += rows.start
        rows.flat.take(at, out=x, mode="clip")
        forest.threshold.take(node, out=threshold, mode="clip")
        np.greater_equal(x, threshold, out=right)
        if rows.missing is not None:
            right |= rows.missing.take(at) & forest.missing_right.take(node)
        forest.first_child.take(node, out=at, mode="clip")
        np.add(at, right, out=node)
    return forest.value.take(node)


def add_trees(forest: Forest, rows: Rows, sums: np.ndarray) -> None:
    """Add every tree of one model into ``sums[output]``, in ascending tree order.

    All rows meet the same root, so the first step compares one column with one number.
    """
    for root, group, depth in zip(forest.root, forest.group, forest.depth):
        if depth == 0:
            sums[group] += forest.value[root]
            continue
        column = rows.columns[forest.feature[root]]
        right = column >= forest.threshold[root]
        if rows.missing is not None and forest.missing_right[root]:
            right |= np.isnan(column)
        sums[group] += descend(forest, rows, forest.first_child[root] + right, int(depth) - 1)
