"""A forest as flat arrays, checked while it is laid out.

Imported by Python workers too, so it needs NumPy and Arrow only.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa

from ensemblescore.errors import ModelError


@dataclass(frozen=True)
class Forest:
    """Trees of one or many models as parallel arrays, one entry per node.

    The two children of a branch are neighbours, so a step down is
    ``first_child + (x >= threshold)``. A leaf is its own first child and its
    threshold is NaN, which no ``x`` reaches: a walk that has arrived stays put.
    """

    feature: np.ndarray        # intp
    threshold: np.ndarray      # float32
    first_child: np.ndarray    # intp
    missing_right: np.ndarray  # bool: a NaN goes to the second child
    value: np.ndarray          # float64
    root: np.ndarray           # intp, per tree
    group: np.ndarray          # intp, per tree
    depth: np.ndarray          # intp, per tree

    @cached_property
    def branches(self) -> np.ndarray:
        return ~np.isnan(self.threshold)

    @property
    def n_nodes(self) -> int:
        return len(self.feature)


def _column(table: pa.Table, name: str, dtype) -> np.ndarray:
    column = table.column(name)
    if column.null_count:
        _require(pa.types.is_integer(column.type), f"null in {name}")
        column = column.fill_null(-1)
    return column.to_numpy().astype(dtype)


def _require(ok, message: str) -> None:
    if not np.all(ok):
        raise ModelError(message)


def lay_out(trees: pa.Table, nodes: pa.Table, *, width: int, n_outputs) -> Forest:
    """Order nodes tree by tree, level by level, with sibling nodes side by side.

    ``n_outputs`` is one number, or one per row of ``trees`` if they belong to several models.
    """
    tree_id, group = _column(trees, "tree_id", np.int64), _column(trees, "tree_group", np.intp)
    order = np.argsort(tree_id, kind="stable")
    tree_id, group = tree_id[order], group[order]
    n_outputs = np.broadcast_to(n_outputs, len(order))[order]
    _require(len(tree_id) > 0, "the model has no trees")
    _require(np.diff(tree_id) > 0, "duplicate tree_id")
    _require((group >= 0) & (group < n_outputs), "tree_group outside the model's outputs")

    tree = np.searchsorted(tree_id, _column(nodes, "tree_id", np.int64))
    _require(tree < len(tree_id), "a node belongs to no tree")
    _require(tree_id[tree] == _column(nodes, "tree_id", np.int64), "a node belongs to no tree")
    node_id = _column(nodes, "node_id", np.int64)
    _require(node_id >= 0, "negative node_id")
    span = np.int64(max(node_id.max(initial=0), 0) + 1)
    order = np.argsort(tree * span + node_id, kind="stable")
    key = (tree * span + node_id)[order]
    _require(np.diff(key) > 0, "duplicate node_id in a tree")

    def col(name, dtype):
        return _column(nodes, name, dtype)[order]

    tree, branch = tree[order], col("branch", bool)
    _require(col("known_kind", bool), "a node has an unknown kind")
    n_children, feature = col("n_children", np.int64), col("split_feature", np.intp)
    threshold, value = col("split_threshold", np.float32), col("leaf_value", np.float32)
    _require(n_children == np.where(branch, 2, 0), "branches need two children and leaves none")
    _require(col("less_than", bool) | ~branch, "a branch has an unknown split_op")
    _require(~branch | ((feature >= 0) & (feature < width)), "split_feature outside the input width")
    _require(~branch | ~np.isnan(threshold), "a branch has a NaN threshold")
    children = np.stack([col("below", np.int64), col("otherwise", np.int64)], axis=1)
    default = col("default_child", np.int64)
    _require(~branch | (default == children[:, 0]) | (default == children[:, 1]),
             "default_child is not a child of its branch")

    def find(tree_of, wanted):
        """Row of node ``wanted`` in tree ``tree_of``."""
        _require((wanted >= 0) & (wanted < span), "a child does not exist")
        target = tree_of * span + wanted
        at = np.minimum(np.searchsorted(key, target), len(key) - 1)
        _require(key[at] == target, "a tree has no node 0 or a child does not exist")
        return at

    all_trees = np.arange(len(tree_id))
    _require(len(key) > 0, "the model has no nodes")
    frontier = find(all_trees, np.zeros(len(tree_id), np.int64))
    levels, seen, depth = [frontier], len(frontier), np.zeros(len(tree_id), np.intp)
    while True:
        parents = frontier[branch[frontier]]
        if not len(parents):
            break
        depth[tree[parents]] = len(levels)
        frontier = find(np.repeat(tree[parents], 2), children[parents].ravel())
        seen += len(frontier)
        _require(seen <= len(key), "a node has two parents or a tree has a cycle")
        levels.append(frontier)
    level_order = np.concatenate(levels)
    _require(len(level_order) == len(key) and len(np.unique(level_order)) == len(key),
             "a node cannot be reached from its root")

    rows = level_order[np.argsort(tree[level_order], kind="stable")]
    position = np.empty(len(key), np.intp)
    position[rows] = np.arange(len(key))
    first_child = position.copy()
    at = np.flatnonzero(branch)
    first_child[at] = position[find(tree[at], children[at, 0])]
    return Forest(
        feature=np.where(branch, feature, 0)[rows].astype(np.intp),
        threshold=np.where(branch, threshold, np.float32("nan"))[rows].astype(np.float32),
        first_child=first_child[rows],
        missing_right=(branch & (default == children[:, 1]))[rows],
        value=value[rows].astype(np.float64),
        root=position[levels[0]], group=group, depth=depth)
