"""Trees in preorder, numbered level by level, for whole Arrow batches at once.

Imported by Python workers, so it needs NumPy and Arrow only.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from ensemblescore.errors import ModelError


@dataclass(frozen=True)
class Numbered:
    """Per entry: its node id within its tree, and the ids of its children, -1 for a leaf."""

    node: np.ndarray
    below: np.ndarray
    otherwise: np.ndarray


def number(leaf: np.ndarray, sizes: np.ndarray) -> Numbered:
    """Number trees that are given one after another in preorder, each with its number of nodes.

    A branch is followed by the tree below it and then by the other. Going along, a branch opens
    a place and a leaf closes one; the second child of a branch is the next entry of its tree that
    meets as many open places as the branch did. Levels are numbered from left to right, the root being 0.
    """
    n, ends = len(leaf), np.cumsum(sizes)
    if (sizes < 1).any():
        raise ModelError("a tree has no nodes")
    tree = np.repeat(np.arange(len(sizes)), sizes)
    steps = np.where(leaf, -1, 1)
    total = np.concatenate([[0], np.cumsum(steps)])
    first = ends - sizes
    # Places open before each entry; a whole tree closes the one it began with, and none before its end.
    open_ = total[:-1] - total[first][tree]
    after = open_ + steps
    last = np.zeros(n, bool)
    last[ends - 1] = True
    if ((after < 0) != last).any():
        raise ModelError("a tree is not in preorder: it ends too early or too late")

    order = np.lexsort((np.arange(n), open_, tree))
    follows = np.full(n, -1)
    same = (tree[order[1:]] == tree[order[:-1]]) & (open_[order[1:]] == open_[order[:-1]])
    follows[order[:-1][same]] = order[1:][same]

    branch = np.flatnonzero(~leaf)
    depth, frontier, level = np.zeros(n, np.int64), first[~leaf[first]], 0
    while len(frontier):  # the branches of a level
        level += 1
        children = np.concatenate([frontier + 1, follows[frontier]])
        depth[children] = level
        frontier = children[~leaf[children]]
    order = np.lexsort((np.arange(n), depth, tree))
    node = np.empty(n, np.int64)
    node[order] = np.arange(n) - first[tree]
    below, otherwise = np.full(n, -1), np.full(n, -1)
    below[branch], otherwise[branch] = node[branch + 1], node[follows[branch]]
    return Numbered(node, below, otherwise)
