"""Trees of a registry of any size, looked over in one pass.

One shuffle brings a tree's nodes together and in order, and an Arrow function goes through them: it
looks at all whole trees of a batch at once and holds back only the last one. A tree larger than a
task should hold is only named there; its structure is looked at by joins, level by level from the root.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ensemblescore.operators.depths import NODE, edges
from ensemblescore.sources import schema as S
from ensemblescore.sources.scratch import ensure_checkpoint_dir
from ensemblescore.sources.tables import beside

TREE = ["model_id", "tree_id"]
FOUND = "model_id string, tree_id int, node_id int, rule string, value int"
_FOUND = pa.schema([("model_id", pa.string()), ("tree_id", pa.int32()), ("node_id", pa.int32()),
                    ("rule", pa.string()), ("value", pa.int32())])

#: Nodes of one tree that a task holds.
MAX_TREE_NODES = 2_000_000

#: Not rules: a tree too large to hold, and a feature of a tree that no list has, so that its width is not at hand.
LARGE, FEATURE = "?large", "?feature"

#: Stands for a node id that is null.
_NULL = -1 << 31


def tree_violations(nodes: DataFrame, listed: DataFrame, limits: DataFrame, faults: Column,
                    n_models: int) -> DataFrame:
    """``model_id, tree_id, node_id, rule`` for what is wrong with nodes and the shape of trees.

    ``listed`` has a row per listed tree, ``limits`` the ``width`` of each of some ``n_models`` models, ``faults`` the rules that
    a node breaks by itself. ``nodes`` is scanned once, and again only if some tree is too large."""
    ensure_checkpoint_dir(nodes.sparkSession)
    none, widths = F.lit(None), beside(limits.select("model_id", "width"), n_models)
    heads = listed.select(*TREE).distinct().join(widths, "model_id", "left").select(
        *TREE, F.lit(0).alias("kind"), none.cast("int").alias("node_id"), F.lit(False).alias("branch"),
        none.cast("array<int>").alias("children"), none.cast("int").alias("feature"),
        F.col("width").cast("int").alias("width"), none.cast("array<string>").alias("faults"))
    rows = nodes.select(
        *TREE, F.lit(1).alias("kind"), "node_id", F.coalesce(F.col("kind") == S.BRANCH, F.lit(False)).alias("branch"),
        "children", F.col("split_feature").alias("feature"), none.cast("int").alias("width"), faults.alias("faults"))
    found = heads.unionByName(rows).repartition(*TREE).sortWithinPartitions(*TREE, "kind", "node_id").mapInArrow(
        _looked_over(MAX_TREE_NODES), FOUND).checkpoint()
    rules = found.where(~F.col("rule").isin(LARGE, FEATURE)).drop("value")
    features = found.where(F.col("rule") == FEATURE).join(widths, "model_id", "left").where(
        ~F.coalesce(F.col("value").between(0, F.col("width") - 1), F.lit(False))).select(
        *NODE, F.lit("bad_split_feature").alias("rule"))
    result = rules.unionByName(features)
    large = found.where(F.col("rule") == LARGE).select(*TREE)
    if not large.isEmpty():
        result = result.unionByName(_by_joins(nodes.join(F.broadcast(large), TREE, "left_semi")))
    return result


def _looked_over(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, skipped = None, None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            if skipped is not None:
                own = _same_tree(rows, skipped[0])
                if own:
                    yield from _out(_of_nodes(rows.slice(0, own), skipped[1]))
                    rows = rows.slice(own)
                if not rows.num_rows:
                    continue
                skipped = None
            if held is not None:
                rows = pa.concat_tables([held, rows])
            if not rows.num_rows:
                continue
            rows = rows.combine_chunks()
            last = int(_firsts(rows)[-1])
            if last:
                yield from _out(_whole(rows.slice(0, last).combine_chunks()))
            held = rows.slice(last)
            if held.num_rows > most:
                yield from _out(_whole(held.combine_chunks(), shape=False))
                width = held["width"][0].as_py() if held["kind"][0].as_py() == 0 else _NULL
                skipped, held = ([held[c][0].as_py() for c in TREE], width), None
        if held is not None and held.num_rows:
            yield from _out(_whole(held.combine_chunks()))
    return run


def _same_tree(rows: pa.Table, key: list) -> int:
    """How many rows at the beginning belong to the tree ``key``."""
    same = np.ones(rows.num_rows, bool)
    for c, v in zip(TREE, key):
        equal = rows[c].is_null() if v is None else pc.fill_null(pc.equal(rows[c], pa.scalar(v, rows[c].type)), False)
        same &= equal.combine_chunks().to_numpy(zero_copy_only=False)
    return int(np.argmin(same)) if not same.all() else rows.num_rows


def _firsts(rows: pa.Table) -> np.ndarray:
    """Where trees begin among sorted rows."""
    new = np.zeros(rows.num_rows, bool)
    new[:1] = True
    for c in TREE:
        codes = rows[c].chunk(0).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        new[1:] |= codes[1:] != codes[:-1]
    return np.flatnonzero(new)


def _out(parts: list[tuple[pa.Table, np.ndarray, np.ndarray, str, np.ndarray | None]]) -> Iterator[pa.RecordBatch]:
    """Result rows from (rows, which of them name the tree, node ids, rule, value)."""
    for rows, at, node, rule, value in parts:
        if not len(at):
            continue
        take, n = pa.array(at), len(at)
        node = np.asarray(node, np.int64)
        yield pa.record_batch([
            *(rows[c].combine_chunks().take(take).cast(_FOUND.field(c).type) for c in TREE),
            pa.array(node, pa.int32(), mask=node == _NULL), pa.array([rule] * n),
            pa.array(np.zeros(n) if value is None else value, pa.int32())], schema=_FOUND)


def _ints(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.int64()), _NULL).to_numpy(zero_copy_only=False)


def _of_nodes(rows: pa.Table, width) -> list[tuple]:
    """What nodes break by themselves: rules found before, and features outside their model's inputs.

    ``width`` is one number, null or unlisted (``_NULL``), or one per row."""
    node, found = _ints(rows["node_id"]), []
    faults = rows["faults"].combine_chunks()
    sizes = pc.fill_null(pc.list_value_length(faults), 0).to_numpy(zero_copy_only=False)
    if sizes.any():
        at, names = np.repeat(np.arange(rows.num_rows), sizes), faults.flatten().to_numpy(zero_copy_only=False)
        for rule in np.unique(names.astype(str)):
            mine = at[names == rule]
            found.append((rows, mine, node[mine], str(rule), None))
    branch = rows["branch"].combine_chunks().to_numpy(zero_copy_only=False).astype(bool)
    feature = _ints(rows["feature"])
    if not isinstance(width, np.ndarray):
        width = np.full(rows.num_rows, -1 if width is None else width)
    unlisted = np.flatnonzero(branch & (width == _NULL))
    found.append((rows, unlisted, node[unlisted], FEATURE, np.maximum(feature[unlisted], -1)))
    bad = np.flatnonzero(branch & (width != _NULL) & ((feature < 0) | (feature >= width)))
    found.append((rows, bad, node[bad], "bad_split_feature", None))
    return found


def _whole(rows: pa.Table, shape: bool = True) -> list[tuple]:
    """What is wrong with whole trees, or with the beginning of a large one if not ``shape``."""
    firsts = _firsts(rows)
    tree = np.repeat(np.arange(len(firsts)), np.diff(np.append(firsts, rows.num_rows)))
    is_node = rows["kind"].combine_chunks().to_numpy(zero_copy_only=False) == 1
    listed = ~is_node[firsts]
    widths = pc.fill_null(rows["width"].combine_chunks().take(pa.array(firsts)), -1).to_numpy(zero_copy_only=False)
    widths = np.where(listed, widths, _NULL)
    at = np.flatnonzero(is_node)
    node, of = _ints(rows["node_id"])[at], tree[at]
    found = _of_nodes(rows.filter(pa.array(is_node)), widths[of])
    # The smallest id of a tree, nulls apart, is that of its root.
    least = np.full(len(firsts), np.iinfo(np.int64).max)
    np.minimum.at(least, of[node != _NULL], node[node != _NULL])
    trees = np.arange(len(firsts))
    found += [(rows, firsts[bad], np.full(len(bad), _NULL), rule, None) for rule, bad in (
        ("no_root", trees[least != 0]), ("unlisted_tree", trees[~listed]))]
    if not shape:
        return [*found, (rows, firsts[:1], np.array([_NULL]), LARGE, None)]

    key = of << 33 | (node - _NULL)
    ids, first, copies = np.unique(key, return_index=True, return_counts=True)
    twice = first[copies > 1]
    found.append((rows, at[twice], node[twice], "duplicate_node", None))

    branch = rows["branch"].combine_chunks().to_numpy(zero_copy_only=False).astype(bool)
    lists = rows["children"].combine_chunks()
    sizes = np.where(branch, pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False), 0)
    child = _ints(lists.filter(pa.array(branch)).flatten())
    parent = np.repeat(np.arange(rows.num_rows), sizes)
    to = tree[parent] << 33 | (child - _NULL)
    own = _ints(rows["node_id"])[parent]
    order = np.lexsort((own, to))
    children, begin, n = np.unique(to[order], return_index=True, return_counts=True)
    up, where = own[order][begin], parent[order][begin]
    name, of_child = (children & ((1 << 33) - 1)) + _NULL, children >> 33
    place = np.searchsorted(ids, children)
    there = (name != _NULL) & (np.append(ids, -1)[np.minimum(place, len(ids))] == children)
    found += [(rows, where[bad], name[bad], rule, None) for rule, bad in (
        ("missing_child", ~there), ("two_parents", n > 1), ("root_has_parent", (name == 0) | (name == _NULL)))]

    # From each node up its smallest parent, twice as far each time; the last place is for the lost.
    lost = len(ids)
    above = np.full(lost + 1, lost)
    above[place[there]] = np.searchsorted(ids, of_child[there] << 33 | (up[there] - _NULL))
    root = (ids & ((1 << 33) - 1)) == -_NULL
    above[:-1][root] = np.flatnonzero(root)
    for _ in range(max(1, int(np.ceil(np.log2(lost + 1))))):
        if (above[above] == above).all():
            break
        above = above[above]
    bad = np.flatnonzero(~np.append(root, False)[above[:-1]])
    found.append((rows, at[first][bad], (ids[bad] & ((1 << 33) - 1)) + _NULL, "unreachable", None))
    return found


def _by_joins(nodes: DataFrame) -> DataFrame:
    """The shape of trees larger than a task: counts and equi-joins on nodes, and a frontier from the roots.

    A round's keys are the nodes of one level, each met by its own children only, so none is hot. There
    are as many rounds as the deepest such tree has levels."""
    def named(df, rule):
        return df.select(*NODE, F.lit(rule).alias("rule"))

    twice = nodes.groupBy(*NODE).count().where("count > 1")
    children = edges(nodes).groupBy(*NODE).agg(F.count("*").alias("parents"), F.min("parent").alias("parent")).checkpoint()
    present = nodes.select(*NODE).distinct().withColumn("present", F.lit(True)).checkpoint()
    met = children.join(present, NODE, "left")
    level = present.where("node_id = 0").select(*NODE)
    levels = [level]
    while not level.isEmpty():
        level = level.select(*TREE, F.col("node_id").alias("parent")).join(
            children.where("node_id != 0"), [*TREE, "parent"]).select(*NODE).checkpoint()
        levels.append(level)
    reached = levels[0]
    for level in levels[1:]:
        reached = reached.unionByName(level)
    return named(twice, "duplicate_node").unionByName(
        named(met.where("present IS NULL"), "missing_child")).unionByName(
        named(children.where("parents > 1"), "two_parents")).unionByName(
        named(children.where("node_id = 0 OR node_id IS NULL"), "root_has_parent")).unionByName(
        named(present.join(reached, NODE, "left_anti"), "unreachable"))
