"""Every rule is broken once; a sound model breaks none; loading refuses the same models."""

import pytest

import ensemblescore as es
from ensemblescore import ModelError, ModelTables, violations
from ensemblescore.operators.depths import node_depths
from ensemblescore.sources.spec import load_spec

NODE = ("model_id", "tree_id", "node_id", "kind", "split_feature", "split_op", "split_threshold",
        "children", "default_child", "leaf_value")


def sound():
    return es.model_rows("m", [es.scalar("a"), es.category("s", ["x"])],
                         [es.stump(0, 0.5, 1, 2), es.constant(3)], groups=[0, 1])


def patched(table, row, **changes):
    rows = sound()
    names = {"header": ("model_id", "aggregation", "post_transform", "n_outputs", "output_names"),
             "inputs": ("model_id", "ordinal", "name", "dtype", "shape", "categories"),
             "trees": ("model_id", "tree_id", "tree_group"), "nodes": NODE}[table]
    values = dict(zip(names, rows[table][row]), **changes)
    rows[table][row] = tuple(values[n] for n in names)
    return rows


def without(table, row):
    rows = sound()
    del rows[table][row]
    return rows


def doubled(table, row):
    rows = sound()
    rows[table].append(rows[table][row])
    return rows


def ring():
    """Nodes 3 and 4 hang on each other."""
    rows = sound()
    for node, child in ((3, 4), (4, 3)):
        rows["nodes"].append(("m", 0, node, "BRANCH", 0, "LESS_THAN", 0.0, [child, child + 100],
                              child, 0.0))
    return rows


BROKEN = [
    (patched("header", 0, aggregation="MEAN"), {("unknown_aggregation", None, None)}),
    (patched("header", 0, post_transform="LOGIT"), {("unknown_post_transform", None, None)}),
    (doubled("header", 0), {("duplicate_model", None, None)}),
    (without("header", 0), {("no_header", None, None), ("bad_tree_group", 0, None),
                            ("bad_tree_group", 1, None)}),
    (patched("inputs", 0, dtype="INT8"), {("unknown_dtype", None, None)}),
    (patched("inputs", 0, shape=[-1, 0]), {("bad_shape", None, None)}),
    (patched("inputs", 1, categories=None), {("no_categories", None, None)}),
    (patched("inputs", 1, ordinal=0), {("duplicate_input", None, None)}),
    (doubled("trees", 0), {("duplicate_tree", 0, None)}),
    (patched("trees", 1, tree_group=2), {("bad_tree_group", 1, None)}),
    (patched("trees", 1, tree_group=-1), {("bad_tree_group", 1, None)}),
    (without("trees", 1), {("unlisted_tree", 1, None)}),
    (without("nodes", 3), {("no_root", 1, None)}),
    (patched("nodes", 0, kind="TWIG"), {("unknown_kind", 0, 0), ("unreachable", 0, 1),
                                        ("unreachable", 0, 2)}),
    (patched("nodes", 0, split_op="EQUAL"), {("unknown_split_op", 0, 0)}),
    (patched("nodes", 0, split_feature=2), {("bad_split_feature", 0, 0)}),
    (patched("nodes", 0, split_threshold=float("nan")), {("nan_threshold", 0, 0)}),
    (patched("nodes", 0, default_child=0), {("bad_default_child", 0, 0)}),
    (patched("nodes", 0, children=[1, 9]), {("missing_child", 0, 9), ("bad_default_child", 0, 0),
                                            ("unreachable", 0, 2)}),
    (patched("nodes", 0, children=[1, 1]), {("two_parents", 0, 1), ("bad_default_child", 0, 0),
                                            ("unreachable", 0, 2)}),
    (patched("nodes", 0, children=[0, 2]), {("root_has_parent", 0, 0), ("unreachable", 0, 1)}),
    (patched("nodes", 0, children=[1]), {("branch_without_two_children", 0, 0),
                                         ("bad_default_child", 0, 0), ("unreachable", 0, 2)}),
    (patched("nodes", 1, children=[2]), {("leaf_has_children", 0, 1)}),
    (doubled("nodes", 1), {("duplicate_node", 0, 1)}),
    (ring(), {("unreachable", 0, 3), ("unreachable", 0, 4), ("missing_child", 0, 103),
              ("missing_child", 0, 104)}),
]


def renamed(rows, model_id):
    return {name: [(model_id, *r[1:]) for r in table] for name, table in rows.items()}


def test_every_rule_once_and_a_sound_model(spark):
    """All broken models in one registry: the check is one job for any number of models."""
    models = [renamed(rows, f"b{k}") for k, (rows, _) in enumerate(BROKEN)]
    tables = ModelTables.from_rows(spark, es.merge_rows(renamed(sound(), "good"), *models))
    found = {}
    for r in violations(tables).collect():
        found.setdefault(r.model_id, set()).add((r.rule, r.tree_id, r.node_id))
    assert "good" not in found
    assert found == {f"b{k}": want for k, (_, want) in enumerate(BROKEN)}


@pytest.mark.parametrize("k", range(len(BROKEN)))
def test_loading_refuses_it(spark, k):
    with pytest.raises(ModelError):
        load_spec(ModelTables.from_rows(spark, BROKEN[k][0]))


def test_depths_of_a_chain(spark):
    tree = es.Leaf(0)
    for k in range(37):
        tree = es.Split(0, float(k), es.Leaf(k), tree)
    tables = ModelTables.from_rows(spark, es.model_rows("m", [es.scalar("a")], [tree]))
    depths = node_depths(tables).collect()
    assert len(depths) == 75 and max(r.depth for r in depths) == 37
    assert sorted(r.depth for r in depths) == sorted([0] + [k for k in range(1, 38)] * 2)


def test_widths(spark):
    tables = ModelTables.from_rows(spark, es.merge_rows(
        es.model_rows("a", [es.vector("u", 3), es.scalar("b"), es.category("s", ["x"])],
                      [es.constant(1)] * 2, groups=[0, 2]),
        es.model_rows("b", [es.scalar("c")], [es.constant(1)])))
    assert {tuple(r) for r in es.model_widths(tables).collect()} == {("a", 3, 3, 5), ("b", 1, 1, 1)}
