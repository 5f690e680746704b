"""Which physical form a model is scored in."""

from __future__ import annotations

from ensemblescore.errors import ModelError
from ensemblescore.functions.coerce import MAX_CASE_CATEGORIES
from ensemblescore.sources.spec import ModelSpec

EXPR = "expr"
ARROW = "arrow"
CHUNKED = "chunked"
TREES = "trees"
JOIN = "join"
BOXES = "boxes"
AUTO = "auto"
STRATEGIES = (AUTO, EXPR, ARROW, CHUNKED, TREES, JOIN, BOXES)

MAX_EXPRESSION_NODES = 128


def choose(spec: ModelSpec, wanted: str, streaming: bool) -> str:
    """The wanted strategy, or the cheapest exact one for a model of this size."""
    if wanted not in STRATEGIES:
        raise ModelError(f"unknown strategy {wanted!r}; choose one of {STRATEGIES}")
    if wanted == AUTO:
        if spec.forest is None:
            wanted = CHUNKED
        else:
            wide = any(i.n_categories > MAX_CASE_CATEGORIES and i.categories is not None
                       for i in spec.inputs)
            wanted = EXPR if spec.n_nodes <= MAX_EXPRESSION_NODES and not wide else ARROW
    if wanted in (JOIN, BOXES, TREES) and streaming:
        raise ModelError(f"model {spec.model_id!r} ({spec.n_nodes} nodes) would be scored by joins, "
                         "which a stream cannot do")
    if wanted in (EXPR, ARROW) and spec.forest is None:
        raise ModelError(f"model {spec.model_id!r} ({spec.n_nodes} nodes) is too large for {wanted!r}")
    return wanted
