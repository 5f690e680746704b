"""Many models at once: a batch whose rows each name their model.

Imported by Python workers, so it needs NumPy and Arrow only.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ensemblescore.errors import ModelError
from ensemblescore.functions.forest import Forest, lay_out
from ensemblescore.functions.walk import Rows, descend


@dataclass(frozen=True)
class Models:
    """The trees of all models in one forest; those of one model follow each other."""

    ids: pa.Array
    n_outputs: np.ndarray
    n_trees: np.ndarray
    first_tree: np.ndarray
    forest: Forest
    width: int

    @classmethod
    def build(cls, header: pa.Table, trees: pa.Table, nodes: pa.Table, width: int) -> Models:
        ids = header.column("model_id").combine_chunks()
        if len(ids.unique()) != len(ids):
            raise ModelError("duplicate model_id in the header table")

        def numbered(table):
            """The table with tree ids made unique over models, and each row's model."""
            model = pc.index_in(table.column("model_id"), value_set=ids)
            if model.null_count:
                raise ModelError("a tree or node belongs to no model")
            model = model.to_numpy().astype(np.int64)
            tree = model * span + table.column("tree_id").to_numpy()
            at = table.column_names.index("tree_id")
            return table.set_column(at, "tree_id", pa.array(tree)), model

        span = 1 + max(pc.max(t.column("tree_id")).as_py() or 0 for t in (trees, nodes))
        n_outputs = header.column("n_outputs").to_numpy().astype(np.intp)
        (trees, model), (nodes, _) = numbered(trees), numbered(nodes)
        n_trees = np.bincount(model, minlength=len(ids))
        if (n_trees == 0).any():
            raise ModelError(f"model {ids[int(np.argmin(n_trees))].as_py()!r} has no trees")
        return cls(ids, n_outputs, n_trees, np.cumsum(n_trees) - n_trees,
                   lay_out(trees, nodes, width=width, n_outputs=n_outputs[model]), width)

    @cached_property
    def _position(self) -> dict[str, int]:
        """Built once per worker, whatever the number of models and batches."""
        return {name: k for k, name in enumerate(self.ids.to_pylist())}

    def _positions(self, model_id: pa.Array) -> np.ndarray:
        """The position of each row's model, or -1."""
        coded = model_id.dictionary_encode()
        own = np.array([self._position.get(m, -1) for m in coded.dictionary.to_pylist()] + [-1], np.intp)
        return own[coded.indices.fill_null(len(own) - 1).to_numpy(zero_copy_only=False)]

    def sums(self, model_id: pa.Array, x: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Summed trees per row, null for an unknown model, and the position of each row's model.

        Every row steps down the k-th tree of its own model at the same time.
        """
        model = self._positions(model_id)
        known = model >= 0
        model = np.maximum(model, 0)
        rows = Rows(x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), self.width))
        ends = np.concatenate([[0], np.cumsum(np.where(known, self.n_outputs[model], 0))])
        n_trees = np.where(known, self.n_trees[model], 0)
        out, forest = np.zeros(ends[-1]), self.forest
        for k in range(n_trees.max(initial=0)):
            some = np.flatnonzero(n_trees > k)
            tree = self.first_tree[model[some]] + k
            leaf = descend(forest, rows.subset(some), forest.root[tree],
                           int(forest.depth[tree].max()))
            out[ends[some] + forest.group[tree]] += leaf
        sums = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(out),
                                        mask=pa.array(~known))
        return sums, model
