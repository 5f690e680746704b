"""One model, small enough for every executor, checked and laid out as flat arrays."""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ensemblescore.errors import ModelError
from ensemblescore.functions.forest import Forest, lay_out
from ensemblescore.operators.validate import refuse_broken
from ensemblescore.sources import schema as S
from ensemblescore.sources.tables import ModelTables

# Above this a forest is broadcast in chunks of trees (plans/chunked.py).
MAX_BROADCAST_NODES = 4_000_000
# Above this, all category names together, strings are coded by a join with the model's table.
MAX_BROADCAST_CHARS = 64_000_000

# A model below this size is read in one round of jobs, without counting it first.
GLANCE = 100_000


@dataclass(frozen=True)
class InputSpec:
    name: str
    dtype: str
    shape: tuple[int, ...]
    n_categories: int = 0
    categories: tuple[str, ...] | None = None  # None: no string, or too many to collect

    @property
    def is_vector(self) -> bool:
        return len(self.shape) >= 2

    @property
    def is_string(self) -> bool:
        return self.dtype == S.STRING

    @property
    def width(self) -> int:
        return self.shape[1] if self.is_vector else 1


@dataclass(frozen=True)
class ModelSpec:
    model_id: str
    post_transform: str
    n_outputs: int
    output_names: tuple[str, ...]
    inputs: tuple[InputSpec, ...]
    n_nodes: int
    forest: Forest | None  # None: too large to broadcast whole

    @property
    def input_width(self) -> int:
        return sum(i.width for i in self.inputs)

    @property
    def reads_features_col(self) -> bool:
        """A single vector input is named by a placeholder, so the caller names the column."""
        return len(self.inputs) == 1 and self.inputs[0].is_vector


def node_columns(nodes: DataFrame) -> DataFrame:
    """The node table as ``lay_out`` reads it: enums as flags, children side by side."""
    return nodes.select(
        "model_id", "tree_id", "node_id", (F.col("kind") == S.BRANCH).alias("branch"),
        F.col("kind").isin(*S.NODE_KINDS).alias("known_kind"),
        (F.col("split_op") == S.LESS_THAN).alias("less_than"), "split_feature",
        "split_threshold", F.size("children").alias("n_children"),
        F.get("children", F.lit(0)).alias("below"),
        F.get("children", F.lit(1)).alias("otherwise"), "default_child", "leaf_value")


def packed(df: DataFrame) -> pa.Table:
    """``df`` on the driver, sent there compressed: names of models and kinds of nodes repeat."""
    empty = df.limit(0).toArrow().schema

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_batch(batch)
            yield pa.record_batch([pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["rows"])

    chunks = df.mapInArrow(pack, "rows binary").toArrow()["rows"]
    return pa.concat_tables([pa.ipc.open_stream(c.as_buffer()).read_all() for c in chunks] or [empty.empty_table()])


def at_once(spark: SparkSession, *jobs) -> list:
    """Run small jobs side by side: opening a model is all latency."""
    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [f.result() for f in [pool.submit(inherit(job)) for job in jobs]]


def load_spec(tables: ModelTables, model_id: str | None = None, *,
              max_nodes: int = MAX_BROADCAST_NODES, max_chars: int | None = None) -> ModelSpec:
    """Read and check one model. Node rows reach the driver only if they are at most ``max_nodes``."""
    if model_id is None:
        ids = tables.header.select("model_id").limit(2).collect()
        if len(ids) != 1:
            raise ModelError("several models in this directory; set modelId to choose one"
                             if ids else "no model in the header table")
        model_id = ids[0].model_id
    one = tables.only(model_id)
    chars = F.aggregate("categories", F.lit(0).cast("long"),
                        lambda total, c: total + F.coalesce(F.length(c), F.lit(0)) + 1)
    spark = one.nodes.sparkSession
    tree_rows, node_rows = one.trees.select("tree_id", "tree_group"), node_columns(one.nodes)
    headers, input_rows, trees, nodes = at_once(
        spark, one.header.limit(2).collect,
        one.inputs.select("ordinal", "name", "dtype", "shape", chars.alias("chars"),
                          F.size("categories").alias("n_categories"),
                          F.exists("categories", lambda c: c.isNull()).alias("null_category")).collect,
        tree_rows.limit(GLANCE).toArrow, node_rows.limit(GLANCE).toArrow)
    whole = len(trees) < GLANCE and len(nodes) < GLANCE
    n_nodes = len(nodes) if whole else one.nodes.count()
    if len(headers) != 1:
        raise ModelError(f"model {model_id!r} has several header rows" if headers
                         else f"no model {model_id!r} in the header table")
    header = headers[0]
    for value, known, what in ((header.aggregation, S.AGGREGATIONS, "aggregation"),
                               (header.post_transform, S.POST_TRANSFORMS, "post transform")):
        if value not in known:
            raise ModelError(f"unknown {what} {value!r}")

    if header.n_outputs is None or header.n_outputs < 1:
        raise ModelError(f"model {header.model_id!r} declares {header.n_outputs} outputs")

    inputs = []
    for k, row in enumerate(sorted(input_rows, key=lambda r: r.ordinal)):
        if row.ordinal != k:
            raise ModelError(f"input ordinals of {header.model_id!r} are not 0, 1, 2, ...")
        if row.dtype not in S.DTYPES:
            raise ModelError(f"input {row.name!r} has unknown dtype {row.dtype!r}")
        if not row.shape or (len(row.shape) >= 2 and row.shape[1] < 1):
            raise ModelError(f"input {row.name!r} has no usable shape: {row.shape}")
        n_categories = -1 if row.chars is None else row.n_categories
        spec = InputSpec(row.name, row.dtype, tuple(row.shape), max(n_categories, 0))
        if spec.is_string and (spec.is_vector or n_categories < 0):
            raise ModelError(f"string input {row.name!r} must be a scalar with categories")
        inputs.append(spec)
    if not inputs:
        raise ModelError(f"model {header.model_id!r} declares no inputs")

    if any(row.null_category for row in input_rows):
        raise ModelError(f"a category of {header.model_id!r} is null")
    if sum(r.chars or 0 for r in input_rows) <= (MAX_BROADCAST_CHARS if max_chars is None else max_chars):
        strings = any(i.is_string for i in inputs)
        for row in one.inputs.select("ordinal", "categories").collect() if strings else []:
            if row.categories is not None:
                inputs[row.ordinal] = replace(inputs[row.ordinal],
                                              categories=tuple(row.categories))
    forest = None
    if n_nodes <= max_nodes:
        if not whole:
            trees, nodes = at_once(spark, tree_rows.toArrow, node_rows.toArrow)
        forest = lay_out(trees, nodes, width=sum(i.width for i in inputs),
                         n_outputs=header.n_outputs)
    else:
        refuse_broken(one)
    return ModelSpec(header.model_id, header.post_transform, header.n_outputs,
                     tuple(header.output_names or ()), tuple(inputs), n_nodes, forest)
