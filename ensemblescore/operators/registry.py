"""Score rows that each name their model, against a registry of any size.

Three plans give the same result. ``arrow`` broadcasts the registry and moves no rows,
save for a lookup of strings or of which models read a vector. ``group`` brings models and
rows together by one shuffle, hot models spread over many groups and models of any size taken
in chunks. ``join`` walks node tables by joins and is a check. A broken model fails all three
before any row is scored. Columns of the input are kept by position and may share names, save
those that a model reads.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField

from ensemblescore.errors import InputError, ModelError
from ensemblescore.functions import coerce, post
from ensemblescore.functions.models import Models
from ensemblescore.operators import lookup
from ensemblescore.operators.outputs import extended
from ensemblescore.operators.validate import refuse_broken
from ensemblescore.plans import grouped, relational
from ensemblescore.sources import schema as S
from ensemblescore.sources.spec import MAX_BROADCAST_NODES as MAX_MODEL_NODES
from ensemblescore.sources.spec import at_once, node_columns, packed
from ensemblescore.sources.tables import ModelTables, beside

# Every Python worker of an executor keeps a registry of its own, and one more for each scoring of a stage.
MAX_BROADCAST_NODES = 1_000_000

ARROW, GROUP, JOIN, AUTO = "arrow", "group", "join", "auto"

# Rows of one model that make a group of their own, and the features and outputs that such rows may have.
ROWS_PER_GROUP = 500_000
VALUES_PER_GROUP = 20_000_000


def score_registry(df: DataFrame, tables: ModelTables, model_id_col: str = "model_id", *,
                   features_col: str = "features", prediction_col: str = "prediction",
                   probability_col: str = "probability", strategy: str = AUTO,
                   rows_per_group: int | None = None, max_nodes: int | None = None) -> DataFrame:
    """Append ``prediction`` and, if any model has several outputs, ``probability``.

    Every row is kept. ``prediction`` is null where the registry has no such model;
    ``probability`` is null for a model with one output. A task holds at most ``max_nodes``
    nodes of a model at a time, or one tree.
    """
    max_nodes = MAX_MODEL_NODES if max_nodes is None else max_nodes
    if strategy not in (AUTO, ARROW, GROUP, JOIN):
        raise ModelError(f"unknown registry strategy {strategy!r}")
    if df.columns.count(model_id_col) != 1:
        raise InputError(f"no model id column {model_id_col!r} among {df.columns}" if model_id_col not in df.columns
                         else f"several columns are named {model_id_col!r}")
    inputs = _inputs(tables, features_col)
    (n_models, n_outputs), sources, (n_nodes, largest), bare = at_once(
        df.sparkSession,
        tables.header.agg(F.count("*"), F.max("n_outputs")).head,
        _sources(inputs, len(df.columns)).collect,
        tables.nodes.groupBy("model_id").count().agg(F.sum("count"), F.max("count")).head,
        _without_trees(tables).head)
    if bare is not None:
        raise ModelError(f"model {bare.model_id!r} has no trees")
    several = (n_outputs or 1) > 1
    appended = [StructField(prediction_col, DoubleType())]
    if several:
        appended.insert(0, StructField(probability_col, VectorUDT()))
    extended(df.schema, appended)

    plan = choose(n_nodes or 0) if strategy == AUTO else strategy
    if plan == ARROW and (n_nodes or 0) > MAX_BROADCAST_NODES:
        raise ModelError("the registry is too large to broadcast")
    model, x, score = (coerce.unused(df.columns, n) for n in ("__model", "__x", "__s"))
    keyed, slots, width = _with_features(df, inputs, sources, n_models, model_id_col, model, x)
    if plan != ARROW:  # which looks all models over while it lays them out
        refuse_broken(tables)
    tables = _with_slots(tables, beside(slots, n_models * width))
    if plan == ARROW:
        summed = _by_broadcast(keyed, tables, width, model, x, score).drop(model, x)
    elif plan == GROUP:
        values = 2 * width + (n_outputs or 1)
        summed = grouped.add_sums(
            keyed, model, x, score, df.select(coerce.column(model_id_col).cast("string")), tables, width, n_models,
            n_nodes or 0, largest or 0, max_nodes,
            rows_per_group or max(1, min(ROWS_PER_GROUP, VALUES_PER_GROUP // values)))
    else:
        points = keyed.where(F.col(x).isNotNull() & F.col(model).isNotNull()).select(
            F.xxhash64(x).alias("h"), F.col(model).alias("model_id"), F.col(x).alias("x")).distinct()
        h = coerce.unused(keyed.columns, "__h")
        flags = tables.header.select(
            "model_id", (F.col("post_transform") == S.SOFTMAX).alias("softmax"))
        scored = relational.sums(points, tables).join(beside(flags, n_models), "model_id").select(
            F.col("h").alias(h), F.col("model_id").alias(model), F.col("x").alias(x), F.struct("sums", "softmax").alias(score))
        summed = keyed.withColumn(h, F.xxhash64(x)).join(beside(scored, n_models), [h, model, x], "left").drop(h, model, x)

    sums, out = F.col(score)["sums"], coerce.unused(summed.columns, "__out")
    outputs = F.when(F.col(score)["softmax"], post.softmax(sums)).otherwise(sums)
    summed = summed.select("*", outputs.cast("array<float>").alias(out))
    many = F.size(out) > 1
    prediction = F.when(many, post.argmax(F.col(out))).otherwise(F.get(out, F.lit(0)).cast("double"))
    columns = [prediction.alias(prediction_col)]
    if several:
        columns.insert(0, F.when(many, post.as_vector(F.col(out))).alias(probability_col))
    return summed.select("*", *columns).drop(score, out)


def _without_trees(tables: ModelTables) -> DataFrame:
    """Models of the header that no tree belongs to, or that have no name; counted, since a join would gather them."""
    named = F.lit(1).alias("named")
    both = tables.header.select("model_id", named, F.lit(0).alias("grown")).unionByName(
        tables.trees.select("model_id", F.lit(0).alias("named"), F.lit(1).alias("grown")))
    return both.groupBy("model_id").agg(F.max("named").alias("named"), F.max("grown").alias("grown")).where(
        "named = 1 AND (grown = 0 OR model_id IS NULL)").select("model_id")


def choose(n_nodes: int) -> str:
    """The cheapest plan for a registry of so many nodes."""
    return ARROW if n_nodes <= MAX_BROADCAST_NODES else GROUP


def _inputs(tables: ModelTables, features_col: str) -> DataFrame:
    """Declared inputs with the column each reads and its offset among those of its model."""
    each = Window.partitionBy("model_id")
    vector = F.size("shape") >= 2
    return tables.inputs.select(
        "model_id", "ordinal", "categories", (F.col("dtype") == S.STRING).alias("text"),
        vector.alias("vector"),
        F.when(vector, F.get("shape", F.lit(1))).otherwise(1).alias("width"),
        F.when(vector & (F.count("*").over(each) == 1), F.lit(features_col))
        .otherwise(F.col("name")).alias("source"),
    ).withColumn("offset", F.coalesce(
        F.sum("width").over(each.orderBy("ordinal").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)))


def _sources(inputs: DataFrame, n_columns: int) -> DataFrame:
    """The columns the registry reads. A sound one reads no more than there are, so one row
    more is enough to find a stranger."""
    return inputs.groupBy("source").agg(
        F.min("model_id").alias("model_id"), F.min("text").alias("text"),
        F.min("vector").alias("vector"), F.min("width").alias("width"),
        F.count("*").alias("readers"), F.max("width").alias("widest"),
        ((F.min("text") != F.max("text")) | (F.min("vector") != F.max("vector"))).alias("mixed")
    ).limit(n_columns + 1)


def _with_features(df: DataFrame, inputs: DataFrame, sources: list, n_models: int,
                   model_id_col: str, model: str, x: str) -> tuple[DataFrame, DataFrame, int]:
    """Add columns ``model`` and ``x array<float>``, one slot per feature any model reads.

    Returned with it: which slot each feature of each model is, and the number of slots.
    """
    for source in sources:
        if source.source not in df.columns:
            raise InputError(f"model {source.model_id!r} needs column {source.source!r}, "
                             f"which is not among {df.columns}")
        if df.columns.count(source.source) > 1:
            raise InputError(f"several columns are named {source.source!r}")
        if source.mixed:
            raise ModelError(f"models disagree on the type of {source.source!r}")
    if not sources:
        raise ModelError("the registry declares no inputs")

    keyed = df.select("*", coerce.column(model_id_col).cast("string").alias(model))
    parts, bases, width, helpers = [], [], 0, []
    for k, source in enumerate(sorted(sources, key=lambda s: s.source)):
        dtype = df.schema[source.source].dataType
        coerce.require(source.source, dtype, vector=source.vector, string=source.text)
        bases.append((source.source, width))
        width += source.widest
        if source.vector and source.readers == n_models and source.width == source.widest:
            parts.append(coerce.checked_vector(source.source, dtype, source.width))
        elif source.vector:
            # Each model declares its own width, and a row whose model does not read the vector
            # may lack it. The slots beyond a narrower vector are read by no split of its model.
            helpers.append(coerce.unused(keyed.columns, f"__width{k}"))
            keyed = _declared(keyed, inputs, source, model, helpers[-1])
            floats, own = coerce.vector(source.source, dtype), F.col(helpers[-1])
            nan, zero = F.lit(float("nan")).cast("float"), F.lit(0.0).cast("float")
            checked = F.when(F.size(floats) == own, F.transform(floats, lambda v: F.coalesce(v, zero))).otherwise(
                F.raise_error(F.format_string("column '%s' holds a vector of %s, the model declares %s",
                                              F.lit(source.source), F.size(floats), own)))
            parts.append(F.when(own.isNull(), F.array_repeat(nan, source.widest)).otherwise(
                F.concat(checked, F.array_repeat(nan, source.widest - own))))
        elif source.text:
            helpers.append(coerce.unused(keyed.columns, f"__code{k}"))
            keyed = _coded(keyed, inputs, source.source, model, helpers[-1])
            parts.append(F.array(F.col(helpers[-1])))
        else:
            parts.append(F.array(coerce.scalar(source.source)))
    features = parts[0] if len(parts) == 1 else F.concat(*parts)
    keyed = keyed.select("*", features.alias(x)).drop(*helpers)

    base = F.broadcast(df.sparkSession.createDataFrame(bases, "source string, base int"))
    slots = inputs.join(base, "source").select(
        "model_id", "offset", "base", F.explode(F.sequence(F.lit(0), F.col("width") - 1)).alias("i")
    ).select("model_id", (F.col("offset") + F.col("i")).cast("int").alias("split_feature"),
             (F.col("base") + F.col("i")).alias("slot"))
    return keyed, slots, width


def _with_slots(tables: ModelTables, slots: DataFrame) -> ModelTables:
    """The tables with ``split_feature`` naming a slot; a feature outside the inputs becomes -1."""
    nodes = tables.nodes.join(slots, ["model_id", "split_feature"], "left").withColumn(
        "split_feature", F.coalesce("slot", F.lit(-1))).select(*tables.nodes.columns)
    return ModelTables(tables.header, tables.inputs, tables.trees, nodes)


def _declared(df: DataFrame, inputs: DataFrame, source, model: str, name: str) -> DataFrame:
    """The width that the row's model declares for this source; null if it does not read it."""
    readers = inputs.where(F.col("source") == source.source).groupBy(
        F.col("model_id").alias(model)).agg(F.max("width").cast("int").alias(name))
    return df.join(beside(readers, source.readers), model, "left")


def _coded(df: DataFrame, inputs: DataFrame, source: str, model: str, code: str) -> DataFrame:
    """Look a string up among the categories of the row's own model; NaN if it is not there."""
    def pair(name, value):
        """One string for both, which no other two strings give; null if either is."""
        return F.concat(F.length(name).cast("string"), F.lit(":"), name, value)

    known = inputs.where(F.col("source") == source).select(
        F.col("model_id"), F.posexplode("categories").alias("pos", "category")
    ).groupBy(pair(F.col("model_id"), F.col("category")).alias("value")).agg(F.min("pos").cast("float").alias("code"))
    return lookup.coded(df, pair(F.col(model), coerce.column(source)), known, code)


def _by_broadcast(keyed: DataFrame, tables: ModelTables, width: int, model: str, x: str, score: str) -> DataFrame:
    """All models on every executor; a batch walks the trees of all its models at once."""
    header, trees, nodes = at_once(
        keyed.sparkSession, *(lambda df=df: packed(df) for df in (
            tables.header.select("model_id", "n_outputs", "post_transform"), tables.trees, node_columns(tables.nodes))))
    softmax = np.array([p == S.SOFTMAX for p in header.column("post_transform").to_pylist()], bool)
    shared = keyed.sparkSession.sparkContext.broadcast(
        (Models.build(header, trees, nodes, width), softmax))

    @F.arrow_udf("struct<sums: array<double>, softmax: boolean>")
    def sums(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        models, softmax = shared.value
        for model_id, features in batches:
            values, own = models.sums(model_id, features)
            yield pa.StructArray.from_arrays(
                [values, pa.array(softmax[own])], names=["sums", "softmax"])

    return keyed.select("*", sums(model, x).alias(score))
