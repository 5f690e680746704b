"""Input and output widths of every model in a registry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ensemblescore.sources.tables import ModelTables, beside


def model_widths(tables: ModelTables) -> DataFrame:
    """``model_id, n_outputs, used_outputs, input_width``: declared, fed by trees, read from rows."""
    shape = F.col("shape")
    width = F.when(F.size(shape) == 1, 1).otherwise(F.get(shape, F.lit(1)))
    read = tables.inputs.groupBy("model_id").agg(F.sum(width).cast("long").alias("input_width"))
    used = tables.trees.groupBy("model_id").agg(
        (F.max("tree_group") + 1).alias("used_outputs"))
    zero = F.lit(0)
    n = tables.header.count()
    return tables.header.select("model_id", "n_outputs").join(beside(used, n), "model_id", "left").join(
        beside(read, n), "model_id", "left").select(
        "model_id", "n_outputs", F.coalesce("used_outputs", zero).alias("used_outputs"),
        F.coalesce("input_width", zero).cast("long").alias("input_width"))
