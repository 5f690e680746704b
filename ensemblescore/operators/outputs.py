"""The columns a model appends."""

from __future__ import annotations

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ensemblescore.errors import InputError
from ensemblescore.functions import post
from ensemblescore.sources.spec import ModelSpec


def output_fields(spec: ModelSpec, probability: str, prediction: str) -> list[StructField]:
    fields = [StructField(prediction, DoubleType(), False)]
    if spec.n_outputs > 1:
        # Spark's array_to_vector declares its result nullable, so this does too.
        fields.insert(0, StructField(probability, VectorUDT(), True))
    return fields


def extended(schema: StructType, fields: list[StructField]) -> StructType:
    """The schema with the output fields appended; a name clash is an error."""
    spark = SparkSession.getActiveSession()
    exact = spark is not None and spark.conf.get("spark.sql.caseSensitive") == "true"
    names = [f.name for f in schema]
    for field in fields:
        if field.name in names or (
                not exact and field.name.lower() in (n.lower() for n in names)):
            raise InputError(f"the input already has a column {field.name!r}")
        names.append(field.name)
    return StructType([*schema, *fields])


def append(df: DataFrame, sums: str, kept: list[str], spec: ModelSpec, probability: str,
           prediction: str) -> DataFrame:
    """Turn the summed trees in column ``sums`` into the output columns behind ``kept``."""
    # By position: the input may have several columns of one name. Helpers have names of their own.
    helpers = [c for c in df.columns if c not in kept]
    nan = F.lit(float("nan"))
    if spec.n_outputs == 1:
        only = F.col(sums)
        if spec.post_transform != "IDENTITY":
            only = F.get(post.softmax(F.array(only), 1), F.lit(0))
        return df.select("*", F.coalesce(only.cast("float").cast("double"), nan)
                         .alias(prediction)).drop(*helpers)
    outputs = f"{sums}_out"
    df = df.select("*", post.narrowed(F.col(sums), spec.post_transform, spec.n_outputs)
                   .alias(outputs))
    return df.select(
        "*", post.as_vector(F.col(outputs)).alias(probability),
        F.coalesce(post.argmax(F.col(outputs)), nan).alias(prediction)).drop(*helpers, outputs)
