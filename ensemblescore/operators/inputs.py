"""Match a model's declared inputs to the columns of a DataFrame."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, FloatType, StructType

from ensemblescore.errors import InputError, ModelError
from ensemblescore.functions import coerce
from ensemblescore.operators.lookup import coded
from ensemblescore.sources.schema import FLOAT32
from ensemblescore.sources.spec import InputSpec, ModelSpec
from ensemblescore.sources.tables import ModelTables


@dataclass(frozen=True)
class BoundInput:
    """One model input and the column it reads."""

    spec: InputSpec
    column: str
    dtype: DataType

    @property
    def width(self) -> int:
        return self.spec.width

    @property
    def floats(self) -> Column:
        """The input as float32: a scalar, or an array not yet checked for its width."""
        if self.spec.is_vector:
            return coerce.vector(self.column, self.dtype)
        if self.spec.is_string:
            if self.spec.categories is None:
                raise ModelError(f"the categories of {self.spec.name!r} are not at hand")
            return coerce.category_code(self.column, self.spec.categories)
        return coerce.scalar(self.column)

    @property
    def array(self) -> Column:
        """The input as an array of its declared width, without nulls, or an error."""
        if self.spec.is_vector:
            return coerce.checked_vector(self.column, self.dtype, self.width)
        return F.array(self.floats)

    @property
    def has_long_vocabulary(self) -> bool:
        return self.spec.n_categories > coerce.MAX_CASE_CATEGORIES


def coded_by_join(df: DataFrame, item: BoundInput, tables: ModelTables, code: str) -> DataFrame:
    """Add the category code of a string input from the model's table; NaN if null or unknown."""
    known = tables.inputs.where(F.col("name") == item.spec.name).select(
        F.posexplode("categories").alias("pos", "value")
    ).groupBy("value").agg(F.min("pos").cast("float").alias("code"))
    return coded(df, coerce.column(item.column), known, code)


def with_codes(df: DataFrame, bound: list[BoundInput], tables: ModelTables,
               name: str) -> tuple[DataFrame, list[BoundInput]]:
    """Replace string inputs whose categories are too many to collect by their codes."""
    out = []
    for k, item in enumerate(bound):
        if item.spec.is_string and item.spec.categories is None:
            code = f"{name}_category{k}"
            df = coded_by_join(df, item, tables, code)
            item = BoundInput(replace(item.spec, dtype=FLOAT32, n_categories=0), code, FloatType())
        out.append(item)
    return df, out


def bind(spec: ModelSpec, schema: StructType, features_col: str) -> list[BoundInput]:
    """One bound input per declared input, in declared order. Fails on the driver."""
    bound = []
    for declared in spec.inputs:
        name = features_col if spec.reads_features_col else declared.name
        if name not in schema.names:
            raise InputError(
                f"model input {declared.name!r} needs column {name!r}, "
                f"which is not among {schema.names}")
        dtype = schema[name].dataType
        coerce.require(name, dtype, vector=declared.is_vector, string=declared.is_string)
        bound.append(BoundInput(declared, name, dtype))
    return bound
