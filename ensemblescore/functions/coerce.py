"""Columns as the model sees them: float32 scalars and float32 arrays, nothing missing but NaN."""

from __future__ import annotations

import json

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, NullType, NumericType, StringType

from ensemblescore.errors import InputError

# Beyond this many categories a chain of comparisons is slower than a lookup.
MAX_CASE_CATEGORIES = 64


def column(name: str) -> Column:
    """The column with exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def unused(columns: list[str], name: str) -> str:
    """A name that no column has, in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def require(name: str, dtype: DataType, *, vector: bool = False, string: bool = False) -> None:
    """Refuse a column whose type the model cannot read, before any job starts."""
    if vector:
        wanted = "vector"
        fits = isinstance(dtype, VectorUDT) or (
            isinstance(dtype, ArrayType) and isinstance(dtype.elementType, NumericType))
    elif string:
        wanted, fits = "string", isinstance(dtype, (StringType, NullType))
    else:
        wanted, fits = "number", isinstance(dtype, (NumericType, NullType))
    if not fits:
        raise InputError(f"column {name!r} is {dtype.simpleString()}; the model needs a {wanted}")


def scalar(name: str) -> Column:
    """Any numeric type to float32; a null counts as 0, as in a zero-filled feature matrix."""
    return F.coalesce(column(name).cast("float"), F.lit(0.0).cast("float"))


def vector(name: str, dtype: DataType) -> Column:
    """A dense or sparse vector, or an array of numbers, as ``array<float>``; a null is an error."""
    present = F.when(column(name).isNotNull(), column(name)).otherwise(
        F.raise_error(F.lit(f"column {name!r} holds a null vector")))
    if isinstance(dtype, VectorUDT):
        return vector_to_array(present, "float32")
    return present.cast("array<float>")


def wrong_width(name: str, size: Column, width: int) -> Column:
    return F.raise_error(F.format_string(
        f"column '%s' holds a vector of %s, the model declares {width}", F.lit(name), size))


def checked_vector(name: str, dtype: DataType, width: int) -> Column:
    """``vector``, checked for its width and with nulls inside as 0."""
    floats, zero = vector(name, dtype), F.lit(0.0).cast("float")
    checked = F.when(F.size(floats) == width, floats).otherwise(
        wrong_width(name, F.size(floats), width))
    return F.transform(checked, lambda v: F.coalesce(v, zero))


def category_code(name: str, categories: tuple[str, ...]) -> Column:
    """Position of the value among the categories; NaN, so missing, if it is null or unknown."""
    nan = F.lit(float("nan")).cast("float")
    if len(categories) > MAX_CASE_CATEGORIES:
        known = F.from_json(F.lit(json.dumps(categories)), "array<string>")
        position = F.array_position(known, column(name))
        return F.when(position > 0, (position - 1).cast("float")).otherwise(nan)
    first = {c: k for k, c in reversed(list(enumerate(categories)))}
    code = nan
    for value, k in first.items():
        code = F.when(column(name) == value, F.lit(float(k)).cast("float")).otherwise(code)
    return code
