"""Words of whole Arrow text columns, without a Python loop per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: ASCII white space, the only kind that parts words.
SPACES = b" \t\n\x0b\x0c\r"


def slices(text: pa.Array, max_bytes: int = 4 << 20) -> Iterator[tuple[int, pa.Array]]:
    """(first row, rows) of at most ``max_bytes`` of text each, or one longer text; null is empty."""
    text = pc.fill_null(text.cast(pa.large_string()), "")
    ends = np.cumsum(pc.binary_length(text).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(text):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + max_bytes, side="right")))
        yield start, text.slice(start, stop - start)
        start = stop


def text_bytes(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a large_string array without nulls, and the n + 1 offsets of its rows."""
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
    data = text.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def words(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words ``[^\\x20\\x09-\\x0D]+`` in order, and how many each row has."""
    parts = pc.ascii_split_whitespace(text)
    flat = parts.flatten()
    row = np.repeat(np.arange(len(text)), pc.list_value_length(parts).to_numpy(zero_copy_only=False))
    full = pc.not_equal(pc.binary_length(flat), 0)
    row = row[full.to_numpy(zero_copy_only=False)]
    return flat.filter(full), np.bincount(row, minlength=len(text))


def codes(values: pa.Array) -> np.ndarray:
    """Small integers that are equal where the values are."""
    return values.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The sum over each row's run of values; rows may have none."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


def content_digest(key: Column, text: Column) -> Column:
    """A hash of a row's key and text, the same in every run; null counts as empty."""
    return F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit("\n"),
                          F.coalesce(text.cast("string"), F.lit(""))))


def unused(df: DataFrame, name: str) -> str:
    """A column name that the table does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def named(name: str) -> Column:
    """The column of exactly this name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")
