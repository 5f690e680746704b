"""Blocks ask, buckets answer: lookups between whole texts and a table that grows with them.

Documents are dealt to blocks of bounded size. A block asks for each distinct thing its
documents hold (words, pairs of words, passages) once; what blocks ask is dealt by hash to
buckets; a bucket sees all blocks that ask for a thing, computes its answer once, and
replies to each of them; blocks read the replies beside their documents. Asks and replies are
packed as compressed Arrow, and a thing that a third of all rows hold is asked for once
per block, so no key is hot. Everything follows from content, so that lost tasks recompute
to the same rows.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Text in a block.
BLOCK_BYTES = 16 << 20

ASK = "bucket int, block int, payload binary"
REPLY = "block int, bucket int, payload binary"


def pack(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(
            compression=pa.Codec("zstd", compression_level=3))) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _let_go(rows: pa.Table) -> pa.Table:
    """Give back what Arrow and the C library hold beyond ``rows``: workers live on from group to group."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)
    return rows


def unpack(payload: bytes) -> pa.Table:
    return pa.ipc.open_stream(payload).read_all()


def pack_arrays(**columns: np.ndarray) -> bytes:
    return pack(pa.table({name: pa.array(values) for name, values in columns.items()}))


def unpack_arrays(payload: bytes) -> dict[str, np.ndarray]:
    table = unpack(payload)
    return {name: table[name].to_numpy() for name in table.column_names}


def _rows(schema: pa.Schema, rows: list[tuple]) -> pa.Table:
    return pa.table([pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)] if rows
                    else [pa.array([], f.type) for f in schema], schema=schema)


_ASK = pa.schema([("bucket", pa.int32()), ("block", pa.int32()), ("payload", pa.binary())])
_REPLY = pa.schema([("block", pa.int32()), ("bucket", pa.int32()), ("payload", pa.binary())])


def count_blocks(df: DataFrame, text: Column, block_bytes: int = BLOCK_BYTES) -> int:
    """How many blocks the texts of a table make."""
    size = df.agg(F.sum(F.octet_length(text.cast("string")))).first()[0] or 0
    return max(1, -(-size // block_bytes))


def deal(df: DataFrame, n_blocks: int, by: list[str] | None = None) -> DataFrame:
    """(block, payload): the rows of ``df``, dealt by a hash of all their columns, or of ``by``, and packed."""
    names = df.columns

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = batch.column("__block").to_numpy()
            table = pa.Table.from_batches([batch]).select(names)
            for b in np.unique(block):
                rows = pa.array(np.flatnonzero(block == b))
                yield pa.record_batch([pa.array([b], pa.int32()), pa.array([pack(table.take(rows))], pa.binary())],
                                      names=["block", "payload"])

    block = F.pmod(F.xxhash64(*(by or names)), F.lit(n_blocks)).cast("int")
    return df.withColumn("__block", block).mapInArrow(packed, "block int, payload binary").repartition(
        n_blocks, "block")


def documents(packed: pa.Table) -> pa.Table:
    return pa.concat_tables([unpack(p.as_py()) for p in packed["payload"]]).combine_chunks()


def by_hash(hashes: np.ndarray, n_buckets: int) -> np.ndarray:
    """The bucket of each 64-bit hash; hashes in order have buckets in order."""
    return ((hashes >> np.uint64(32)) * np.uint64(n_buckets) >> np.uint64(32)).astype(np.int64)


def string_hashes(values: pa.Array) -> np.ndarray:
    """Fixed 64-bit hashes of strings."""
    return pd.util.hash_array(np.asarray(values.to_pylist(), dtype=object), categorize=False)


def in_hash_order(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The order of distinct strings by hash, and then by the strings; their hashes in that order."""
    hashes = string_hashes(values) if len(values) else np.zeros(0, np.uint64)
    order = np.argsort(hashes, kind="stable")
    hashes = hashes[order]
    if (hashes[1:] == hashes[:-1]).any():
        names, of = values.to_pylist(), dict(zip(order.tolist(), hashes.tolist()))
        order = np.array(sorted(of, key=lambda i: (of[i], names[i])))
    return order, hashes


def in_bucket_order(values: pa.Array, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of distinct strings by bucket and then by the strings, and their buckets in that order."""
    bucket = by_hash(string_hashes(values), n_buckets) if len(values) else np.zeros(0, np.int64)
    order = pc.sort_indices(values).to_numpy().astype(np.int64)
    order = order[np.argsort(bucket[order], kind="stable")]
    return order, bucket[order]


def ranges(buckets: np.ndarray) -> Iterator[tuple[int, slice]]:
    """(bucket, its rows) of an array of buckets in order."""
    found, starts = np.unique(buckets, return_index=True)
    for b, lo, hi in zip(found.tolist(), starts, np.append(starts[1:], len(buckets))):
        yield b, slice(int(lo), int(hi))


def _nullable(column: pa.Array) -> pa.Array:
    """A struct's fields as a result schema names them: all nullable."""
    if not pa.types.is_struct(column.type):
        return column
    return column.cast(pa.struct([f.with_nullable(True) for f in column.type]))


def ask(blocks: DataFrame, asks: Callable[[pa.Table], Iterator[tuple[int, bytes]]]) -> DataFrame:
    """What each block asks: ``asks`` turns a block's documents into (bucket, payload) pairs."""
    def run(key, table):
        block = key[0].as_py()
        return _let_go(_rows(_ASK, [(bucket, block, payload) for bucket, payload in asks(documents(table))]))
    return blocks.groupBy("block").applyInArrow(run, ASK)


def ask_again(blocks: DataFrame, replies: DataFrame,
              asks: Callable[[pa.Table, list[bytes]], Iterator[tuple[int, bytes]]]) -> DataFrame:
    """As ``ask``, for what depends on the replies of an earlier round, in the order of their buckets."""
    def run(key, left, right):
        if not left.num_rows:
            return _rows(_ASK, [])
        block = key[0].as_py()
        return _let_go(_rows(_ASK, [(bucket, block, payload)
                                    for bucket, payload in asks(documents(left), _in_order(right))]))
    return blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(run, ASK)


def _in_order(replies: pa.Table) -> list[bytes]:
    return replies.sort_by("bucket")["payload"].to_pylist()


def answer(asks: DataFrame, n_buckets: int, answers: Callable[[int, list[bytes]], list[bytes]]) -> DataFrame:
    """The replies: ``answers`` turns a bucket's asks, by block, into one payload for each.

    It may give one payload more, which goes to block -1: totals for the driver."""
    def run(key, table):
        table = table.sort_by("block")
        bucket, to = key[0].as_py(), table["block"].to_pylist()
        payloads = answers(bucket, table["payload"].to_pylist())
        return _let_go(_rows(_REPLY, [(b, bucket, p) for b, p in zip(to + [-1], payloads)]))
    return asks.repartition(n_buckets, "bucket").groupBy("bucket").applyInArrow(run, REPLY)


def finish(blocks: DataFrame, replies: DataFrame, schema: str,
           finishes: Callable[[pa.Table, list[bytes]], pa.Table]) -> DataFrame:
    """Each block's documents with its replies, in the order of buckets, turned into result rows."""
    def run(left, right):
        rows = finishes(documents(left), _in_order(right))
        return _let_go(pa.table([_nullable(c.combine_chunks()) for c in rows.columns], names=rows.column_names))
    return blocks.groupBy("block").cogroup(replies.where("block >= 0").groupBy("block")).applyInArrow(run, schema)
