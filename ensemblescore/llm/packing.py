"""Best-fit packing of token sequences by minimum bin slack.

Per bin, a bitset subset-sum program over the lengths still there finds the fullest combination
that holds the longest one, and that combination is removed. Only how many pieces of each length
there are matters, and there are at most ``capacity`` lengths, so bins are planned from those
counts: as long as a fullest combination can be had again it stays the fullest, so it is planned
for as many bins as the counts give at once. Pieces then find bin and offset from their number
among the pieces of their length, each for itself.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ensemblescore.llm.encoding import TextEncoder
from ensemblescore.llm.text import named, slices
from ensemblescore.sources.scratch import scratch_path

#: Tokens in a sequence, and the id behind every document.
CAPACITY, END_ID = 4096, 1

#: Text encoded at a time, and tokens that a task puts into one batch of pieces.
SLICE_BYTES, TOKENS_PER_BATCH = 4 << 20, 1 << 20


def token_pieces(df: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
                 key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``, ``ids``, ``part``, ``nth``: documents as ids, the long ones cut.

    A document's ids are those of its whole text (null: empty) and ``end_id``, so every
    document, also an empty one, has a piece; pieces count from 0 and all but the last are
    ``capacity`` long. ``nth`` counts pieces of one length in one ``part`` from 0. The pieces
    are a written table, so whatever reads them again finds the same numbers; null keys and
    repeated rows are documents of their own, an empty table has no pieces, and
    other columns are not read.
    """
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(TextEncoder(tokenizer_path))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = shared.value, TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for first, rows in slices(batch.column(1), SLICE_BYTES):
                ids, offsets = encoder.encode(rows, end_id)
                n = np.diff(offsets)
                pieces = -(-n // capacity)
                doc = np.repeat(np.arange(len(n)), pieces)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * capacity
                length = np.minimum(capacity, n[doc] - start)
                nth = _numbers(length, seen)
                for lo, hi in _runs(length, TOKENS_PER_BATCH):
                    begin = offsets[doc[lo:hi]] + start[lo:hi]
                    flat = ids[begin[0]:begin[-1] + length[hi - 1]].view(np.int32)
                    lists = pa.ListArray.from_arrays(
                        pa.array(np.append(begin, begin[-1] + length[hi - 1]) - begin[0], pa.int32()), pa.array(flat))
                    yield pa.record_batch(
                        [batch.column(0).take(pa.array(first + doc[lo:hi])), pa.array(piece[lo:hi], pa.int32()),
                         pa.array(start[lo:hi]), pa.array(length[lo:hi]), lists,
                         pa.array(np.full(hi - lo, part), pa.int32()), pa.array(nth[lo:hi])],
                        names=["doc_id", "piece", "start", "length", "ids", "part", "nth"])

    rows = df.select(named(key).alias("doc_id"), named(text).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    path = scratch_path(spark, "pieces")
    rows.mapInArrow(cut, f"doc_id {kind}, piece int, start bigint, length bigint, ids array<int>, "
                         "part int, nth bigint").write.parquet(path)
    return spark.read.parquet(path)


def _numbers(length: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Each piece's number among those of its length, from what was ``seen`` before, which is brought up to date."""
    order = np.argsort(length, kind="stable")
    found, first, n = np.unique(length[order], return_index=True, return_counts=True)
    nth = np.empty(len(length), np.int64)
    nth[order] = np.arange(len(length)) - np.repeat(first - seen[found], n)
    seen[found] += n
    return nth


def _runs(length: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of pieces with at most ``most`` tokens, or one piece."""
    after, lo = np.cumsum(length), 0
    while lo < len(length):
        hi = max(lo + 1, int(np.searchsorted(after, (after[lo - 1] if lo else 0) + most, side="right")))
        yield lo, hi
        lo = hi


def fullest(lengths: list[int], left: dict[int, int], free: int) -> list[tuple[int, int]]:
    """(length, copies) of a combination that fills ``free`` as far as any does.

    ``lengths`` descend and ``left`` says how many there are of each. Bit ``s`` of ``reached`` is
    set if some of the lengths looked at add up to ``s``; copies go in powers of two. It stops when
    ``free`` itself is reached, so that small pieces, which fill most gaps, are kept for later."""
    reached, mask, steps = 1, (1 << (free + 1)) - 1, []
    for length in lengths:
        if length > free:
            continue
        most, times = min(left[length], free // length), 1
        while most > 0:
            times = min(times, most)
            steps.append((length, times, reached))
            reached |= (reached << (length * times)) & mask
            most -= times
            times *= 2
        if reached >> free & 1:
            break
    total, chosen = reached.bit_length() - 1, {}
    for length, times, before in reversed(steps):
        if not before >> total & 1:
            total -= length * times
            chosen[length] = chosen.get(length, 0) + times
    return list(chosen.items())


def minimum_bin_slack(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """(bins, [(length, copies), ...]) in the order they are taken, until no piece is left.

    A combination is had again until one of its lengths runs short. A length runs short at most
    1 + log2(capacity / length) times with some left, so the plan does not grow with the counts."""
    left = {length: n for length, n in counts.items() if n > 0}
    lengths, plan = sorted(left, reverse=True), []
    while lengths:
        longest = lengths[0]
        left[longest] -= 1
        chosen = dict(fullest(lengths, left, capacity - longest))
        left[longest] += 1
        chosen[longest] = chosen.get(longest, 0) + 1
        bins = min(left[length] // copies for length, copies in chosen.items())
        for length, copies in chosen.items():
            left[length] -= bins * copies
        if not all(left[length] for length in chosen):
            lengths = [length for length in lengths if left[length]]
        plan.append((bins, sorted(chosen.items(), reverse=True)))
    return plan


def _laid_out(plan) -> dict[str, np.ndarray]:
    """The plan by length and number: from which number on, how many per bin, first bin, and offset in it."""
    used: dict[int, int] = {}
    rows, first = [], 0
    for bins, chosen in plan:
        offset = 0
        for length, copies in chosen:
            rows.append((length, used.get(length, 0), copies, first, offset))
            used[length] = used.get(length, 0) + bins * copies
            offset += length * copies
        first += bins
    rows.sort()
    columns = np.array(rows, np.int64).reshape(-1, 5).T
    return dict(zip(("length", "from", "copies", "bin", "offset"), columns))


#: Numbers within a length stay below this, and lengths below its share of 63 bits.
_NUMBERS = 1 << 48


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` without ``part`` and ``nth``, with ``sequence_id`` and ``offset``.

    ``pieces`` are rows of ``token_pieces``, with or without the ids, and with any further columns of
    other names. Counts by length and part are summed up over the parts of each length, so a length
    that a third of all pieces have is no task of its own; the driver sees one count per length, and
    the plan is broadcast: some 14,000 combinations of 90 lengths at most for 4,096 tokens."""
    spark = pieces.sparkSession
    counts = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = counts.select("length", "part", F.coalesce(F.sum("n").over(
        Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("before"))
    lengths = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    if any(not 0 < length <= capacity for length in lengths):
        raise ValueError(f"pieces must have 1 to {capacity} tokens")
    shared = spark.sparkContext.broadcast(_laid_out(minimum_bin_slack(lengths, capacity)))

    @F.arrow_udf("struct<sequence_id: bigint, offset: bigint>")
    def find(length: pa.Array, number: pa.Array) -> pa.Array:
        plan, length, number = shared.value, length.to_numpy(), number.to_numpy()
        at = np.searchsorted(plan["length"] * _NUMBERS + plan["from"], length * _NUMBERS + number, side="right") - 1
        bins, slot = np.divmod(number - plan["from"][at], plan["copies"][at])
        return pa.StructArray.from_arrays(
            [pa.array(plan["bin"][at] + bins), pa.array(plan["offset"][at] + slot * length)],
            names=["sequence_id", "offset"])

    kept = [named(c) for c in pieces.columns if c not in ("part", "nth")]
    placed = pieces.join(before, ["length", "part"]).withColumn(
        "place", find("length", F.col("before") + F.col("nth")))
    return placed.select(*kept, "place.sequence_id", "place.offset")


def pack(df: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
         key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: ``doc_id``, ``piece``, ``start``, ``length``, ``ids``, ``sequence_id``, ``offset``."""
    return place(token_pieces(df, tokenizer_path, capacity, end_id, key, text), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id``, its ``ids`` in order, and ``doc_ids`` of its pieces; a sequence has at most ``capacity`` tokens."""
    each = F.sort_array(F.collect_list(F.struct("offset", "ids", "doc_id")))
    return packed.groupBy("sequence_id").agg(each.alias("pieces")).select(
        "sequence_id", F.flatten("pieces.ids").alias("ids"), F.col("pieces.doc_id").alias("doc_ids"))


def ids_crc32(ids: Column) -> Column:
    """CRC-32, unsigned, of ids as little-endian unsigned 32-bit numbers."""
    @F.arrow_udf("bigint")
    def crc(lists: pa.Array) -> pa.Array:
        flat, ends = lists.flatten().to_numpy().astype("<u4"), lists.offsets.to_numpy()
        ends = ends - ends[0] if len(ends) else ends
        return pa.array([zlib.crc32(flat[a:b]) for a, b in zip(ends[:-1], ends[1:])], pa.int64())
    return crc(ids)
