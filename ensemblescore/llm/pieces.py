"""SentencePiece ids of whole texts, through a table of distinct marked words."""

from __future__ import annotations

import re
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ensemblescore.llm import blocks
from ensemblescore.llm.text import slices, sums

MARK = "▁"
_RUNS = re.compile(" +[^ ]*")

#: Text in a block. Ids are several times as long as their words.
BLOCK_BYTES = 8 << 20

#: Words whose ids are joined at a time.
_AT_ONCE = 200_000


@cache
def _opened(content: bytes) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_proto=content)


def _check(model: sentencepiece.SentencePieceProcessor) -> None:
    """Words may be segmented apart only if no piece holds a mark after another character,
    the mark is put before a text and nothing else is normalised."""
    if any(re.search(f"[^{MARK}]{MARK}", model.id_to_piece(i)) for i in range(model.get_piece_size())):
        raise ValueError("a piece of this model crosses a white space mark")
    for sample in ("a  b ", " a", "é　ﬁ\x00"):
        marked = "".join(model.id_to_piece(i) for i in model.encode(sample, out_type=int))
        plain = MARK + sample.replace(" ", MARK)
        fallback = re.sub("((?:<0x[0-9A-F]{2}>)+)", lambda m: bytes(
            int(h, 16) for h in re.findall("<0x(..)>", m[1])).decode(), marked)
        if fallback != plain and "<unk>" not in marked:
            raise ValueError("this model normalises texts; words cannot be taken apart first")


def _marked_words(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Marked words in order, each without its first mark, and how many each text has.

    A marked word is a run of marks and the characters up to the next mark. A mark in a text
    reads as a space, as the library takes it."""
    text = pc.replace_substring(text, MARK, " ")
    plain = pc.invert(pc.or_(pc.match_substring(text, "  "), pc.or_(
        pc.starts_with(text, " "), pc.ends_with(text, " ")))).to_numpy(zero_copy_only=False)
    parts = pc.split_pattern(text, " ")
    counts = np.diff(parts.offsets.to_numpy())
    counts[pc.equal(pc.binary_length(text), 0).to_numpy(zero_copy_only=False)] = 0
    if plain.all() and (counts > 0).all():
        return parts.flatten(), counts
    lists = [p if ok and n else [r[1:] for r in _RUNS.findall(" " + t)] if n else []
             for p, ok, n, t in zip(parts.to_pylist(), plain, counts, text.to_pylist())]
    return (pa.array([w for row in lists for w in row], pa.large_string()),
            np.array([len(row) for row in lists], np.int64))


def _of_block(table: pa.Table) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All marked words of a block's documents as codes, and how many each document has."""
    text = pc.fill_null(table["text"].combine_chunks().cast(pa.large_string()), "")
    parts = [_marked_words(rows) for _, rows in slices(text)]
    words = pa.chunked_array([w for w, _ in parts], pa.large_string()).combine_chunks()
    return words.dictionary_encode(), np.concatenate([n for _, n in parts] or [np.zeros(0, np.int64)])


def _packed_ids(ids: pa.ListArray) -> bytes:
    """Lists of ids as their lengths and their values, in the narrowest types that hold them."""
    def whole(values):
        values = values.to_numpy(zero_copy_only=False)
        values = values.astype(np.min_scalar_type(int(values.max(initial=0))))
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values))
    return blocks.pack(pa.table({"lengths": whole(ids.value_lengths()), "ids": whole(ids.flatten())}))


def _read_ids(replies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and values of all lists of some replies, in their order."""
    tables = [blocks.unpack(r) for r in replies]
    lengths = [t["lengths"].combine_chunks().flatten().to_numpy() for t in tables]
    values = [t["ids"].combine_chunks().flatten().to_numpy() for t in tables]
    offsets = np.concatenate([[0], np.cumsum(np.concatenate(lengths or [[]]), dtype=np.int64)])
    return offsets, np.concatenate([v.astype(np.int32) for v in values] or [np.zeros(0, np.int32)])


def _joined(offsets: np.ndarray, values: np.ndarray, row: np.ndarray, counts: np.ndarray, end: int) -> pa.ChunkedArray:
    """The ids of each document's words, by position, each followed by an end id; some documents at a time."""
    first_word = np.concatenate([[0], np.cumsum(counts)])
    chunks, start = [], 0
    while start < len(counts):
        stop = max(start + 1, int(np.searchsorted(first_word, first_word[start] + _AT_ONCE, side="right")) - 1)
        own = row[first_word[start]:first_word[stop]]
        lengths = offsets[own + 1] - offsets[own]
        n_ids = sums(lengths, counts[start:stop])
        out = np.full(int(n_ids.sum()) + stop - start, end, np.int32)
        before = np.cumsum(lengths) - lengths
        at = np.repeat(offsets[own] - before, lengths) + np.arange(int(lengths.sum()))
        shift = np.repeat(np.arange(stop - start), n_ids)
        out[np.arange(len(at)) + shift] = values[at]
        ends = np.concatenate([[0], np.cumsum(n_ids + 1)])
        chunks.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(out)))
        start = stop
    return pa.chunked_array(chunks, pa.list_(pa.int32()))


def encode(df: DataFrame, model_path: str, key: str = "doc_id", text: str = "text",
           decoded: bool = False, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: ``doc_id`` and ``ids``, as the library encodes the whole text, and an end id.
    With ``decoded`` also ``decoded``, the text that the library decodes the ids to.

    No piece crosses a white space mark (checked), so merges in one marked word never depend
    on another. Every distinct marked word of the table is segmented once; blocks of documents
    ask for theirs and join the ids back by position. A null text counts as empty and has the
    end id alone; null keys and repeated rows are kept; an empty table gives no rows.
    """
    content = Path(model_path).read_bytes()
    _check(_opened(content))
    shared = df.sparkSession.sparkContext.broadcast(content)
    n = blocks.count_blocks(df, df[text], block_bytes)
    dealt = blocks.deal(df.select(df[key].alias("doc_id"), df[text].cast("string").alias("text")), n)

    def asks(table):
        words = _of_block(table)[0].dictionary
        order, buckets = blocks.in_bucket_order(words, n)
        words = words.take(pa.array(order))
        for bucket, rows in blocks.ranges(buckets):
            yield bucket, blocks.pack(pa.table({"word": words[rows]}))

    def answers(bucket, payloads):
        model = _opened(shared.value)
        asked = [blocks.unpack(p)["word"] for p in payloads]
        words = pa.chunked_array([c for a in asked for c in a.chunks], pa.large_string()).combine_chunks().dictionary_encode()
        lone = model.piece_to_id(MARK)
        ids = pa.array([ids if w else [lone] for w, ids in (
            (w, model.encode(w)) for w in words.dictionary.to_pylist())], pa.list_(pa.int32()))
        at = 0
        for a in asked:
            yield _packed_ids(ids.take(words.indices[at:at + len(a)]))
            at += len(a)

    def finishes(table, replies):
        words, counts = _of_block(table)
        order, _ = blocks.in_bucket_order(words.dictionary, n)
        offsets, values = _read_ids(replies)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        row = place[words.indices.to_numpy(zero_copy_only=False)]
        model = _opened(shared.value)
        del words
        ids = _joined(offsets, values, row, counts, model.eos_id())
        out = {"doc_id": table["doc_id"], "ids": ids}
        if decoded:
            out["decoded"] = pa.chunked_array([_decoded(model, c) for c in ids.chunks], pa.string())
        return pa.table(out)

    replies = blocks.answer(blocks.ask(dealt, asks), n, lambda b, p: list(answers(b, p)))
    kind = df.select(df[key]).schema[0].dataType.simpleString()
    text_too = ", decoded string" if decoded else ""
    return blocks.finish(dealt, replies, f"doc_id {kind}, ids array<int>{text_too}", finishes)


def _decoded(model: sentencepiece.SentencePieceProcessor, ids: pa.ListArray) -> pa.Array:
    """Texts of lists of ids; one list at a time becomes Python numbers."""
    offsets, values, null = ids.offsets.to_numpy(), ids.values.to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)
    return pa.array([None if none else model.decode(values[lo:hi].tolist())
                     for none, lo, hi in zip(null, offsets, offsets[1:])], pa.string())


def _decoder(shared: Broadcast):
    def run(ids: pa.Array) -> pa.Array:
        return _decoded(_opened(shared.value), ids)
    return run


def decode(df: DataFrame, ids: str | Column, model_path: str) -> Column:
    """The text of a column of ids, as the library decodes them; null for null."""
    shared = df.sparkSession.sparkContext.broadcast(Path(model_path).read_bytes())
    return F.arrow_udf(_decoder(shared), "string")(ids)
