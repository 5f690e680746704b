"""Removal of passages that stand earlier in the corpus, by suffix automata of reference shards.

Every run of ``least`` words (a window) is known by its smallest hash of ``GRAM`` words, so
equal windows have equal anchors. Windows whose anchor occurs once in the corpus are unique
and stay. For the others, blocks of documents send the passages around their anchors, each
distinct text once with its earliest place, to the shard that owns the anchor. The shard
builds a suffix automaton of its distinct passages, streams each passage through it, and
replies which windows have an equal one that starts earlier.

A single reference would have to be broadcast to every document, and a corpus that is its own
reference would be read once per shard. Dealing shards and the passages they are matched with
by anchor keeps the work in proportion to the corpus.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ensemblescore.llm import blocks
from ensemblescore.llm.automaton import SuffixAutomaton
from ensemblescore.llm.text import slices, sums, words

LEAST = 20
GRAM = 8

#: Text in a block. Windows are several arrays of a block's length at once.
BLOCK_BYTES = 8 << 20

#: An anchor met at more places than this has its windows sent one by one under their own
#: hashes, so that no shard gathers them all. It decides where windows meet, not what is found.
CROWD = 4096

RESULT = "n_words bigint, n_removed bigint, kept string"

_STEP = np.uint64(0x9E3779B97F4A7C15)
_NONE = np.iinfo(np.int64).max


def _rolled(values: np.ndarray, n: int) -> np.ndarray:
    """A hash of every ``n`` neighbouring values."""
    out = np.zeros(max(0, len(values) - n + 1), np.uint64)
    for i in range(n):
        out = out * _STEP + values[i:len(values) - n + 1 + i]
    return out ^ (out >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)


def _lowest(values: np.ndarray, n: int) -> np.ndarray:
    """The place of the first smallest of every ``n`` neighbouring values."""
    def lower(left, right):
        return np.where(values[left] <= values[right], left, right)

    reach, out = 1, np.arange(len(values))
    while 2 * reach <= n:
        out = lower(out[:-reach], out[reach:])
        reach *= 2
    return lower(out[:len(values) - n + 1], out[n - reach:]) if reach < n else out


class _Block:
    """A block's words, and its windows with their anchors."""

    def __init__(self, table: pa.Table, least: int):
        self.table, self.least = table, least
        text = pc.fill_null(table["text"].combine_chunks().cast(pa.large_string()), "")
        parts = [words(rows) for _, rows in slices(text)]
        self.words = pa.chunked_array([w for w, _ in parts], pa.large_string()).combine_chunks()
        self.n_words = np.concatenate([n for _, n in parts] or [np.zeros(0, np.int64)]).astype(np.int64)
        coded = self.words.dictionary_encode()
        hashes = blocks.string_hashes(coded.dictionary) if len(coded.dictionary) else np.zeros(0, np.uint64)
        self.hashes = hashes[coded.indices.to_numpy(zero_copy_only=False)] if len(self.words) else hashes
        self.row = np.repeat(np.arange(len(self.n_words)), self.n_words)
        self.first_word = np.cumsum(self.n_words) - self.n_words
        n = len(self.words)
        gram = min(GRAM, least)
        if n < least:
            self.windows, self.anchors = np.zeros(0, np.int64), np.zeros(0, np.uint64)
            self.new = np.zeros(0, bool)
            return
        grams = _rolled(self.hashes, gram)
        place = _lowest(grams, least - gram + 1)
        self.windows = np.flatnonzero(self.row[:n - least + 1] == self.row[least - 1:])
        place = place[self.windows]
        self.anchors = grams[place]
        # A stretch of windows around one place of an anchor. No two windows of one are equal,
        # since equal windows have their anchor at the same distance from their start.
        self.new = np.ones(len(place), bool)
        self.new[1:] = (place[1:] != place[:-1]) | (self.windows[1:] != self.windows[:-1] + 1)

    def asked(self, n_buckets: int):
        """Distinct anchors in order, of each window its place among them, their stretches, and buckets."""
        distinct, found = np.unique(self.anchors, return_inverse=True)
        counts = np.bincount(found[self.new], minlength=len(distinct))
        return distinct, found, counts, blocks.by_hash(distinct, n_buckets)

    def passages(self, replies: list[bytes], n_buckets: int) -> dict:
        """The stretches of windows that share a repeated anchor, and the distinct texts of them."""
        distinct, found, _, _ = self.asked(n_buckets)
        kinds = np.concatenate([blocks.unpack_arrays(r)["kind"] for r in replies] or [np.zeros(0, np.int8)])
        kind = kinds[found]
        keep = kind > 0
        window, anchor, crowded = self.windows[keep], self.anchors[keep], kind[keep] == 2
        start = np.flatnonzero(self.new[keep] | crowded)
        n_windows = np.diff(np.append(start, len(window)))
        first = window[start]
        owner = anchor[start]
        crowd = crowded[start]
        if crowd.any():
            owner[crowd] = _rolled(self.hashes, self.least)[first[crowd]]

        one = pa.LargeListArray.from_arrays(pa.array([0, len(self.words)], pa.int64()), self.words)
        joined = pc.binary_join(one, pa.scalar(" ", pa.large_string()))[0].as_buffer()
        size = pc.binary_length(self.words).to_numpy(zero_copy_only=False).astype(np.int64)
        at = np.concatenate([[0], np.cumsum(size + 1)])
        view = memoryview(joined)
        lo, hi = at[first].tolist(), (at[first + n_windows + self.least - 1] - 1).tolist()
        texts = [bytes(view[a:b]) for a, b in zip(lo, hi)]
        code, _ = pd.factorize(np.array(texts, dtype=object)) if texts else (np.zeros(0, np.int64), None)
        doc = np.where(self.table["order"].is_null().to_numpy(), _NONE,
                       pc.fill_null(self.table["order"], 0).to_numpy())[self.row[first]] if len(first) else first
        where = first - self.first_word[self.row[first]] if len(first) else first
        # The earliest stretch of each text stands for it.
        order = np.lexsort((where, doc, code))
        lead = order[np.flatnonzero(np.diff(code[order], prepend=-1))] if len(order) else order
        bucket = blocks.by_hash(owner[lead], n_buckets)
        lead = lead[np.lexsort((where[lead], doc[lead], owner[lead], bucket))]
        return {"first": first, "n_windows": n_windows, "code": code, "doc": doc, "where": where, "owner": owner,
                "texts": texts, "lead": lead, "bucket": blocks.by_hash(owner[lead], n_buckets)}


def _ask_anchors(n_buckets: int, least: int):
    def asks(table):
        distinct, _, counts, bucket = _Block(table, least).asked(n_buckets)
        for b, rows in blocks.ranges(bucket):
            yield b, blocks.pack_arrays(step=np.diff(distinct[rows], prepend=np.uint64(0)),
                                        count=counts[rows].astype(np.int32))
    return asks


def _answer_anchors(crowd: int):
    def answers(bucket, payloads):
        """0 for the anchor of a single stretch, 2 for a crowd, else 1."""
        asked = [blocks.unpack_arrays(p) for p in payloads]
        distinct, found = np.unique(np.concatenate([np.cumsum(a["step"], dtype=np.uint64) for a in asked]),
                                    return_inverse=True)
        totals = np.bincount(found, weights=np.concatenate([a["count"] for a in asked]))
        kind = (totals > 1).astype(np.int8) + (totals > crowd)
        out, at = [], 0
        for a in asked:
            out.append(blocks.pack_arrays(kind=kind[found[at:at + len(a["step"])]]))
            at += len(a["step"])
        return out
    return answers


def _ask_passages(n_buckets: int, least: int):
    def asks(table, replies):
        p = _Block(table, least).passages(replies, n_buckets)
        for b, rows in blocks.ranges(p["bucket"]):
            lead = p["lead"][rows]
            yield b, blocks.pack(pa.table({
                "owner": p["owner"][lead], "doc": p["doc"][lead], "where": p["where"][lead],
                "text": pa.array([p["texts"][i] for i in lead.tolist()], pa.large_binary())}))
    return asks


def _earlier(shard: list[tuple[list[int], int, int]], least: int) -> list[list[int]]:
    """For passages (words, document, first word), the windows of each that stand earlier in one of them."""
    automaton = SuffixAutomaton()
    for symbols, doc, where in shard:
        automaton.add(symbols, [(doc, where + i) for i in range(len(symbols))])
    automaton.settle()
    return [[i - least + 1 for i, earliest in enumerate(automaton.statistics(symbols, least))
             if earliest is not None and earliest < (doc, where + i)] for symbols, doc, where in shard]


def _answer_passages(least: int):
    def answers(bucket, payloads):
        asked = [blocks.unpack(p) for p in payloads]
        all_ = pa.concat_tables(asked).combine_chunks()
        owner, doc, where = (all_[c].to_numpy() for c in ("owner", "doc", "where"))
        code = all_["text"].combine_chunks().dictionary_encode()
        texts, code = code.dictionary, code.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        # Of equal passages, all but the earliest are repeated from end to end.
        order = np.lexsort((where, doc, code))
        lead = order[np.flatnonzero(np.diff(code[order], prepend=-1))] if len(order) else order
        first_doc, first_where = np.empty(len(texts), np.int64), np.empty(len(texts), np.int64)
        first_doc[code[lead]], first_where[code[lead]] = doc[lead], where[lead]
        whole = (doc != first_doc[code]) | (where != first_where[code])
        # Shards with several different passages are matched by an automaton each.
        shards = defaultdict(list)
        for i in lead[np.lexsort((where[lead], doc[lead]))].tolist():
            shards[int(owner[i])].append(i)
        removed: dict[int, list[int]] = {}
        for members in shards.values():
            # No two windows of one passage are equal, so one passage alone repeats nothing.
            if len(members) == 1:
                continue
            numbers: dict[bytes, int] = {}
            passages = [([numbers.setdefault(w, len(numbers)) for w in texts[int(code[i])].as_py().split(b" ")],
                         int(doc[i]), int(where[i])) for i in members]
            for i, some in zip(members, _earlier(passages, least)):
                if some:
                    removed[int(code[i])] = some
        out, at = [], 0
        for a in asked:
            n = a.num_rows
            some = [removed.get(c, []) for c in code[at:at + n].tolist()]
            out.append(blocks.pack(pa.table({"whole": whole[at:at + n], "some": pa.array(some, pa.list_(pa.int32()))})))
            at += n
        return out
    return answers


def _remove(n_buckets: int, least: int):
    def finishes(table, replies):
        rounds = {"kind": [], "whole": []}
        for r in replies:
            rounds[blocks.unpack(r).column_names[0]].append(r)
        block = _Block(table, least)
        p = block.passages(rounds["kind"], n_buckets)
        step = np.zeros(len(block.words) + 1, np.int64)
        if rounds["whole"]:
            told = pa.concat_tables([blocks.unpack(r) for r in rounds["whole"]])
            n_codes = int(p["code"].max()) + 1
            whole, some = np.zeros(n_codes, bool), np.zeros(n_codes, np.int64)
            lead_doc, lead_where = np.zeros(n_codes, np.int64), np.zeros(n_codes, np.int64)
            of = p["code"][p["lead"]]
            whole[of] = told["whole"].to_numpy()
            some[of] = np.arange(len(of))
            lead_doc[of], lead_where[of] = p["doc"][p["lead"]], p["where"][p["lead"]]
            code = p["code"]
            all_of_it = whole[code] | (p["doc"] != lead_doc[code]) | (p["where"] != lead_where[code])
            np.add.at(step, p["first"][all_of_it], 1)
            np.add.at(step, p["first"][all_of_it] + p["n_windows"][all_of_it] + least - 1, -1)
            lists = told["some"].to_pylist()
            for i in np.flatnonzero(~all_of_it).tolist():
                for w in lists[some[code[i]]]:
                    step[p["first"][i] + w] += 1
                    step[p["first"][i] + w + least] -= 1
        gone = np.cumsum(step)[:-1] > 0
        kept = block.words.filter(pa.array(~gone))
        n_removed = sums(gone, block.n_words)
        ends = np.concatenate([[0], np.cumsum(block.n_words - n_removed)])
        text = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), kept),
                              pa.scalar(" ", pa.large_string()))
        return pa.table({"row": table["row"], "n_words": block.n_words, "n_removed": n_removed,
                         "kept": text.cast(pa.string())})
    return finishes


def _judged(df: DataFrame, key: str, text: str, least: int, row: list[int], block_bytes: int, crowd: int) -> DataFrame:
    """``row``, a struct of the columns asked for, with ``n_words``, ``n_removed`` and ``kept``.

    Columns are asked for by their places, which name the struct's fields: they may share names and hold maps."""
    placed = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    order, words = (F.col(f"c{df.columns.index(c)}") for c in (key, text))
    rows = placed.select(F.struct(*[f"c{i}" for i in row]).alias("row"), order.cast("bigint").alias("order"),
                         words.cast("string").alias("text"))
    n = blocks.count_blocks(rows, F.col("text"), block_bytes)
    dealt = blocks.deal(rows, n, ["order", "text"])
    first = blocks.answer(blocks.ask(dealt, _ask_anchors(n, least)), n, _answer_anchors(crowd))
    second = blocks.answer(blocks.ask_again(dealt, first, _ask_passages(n, least)), n, _answer_passages(least))
    kind = rows.schema["row"].dataType.simpleString()
    return blocks.finish(dealt, first.unionByName(second), f"row {kind}, {RESULT}", _remove(n, least))


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST,
                   block_bytes: int = BLOCK_BYTES, crowd: int = CROWD) -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``n_removed`` and ``kept``.

    A word goes if it lies in a window of ``least`` consecutive words that also starts
    earlier: in a document of smaller key, or before in the same one. Windows are judged on
    the input. ``kept`` are the words left, joined by one space. Keys are whole numbers; a null
    key comes after all others, and rows of one key count as the same document, so a window at
    the same place of both goes from neither. Null and empty texts have no words; an empty
    table gives no rows.

    Equal words are decided on the words themselves; hashes only choose where they meet.
    """
    own = df.columns.index(key)
    return _judged(df, key, text, least, [own], block_bytes, crowd).select(
        F.col("row")[f"c{own}"].alias("doc_id"), "n_words", "n_removed", "kept")


def without_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST,
                    block_bytes: int = BLOCK_BYTES, crowd: int = CROWD) -> DataFrame:
    """The rows of ``df`` with the words that ``remove_repeats`` leaves, in the same columns.

    A text that loses nothing stays as it is, white space included; one that loses all is empty.
    """
    out = _judged(df, key, text, least, list(range(len(df.columns))), block_bytes, crowd)
    at = df.columns.index(text)
    left = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("row")[f"c{at}"])
    return out.select(*[(left if i == at else F.col("row")[f"c{i}"]).alias(c) for i, c in enumerate(df.columns)])
