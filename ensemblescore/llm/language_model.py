"""Bigram language model over a whole corpus, scored by a weighted backoff automaton.

States are the start of a text and its words. A state's arcs are the word pairs seen in
training, weighted by their smoothed log-probability; a pair without an arc takes the
state's failure arc to the root, weighted by the mass the state keeps for that, and then the
root's arc of the word. One pass from left to right carries the state and adds up the weights.

    p(w | v) = (c(v w) + PRIOR * p(w)) / (c(v) + PRIOR)        p(w) = (c(w) + 1) / (N + V + 1)

so every state's arcs and failure arc sum to one over the training words and one unknown.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ensemblescore.llm import blocks
from ensemblescore.llm.text import slices, sums, words
from ensemblescore.sources.scratch import ensure_checkpoint_dir

#: Pseudo-count of the root's distribution in every state.
PRIOR = 100.0

#: Text in a block. Pairs of words are several arrays of a block's length at once.
BLOCK_BYTES = 8 << 20

#: Numbers of the start and the end of a text; words follow.
START, END, FIRST = 0, 1, 2

RESULT = "n_tokens bigint, n_known bigint, base_score double, score double"


@dataclass(frozen=True)
class Totals:
    """What is known of the whole corpus: training documents, tokens with ends, distinct tokens."""

    documents: int
    tokens: int
    distinct: int
    numbers: int


def _mix(keys: np.ndarray) -> np.ndarray:
    """Spread 64-bit keys evenly, one to one."""
    x = keys.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Block:
    """A block's words as codes of its distinct words in hash order."""

    def __init__(self, table: pa.Table):
        self.table = table
        text = pc.ascii_lower(pc.fill_null(table["text"].combine_chunks().cast(pa.large_string()), ""))
        parts = [words(rows) for _, rows in slices(text)]
        coded = pa.chunked_array([w for w, _ in parts], pa.large_string()).combine_chunks().dictionary_encode()
        order, self.hashes = blocks.in_hash_order(coded.dictionary)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.words = coded.dictionary.take(pa.array(order))
        self.codes = place[coded.indices.to_numpy(zero_copy_only=False)]
        self.n_words = np.concatenate([n for _, n in parts] or [np.zeros(0, np.int64)]).astype(np.int64)
        self.trains = table["trains"].to_numpy()

    def read(self, replies: list[bytes]) -> None:
        """Numbers and training counts of the block's distinct words."""
        read = [blocks.unpack_arrays(r) for r in replies]
        none = [np.zeros(0, np.int64)]
        self.numbers = np.concatenate([r["number"] for r in read] or none)
        self.counts = np.concatenate([r["count"] for r in read] or none)

    def pairs(self, totals: Totals) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of (state, token) for every token of the block, the token's document, and pair keys."""
        n_tokens = self.n_words + 1
        ends = np.cumsum(n_tokens)
        token = np.full(int(n_tokens.sum()), END, np.int64)
        inner = np.ones(len(token), bool)
        inner[ends - 1] = False
        token[inner] = self.numbers[self.codes]
        state = np.empty_like(token)
        state[1:] = token[:-1]
        state[ends - n_tokens] = START
        if totals.numbers >= 1 << 32:
            raise ValueError("word numbers must fit in 32 bits")
        keys = state.astype(np.uint64) * np.uint64(totals.numbers) + token.astype(np.uint64)
        return state, token, inner, keys

    def distinct_pairs(self, keys: np.ndarray, n_buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct pair keys by bucket and value, their buckets, and their counts in training."""
        distinct, found = np.unique(keys, return_inverse=True)
        own = np.repeat(self.trains, self.n_words + 1)
        counts = np.bincount(found[own], minlength=len(distinct))
        bucket = blocks.by_hash(_mix(distinct), n_buckets)
        order = np.argsort(bucket, kind="stable")
        return distinct[order], bucket[order], counts[order]


def _ask_words(n_buckets: int):
    def asks(table):
        block = _Block(table)
        own = np.repeat(block.trains, block.n_words)
        counts = np.bincount(block.codes[own], minlength=len(block.words)).astype(np.int64)
        for bucket, rows in blocks.ranges(blocks.by_hash(block.hashes, n_buckets)):
            yield bucket, blocks.pack(pa.table({"word": block.words[rows], "count": counts[rows]}))
    return asks


def _answer_words(n_buckets: int):
    def answers(bucket, payloads):
        asked = [blocks.unpack(p) for p in payloads]
        coded = pa.concat_tables(asked)["word"].combine_chunks().dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        own = pa.concat_tables(asked)["count"].to_numpy()
        totals = np.bincount(codes, weights=own, minlength=len(coded.dictionary)).astype(np.int64)
        order, _ = blocks.in_hash_order(coded.dictionary)
        numbers = np.empty(len(order), np.int64)
        numbers[order] = np.arange(len(order)) * n_buckets + bucket + FIRST
        out, at = [], 0
        for a in asked:
            c = codes[at:at + a.num_rows]
            out.append(blocks.pack_arrays(number=numbers[c], count=totals[c]))
            at += a.num_rows
        out.append(blocks.pack_arrays(tokens=[int(totals.sum())], distinct=[int((totals > 0).sum())],
                                      numbers=[len(order) * n_buckets + bucket + FIRST]))
        return out
    return answers


def _ask_pairs(n_buckets: int, totals: Totals):
    def asks(table, replies):
        block = _Block(table)
        block.read(replies)
        keys, bucket, counts = block.distinct_pairs(block.pairs(totals)[3], n_buckets)
        for b, rows in blocks.ranges(bucket):
            k = keys[rows]
            yield b, blocks.pack_arrays(step=np.diff(k, prepend=np.uint64(0)), count=counts[rows].astype(np.int32))
    return asks


def _answer_pairs(bucket, payloads):
    """Totals of the pairs whose training count differs from what the block has itself."""
    asked = [blocks.unpack_arrays(p) for p in payloads]
    keys = [np.cumsum(a["step"], dtype=np.uint64) for a in asked]
    distinct, found = np.unique(np.concatenate(keys), return_inverse=True)
    totals = np.bincount(found, weights=np.concatenate([a["count"] for a in asked])).astype(np.int64)
    out, at = [], 0
    for a in asked:
        n = len(a["step"])
        total = totals[found[at:at + n]]
        more = np.flatnonzero(total != a["count"])
        out.append(blocks.pack_arrays(at=more.astype(np.int32), count=total[more]))
        at += n
    return out


def _score(n_buckets: int, totals: Totals):
    def finishes(table, replies):
        rounds = {1: [], 2: []}
        for r in replies:
            names = blocks.unpack(r).column_names
            rounds[1 if "number" in names else 2].append(r)
        block = _Block(table)
        block.read(rounds[1])
        state, token, inner, keys = block.pairs(totals)
        arcs, bucket, counts = block.distinct_pairs(keys, n_buckets)
        for (_, rows), reply in zip(blocks.ranges(bucket), rounds[2]):
            read = blocks.unpack_arrays(reply)
            counts[rows.start + read["at"]] = read["count"]

        # The root's arcs, and how often each token and each state was seen in training.
        seen = np.full(len(token), totals.documents, np.int64)
        seen[inner] = block.counts[block.codes]
        visits = np.empty_like(seen)
        visits[1:] = seen[:-1]
        visits[state == START] = totals.documents
        root = (seen + 1) / (totals.tokens + totals.distinct + 1)

        # A pair with an arc takes it; any other takes the failure arc and then the root's arc.
        order = np.argsort(arcs)
        arc = counts[order[np.searchsorted(arcs, keys, sorter=order)]] if len(keys) else seen
        mass = PRIOR / (visits + PRIOR)
        weight = np.where(arc > 0, np.log10((arc + PRIOR * root) / (visits + PRIOR)),
                          np.log10(mass) + np.log10(root))
        n_tokens = block.n_words + 1
        return pa.table({
            "doc_id": table["doc_id"], "held_out": table["held_out"], "n_tokens": n_tokens,
            "n_known": sums(seen > 0, n_tokens),
            "base_score": np.add.reduceat(np.log10(root), np.cumsum(n_tokens) - n_tokens) if len(n_tokens) else [],
            "score": np.add.reduceat(weight, np.cumsum(n_tokens) - n_tokens) if len(n_tokens) else []})
    return finishes


def score(df: DataFrame, held_out, key: str = "doc_id", text: str = "text",
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Learn from the documents that are not ``held_out`` (a boolean column) and score all.

    One row per document: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known`` (seen in
    training), ``train_tokens``, ``base_score`` (the root alone) and ``score``, both log10.
    Tokens are words parted by ASCII white space, A-Z lower-cased, and one end per text. No
    count is cut: every word and every pair of the training texts is in the automaton, and a
    block of documents holds the part of it that its own pairs reach. A null text counts as
    empty and has the end alone; a null ``held_out`` trains; null keys and repeated rows are
    kept; with nothing to learn from all words are unknown; an empty table gives no rows.
    """
    ensure_checkpoint_dir(df.sparkSession)
    held = F.coalesce(held_out, F.lit(False))
    rows = df.select(df[key].alias("doc_id"), F.coalesce(df[text].cast("string"), F.lit("")).alias("text"), held.alias("held_out"))
    size, n_train = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)),
                             F.count_if(~F.col("held_out"))).first()
    n = max(1, -(-size // block_bytes))
    dealt = blocks.deal(rows.withColumn("trains", ~F.col("held_out")), n)

    first = blocks.answer(blocks.ask(dealt, _ask_words(n)), n, _answer_words(n)).checkpoint()
    found = [blocks.unpack_arrays(r["payload"]) for r in first.where("block = -1").toLocalIterator()]
    tokens = sum(int(f["tokens"][0]) for f in found) + n_train
    totals = Totals(n_train, tokens, sum(int(f["distinct"][0]) for f in found) + (n_train > 0),
                    max([FIRST, *(int(f["numbers"][0]) for f in found)]))

    replies = first.where("block >= 0")
    second = blocks.answer(blocks.ask_again(dealt, replies, _ask_pairs(n, totals)), n, _answer_pairs)
    kind = df.select(df[key]).schema[0].dataType.simpleString()
    scored = blocks.finish(dealt, replies.unionByName(second), f"doc_id {kind}, held_out boolean, {RESULT}",
                           _score(n, totals))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("bigint").alias("train_tokens"),
                         "base_score", "score")
