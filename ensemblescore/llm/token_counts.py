"""Token counts through a cache keyed by digests of content and of the tokenizer."""

from __future__ import annotations

import hashlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tokenizers
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ensemblescore.llm.text import slices, sums
from ensemblescore.sources.scratch import scratch_path

CACHE = "tokenizer string, digest binary, n_tokens bigint"

#: Everything that some tokenizer takes for white space.
_SPACE = " \\t\\n\\x0b\\x0c\\r\\x1c-\\x1f" + "".join(
    map(chr, [0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F, 0x205F, 0x2060, 0x3000, 0xFEFF]))
_JOINED_SPACES = f"[{_SPACE}] | [{_SPACE}]"

#: Counts of words met by this Python worker, forgotten when there are too many.
_known: dict[str, dict[str, int]] = {}
_MOST_KNOWN = 200_000


class Tokenizer:
    """A tokenizer file's bytes, its version digest, and the counting of a batch of texts."""

    def __init__(self, path: str):
        self.content = Path(path).read_bytes()
        self.kind = "json" if path.endswith(".json") else "model"
        library = tokenizers if self.kind == "json" else sentencepiece
        self.version = hashlib.sha256(
            self.content + f"{library.__name__} {library.__version__}".encode()).hexdigest()

    def open(self):
        if self.kind == "model":
            model = sentencepiece.SentencePieceProcessor(model_proto=self.content)
            return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)], False
        model = tokenizers.Tokenizer.from_str(self.content.decode())
        model.no_truncation()
        model.no_padding()

        def count(texts):
            return [len(e) for e in model.encode_batch_fast(texts, add_special_tokens=False)]

        return count, _splits_at_spaces(model)


def _splits_at_spaces(model: tokenizers.Tokenizer) -> bool:
    """Whether a lone space between visible characters always starts a token of its own word.

    So it is for byte-level pre-tokenizers with their pattern, no normalizer, no added prefix
    and no added token with a space; then a text's count is the sum of its words' counts."""
    kind = model.pre_tokenizer.__class__.__name__
    added = model.get_added_tokens_decoder().values()
    return (kind == "ByteLevel" and model.normalizer is None and model.pre_tokenizer.use_regex
            and not model.pre_tokenizer.add_prefix_space
            and not any(t.lstrip or t.rstrip or t.single_word or " " in t.content for t in added))


def _by_words(texts: pa.Array, count, known: dict[str, int]) -> np.ndarray:
    """Counts of texts without joined spaces, as sums over words with the space before them."""
    parts = pc.split_pattern(texts, " ")
    flat = parts.flatten()
    n_parts = np.diff(parts.offsets.to_numpy())
    first = np.zeros(len(flat), bool)
    first[(np.cumsum(n_parts) - n_parts)[n_parts > 0]] = True
    glued = pc.binary_join_element_wise(
        pc.if_else(pa.array(first), pa.scalar("", flat.type), pa.scalar(" ", flat.type)), flat,
        pa.scalar("", flat.type))
    coded = glued.dictionary_encode()
    words = coded.dictionary.to_pylist()
    missing = [w for w in words if w not in known]
    if len(known) + len(missing) > _MOST_KNOWN:
        known.clear()
        missing = words
    known.update(zip(missing, count(missing)))
    per_word = np.fromiter((known[w] for w in words), np.int64, len(words))
    return sums(per_word[coded.indices.to_numpy(zero_copy_only=False)], n_parts)


def _counter(shared: Broadcast):
    def count_tokens(text: pa.Array) -> pa.Array:
        tokenizer: Tokenizer = shared.value
        opened = getattr(tokenizer, "_opened", None)
        if opened is None:
            opened = tokenizer._opened = tokenizer.open()
        count, by_words = opened
        known = _known.setdefault(tokenizer.version, {})
        out = [np.zeros(0, np.int64)]
        for _, rows in slices(text):
            if not by_words:
                out.append(np.array(count(rows.to_pylist()), np.int64))
                continue
            whole = pc.match_substring_regex(rows, _JOINED_SPACES)
            pick = whole.to_numpy(zero_copy_only=False)
            counts = np.zeros(len(rows), np.int64)
            counts[~pick] = _by_words(rows.filter(pc.invert(whole)), count, known)
            if pick.any():
                counts[pick] = count(rows.filter(whole).to_pylist())
            out.append(counts)
        return pa.array(np.concatenate(out))
    return count_tokens


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """The cache's rows, one per tokenizer and digest; a folder not yet there is an empty cache."""
    try:
        rows = spark.read.schema(CACHE).parquet(path)
    except AnalysisException as fault:
        if fault.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], CACHE)
    return rows.groupBy("tokenizer", "digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(df: DataFrame, tokenizer_path: str, cache_path: str | None = None, key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``n_bytes`` of UTF-8 and ``n_tokens``.

    Content is looked up by its SHA-256 (null counts as empty; nothing else is normalised,
    since byte-level tokens see every byte) and the tokenizer's version, a digest of its file
    and library. Digests without a stored count are encoded once each, however many rows
    share them, and appended to the cache by this call before it returns; a cache that two
    jobs append to at once may hold a digest twice, with the same count. Without a
    ``cache_path`` a new cache in the shared folder is used. Special strings inside a text
    are read as the library does by default; nothing is added or cut. Null keys and
    repeated rows are kept; an empty table gives no rows.
    """
    spark = df.sparkSession
    tokenizer = Tokenizer(tokenizer_path)
    cache_path = cache_path or scratch_path(spark, "token-counts")
    content = F.coalesce(df[text].cast("string"), F.lit(""))
    rows = df.select(df[key].alias("doc_id"), F.octet_length(content).cast("bigint").alias("n_bytes"),
                     F.unhex(F.sha2(content, 256)).alias("digest"), content.alias("content"))
    of_version = F.col("tokenizer") == tokenizer.version

    known = read_cache(spark, cache_path).where(of_version).select("digest")
    distinct = rows.groupBy("digest").agg(F.first("content").alias("content"))
    misses = distinct.join(known, "digest", "left_anti")
    counter = F.arrow_udf(_counter(spark.sparkContext.broadcast(tokenizer)), "bigint")
    misses.select(F.lit(tokenizer.version).alias("tokenizer"), "digest", counter("content").alias("n_tokens")
                  ).write.mode("append").parquet(cache_path)

    stored = read_cache(spark, cache_path).where(of_version).select("digest", "n_tokens")
    return rows.select("doc_id", "n_bytes", "digest").join(stored, "digest").select("doc_id", "n_bytes", "n_tokens")
