"""The corpus pipeline: whole documents in, token ids out, one operator per stage.

Each stage works on all that its predecessor kept and is written as Parquet and read again
before the next. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ensemblescore.llm import mixing, pieces, quality, simhash, substrings
from ensemblescore.sources.scratch import scratch_path
from ensemblescore.sources.shipping import ship


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail no rule of the policy; nothing but their own text decides."""
    ship(spark)
    return quality.passing(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints linked within three bits: that of the smallest id."""
    ship(spark)
    return simhash.representatives(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the words of windows that stand earlier; one that loses all is empty.

    ``n_chars`` is that of the text left."""
    ship(spark)
    rest = substrings.without_repeats(docs)
    if "n_chars" not in docs.columns:
        return rest
    return rest.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of its source takes it: not, once or twice."""
    return mixing.mixed_documents(docs)


def sentencepiece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document with an end id, and a digest of what they decode to."""
    ship(spark)
    model = public_tokenizers.path("piece_bpe_32k.model")
    rows = pieces.encode(docs, model, decoded=True)
    return rows.select(
        "doc_id", "ids", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", simhash_near_dedup),
    ("substring dedup", substring_dedup),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", sentencepiece_ids),
]

#: No SQL: SQL has neither XXH64 votes over shingles nor SentencePiece. Tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            path = scratch_path(spark, f"stage-{i}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
