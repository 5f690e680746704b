"""One query per operator, over the whole of its table, with the columns its contract names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from ensemblescore.llm import (chat, clustering, divergence, embeddings, language_model, licenses, mixing, packing, pieces, quality,
                               simhash, substrings, token_counts)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_chat_format(spark, sf_dir):
    said = F.lit("</s>[INST] ok [/INST]")
    extra = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"))
    table = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = chat.format_chats(table.unionByName(extra)).select(
        "conv_id", "formatted", chat.read_chats(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("segments")).alias("loss"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return rows.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"))


def op2_simhash(spark, sf_dir):
    rows = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return rows.withColumn("fingerprint", F.lpad(F.lower(F.hex("fingerprint")), 16, "0"))


def op3_sentencepiece(spark, sf_dir):
    model = public_tokenizers.path("piece_bpe_32k.model")
    rows = pieces.encode(read(spark, sf_dir, "documents"), model, decoded=True)
    return rows.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_lm_scores(spark, sf_dir):
    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    return language_model.score(read(spark, sf_dir, "documents"), held_out)


def op5_quality(spark, sf_dir):
    rows = quality.ledger(read(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality.passes(F.col("failures"), "base")).alias("base_failed"),
        quality.passes(F.col("failures"), "v1").alias("kept"))


def op6_mixing(spark, sf_dir):
    return mixing.mix(read(spark, sf_dir, "documents")).taken.select(
        "doc_id", "size", "source_size", "target", "taken")


def op7_token_counts(spark, sf_dir):
    rows = token_counts.count_tokens(
        read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return rows.select("*", (F.col("n_tokens") > 1024).alias("over_limit"))


def op8_embedding_dedup(spark, sf_dir):
    return embeddings.near_vectors(read(spark, sf_dir, "embeddings"))


def op9_licenses(spark, sf_dir):
    return licenses.scan(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score")


def op10_substring_dedup(spark, sf_dir):
    return substrings.remove_repeats(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op11_clustering(spark, sf_dir):
    rows = clustering.cluster(read(spark, sf_dir, "embeddings"))
    numbers = F.array_join(F.col("centroid").cast("array<string>"), ",")
    return rows.withColumn("centroid_sha256", F.sha2(numbers, 256)).drop("centroid")


def op12_divergence(spark, sf_dir):
    return divergence.audit(read(spark, sf_dir, "documents"))


def op13_packing(spark, sf_dir):
    rows = packing.token_pieces(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packing.place(rows.select(
        "doc_id", "piece", "start", "length", packing.ids_crc32(F.col("ids")).alias("ids_crc32"), "part", "nth"))


QUERIES = {
    "op1_chat_format": op1_chat_format,
    "op2_simhash": op2_simhash,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_lm_scores": op4_lm_scores,
    "op5_quality": op5_quality,
    "op6_mixing": op6_mixing,
    "op7_token_counts": op7_token_counts,
    "op8_embedding_dedup": op8_embedding_dedup,
    "op9_licenses": op9_licenses,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_clustering": op11_clustering,
    "op12_divergence": op12_divergence,
    "op13_packing": op13_packing,
}
