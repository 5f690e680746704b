"""SimHash near-duplicates by multi-index hashing."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ensemblescore.llm.components import connected_components
from ensemblescore.llm.text import content_digest, named, slices, unused
from ensemblescore.sources.scratch import ensure_checkpoint_dir

SHINGLE, SEED, MAX_BITS, SEGMENTS = 3, 42, 3, 2


def _fingerprint(text: str, shingle: int) -> int:
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.append(np.flatnonzero(np.frombuffer(joined, np.uint8) == 32), len(joined))
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    spans = zip(starts[:n].tolist(), ends[min(shingle, len(words)) - 1:].tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[s:e], SEED) for s, e in spans), ">u8", n)
    votes = np.zeros(64, np.int64)
    for i in range(0, n, 4096):
        votes += np.unpackbits(hashes[i:i + 4096].view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > n).tobytes(), "big", signed=True)


def fingerprints(text: Column, shingle: int = SHINGLE) -> Column:
    """The 64-bit SimHash of a text column, as a signed bigint.

    Words are parted by ASCII white space, A-Z lower-cased; a bit is set where more than
    half of the shingles' XXH64 have it. Fewer words than a shingle make one; a null or
    empty text has fingerprint 0. The whole text counts, in memory bound by one text.
    """
    def compute(column: pa.Array) -> pa.Array:
        return pa.array([_fingerprint(t, shingle) for _, rows in slices(column) for t in rows.to_pylist()], pa.int64())
    return F.arrow_udf(compute, "bigint")(text.cast("string"))


def _segments(n: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of n segments that make up 64 bits."""
    cuts = [64 * i // n for i in range(n + 1)]
    return [(lo, hi - lo) for lo, hi in zip(cuts, cuts[1:])]


def _ball(width: int, radius: int) -> list[int]:
    """Every change of at most ``radius`` bits of a segment."""
    return [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(width), r)]


def _keys(segment: int, low: int, width: int, radius: int) -> tuple[Column, Column]:
    """The key of a fingerprint's segment, and the keys it looks up."""
    whole = (1 << width) - 1 if width < 64 else -1
    own = F.shiftrightunsigned("fingerprint", low).bitwiseAND(F.lit(whole).cast("bigint"))

    def keyed(value: Column) -> Column:
        return F.struct(F.lit(segment).alias("segment"), value.alias("value"))

    ball = F.array(*[F.lit(change).cast("bigint") for change in _ball(width, radius)])
    around = F.filter(F.transform(ball, lambda change: keyed(own.bitwiseXOR(change))), lambda k: k["value"] >= own)
    return keyed(own), around


def links(prints: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS) -> DataFrame:
    """(a, b), a < b: all pairs of distinct ``fingerprint`` values at most ``max_bits`` bits apart.

    Two such values differ in at most ``max_bits // segments`` bits of some segment, so each
    value looks up the ball of that radius around each of its segments and the complete
    distance decides. Of two different segments only the smaller value looks, since the
    other's look would find the same pair. With two segments of 32 bits a look meets
    another value by chance once in 2**32.
    """
    prints = prints.select("fingerprint").where("fingerprint is not null").distinct()
    table, looks = [], []
    for segment, (low, width) in enumerate(_segments(segments)):
        own, around = _keys(segment, low, width, max_bits // segments)
        table.append(own)
        looks.append(around)
    table = prints.select(F.col("fingerprint").alias("b"), F.explode(F.array(*table)).alias("k")).select("b", "k.*")
    looks = prints.select(F.col("fingerprint").alias("a"), F.explode(F.concat(*looks)).alias("k")).select("a", "k.*")
    near = (F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    found = looks.join(table, (looks["segment"] == table["segment"]) & (looks["value"] == table["value"]) & near)
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _labelled(rows: DataFrame, max_bits: int, segments: int) -> DataFrame:
    """Checkpointed rows that have ``doc_id`` and ``fingerprint``, with their ``component_id``."""
    classes = rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first"))
    grouped = connected_components(links(classes, max_bits, segments)).withColumnRenamed("node", "fingerprint")
    labelled = classes.join(grouped, "fingerprint", "left").withColumn(
        "component", F.coalesce("component", "fingerprint"))
    smallest = labelled.groupBy("component").agg(F.min("first").alias("component_id"))
    names = labelled.join(smallest, "component").select("fingerprint", "component", "component_id")
    return rows.join(names, "fingerprint")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS, segments: int = SEGMENTS) -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` (bigint) and ``component_id``.

    ``component_id`` is the smallest key among documents reachable by links of at most
    ``max_bits`` differing bits, the document's own included; copies meet in one
    fingerprint first and are never paired. A null key is never the smallest unless all
    are null. Null and empty texts share fingerprint 0, linked like any other. Repeated
    rows are kept, and an empty table gives no rows.
    """
    ensure_checkpoint_dir(df.sparkSession)
    rows = df.select(df[key].alias("doc_id"), fingerprints(df[text], shingle).alias("fingerprint")).checkpoint()
    return _labelled(rows, max_bits, segments).select("doc_id", "fingerprint", "component_id")


def representatives(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS, segments: int = SEGMENTS) -> DataFrame:
    """One row of each component, with all its columns: that of the smallest key, null last.

    Of rows that share it, the one whose text has the smallest digest stays, and of rows
    equal in key and text, one.
    """
    ensure_checkpoint_dir(df.sparkSession)
    own = content_digest(named(key), named(text))
    rows = df.select(named(key).alias("doc_id"), fingerprints(named(text), shingle).alias("fingerprint"),
                     own.alias("digest")).checkpoint()
    chosen = _labelled(rows, max_bits, segments).groupBy("component").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("last"), "doc_id", "digest"))["digest"].alias(unused(df, "chosen")))
    name, chosen_name = unused(df, "digest"), chosen.columns[-1]
    # By position: the table may have several columns of one name.
    kept = df.select("*", own.alias(name)).join(
        chosen.select(chosen_name), F.col(name) == F.col(chosen_name), "left_semi")
    return kept.dropDuplicates([name]).drop(name)
