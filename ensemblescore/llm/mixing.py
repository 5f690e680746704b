"""Mix sources to target weights by a low-discrepancy schedule of equal-token blocks. Spark expressions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ensemblescore.llm.text import content_digest, named, unused
from ensemblescore.sources.scratch import ensure_checkpoint_dir

#: Weights of the sources in their order, repeated as often as needed.
WEIGHTS = (5, 2, 1)
#: The mix takes this share of all words, and at most so many epochs of one source.
SHARE, EPOCHS = 1.5, 2
#: Words in a block.
BLOCK = 64

#: Sizes of the pieces that running sums are cut into: documents per bucket, slots per chunk,
#: and cells that the cumulative weights are looked up by. They change no result.
DOCS_PER_BUCKET, SLOTS_PER_CHUNK, CELL_BITS = 512, 1 << 16, 10

#: Numbers of the mix between one slot and the next.
GAP = 1 << 20

#: The table of sources is broadcast up to so many rows, and joined by a shuffle beyond.
MOST_BROADCAST = 100_000


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE,
                   epochs: int = EPOCHS) -> DataFrame:
    """Rank, size and target of every source, from ``source`` and ``size`` rows.

    Sources go by code point, null last. The target is the smaller of ``epochs`` times the
    source's size and its weight times one common level, at which the targets add up to
    ``share`` of all words: the fixpoint of resharing what stands above the limits.
    One row per source; the windows here run over that small table alone.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    cycle = F.array(*[F.lit(w) for w in weights])
    ranked = by_source.withColumn("rank", F.row_number().over(
        Window.orderBy(F.col("source").asc_nulls_last())) - 1).withColumn(
        "weight", F.element_at(cycle, (F.col("rank") % len(weights) + 1).cast("int")))
    ranked = ranked.withColumn("limit", F.col("source_size") * epochs).withColumn(
        "ratio", F.col("limit") / F.col("weight"))
    order = Window.orderBy("ratio", "rank")
    levelled = ranked.select(
        "*",
        (F.sum("source_size").over(Window.partitionBy()) * share).alias("budget"),
        F.coalesce(F.sum("limit").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("below"),
        F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)).alias("above"),
    ).withColumn("level", (F.col("budget") - F.col("below")) / F.col("above"))
    free = F.col("ratio") > F.col("level")
    common = F.min(F.when(free, F.struct("ratio", "rank", "level"))).over(Window.partitionBy())["level"]
    levelled = levelled.withColumn("common", common)
    return levelled.select(
        "rank", "source", "source_size",
        F.when(F.col("common").isNull(), F.col("limit").cast("double"))
        .otherwise(F.least(F.col("limit").cast("double"), F.col("weight") * F.col("common"))).alias("target"))


def _bit_reverse(t: Column, bits: int) -> Column:
    """Van der Corput points in base two, scaled to whole numbers below 2 ** bits."""
    digits = F.lpad(F.bin(t), bits, "0")
    return F.conv(F.reverse(digits), 2, 10).cast("bigint")


def _small(rows: DataFrame, n_sources: int) -> DataFrame:
    return F.broadcast(rows) if n_sources <= MOST_BROADCAST else rows


def _schedule(spark, sources: DataFrame, n_sources: int, n_slots: int, total: float, block: int) -> DataFrame:
    """(rank, block, slot): the place in the mix of every block that a source's words need, and of no other.

    The k-th slot of a source holds its k-th block. The points give a source a few slots more or
    less than it needs, and a source smaller than a slot often none: slots beyond its words stay out, and
    blocks without a slot stand between slots, at places drawn by a hash. ``slot`` orders the mix."""
    bits = max(CELL_BITS, (n_slots - 1).bit_length())
    cell = 1 << (bits - CELL_BITS)
    upto = F.sum("target").over(Window.orderBy("rank"))
    shares = sources.select(
        "rank", F.floor((upto - F.col("target")) / total * (1 << bits)).alias("low"),
        F.floor(upto / total * (1 << bits)).alias("high"), F.lead("rank").over(Window.orderBy("rank")).isNull().alias("last"))
    shares = shares.withColumn("high", F.when(F.col("last"), F.lit(1 << bits)).otherwise(F.col("high")))
    cells = shares.where("high > low").withColumn("cell", F.explode(F.sequence(
        F.floor(F.col("low") / cell), F.floor((F.col("high") - 1) / cell))))
    slots = spark.range(n_slots).select(F.col("id").alias("slot"), _bit_reverse(F.col("id"), bits).alias("u"))
    slots = slots.withColumn("cell", F.floor(F.col("u") / cell)).join(_small(cells, n_sources), "cell").where(
        "u >= low and u < high").select("rank", "slot", F.floor(F.col("slot") / SLOTS_PER_CHUNK).alias("chunk"))
    before = slots.groupBy("rank", "chunk").agg(F.count("*").alias("n")).select(
        "rank", "chunk", F.coalesce(F.sum("n").over(Window.partitionBy("rank").orderBy("chunk").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy("rank", "chunk").orderBy("slot")) - 1
    needs = sources.select("rank", F.ceil(F.col("words") / block).alias("needed"))
    scheduled = slots.withColumn("own", own).join(before, ["rank", "chunk"]).join(_small(needs, n_sources), "rank").select(
        "rank", (F.col("before") + F.col("own")).alias("block"), (F.col("slot") * GAP).alias("slot"), "needed").where(
        "block < needed").drop("needed")
    had = slots.groupBy("rank").agg(F.count("*").alias("n"))
    missing = needs.join(had, "rank", "left").withColumn("n", F.coalesce("n", F.lit(0))).where("n < needed").select(
        "rank", F.explode(F.sequence(F.col("n"), F.col("needed") - 1)).alias("block"))
    missing = missing.withColumn("after", F.pmod(F.xxhash64("rank", "block"), F.lit(n_slots)))
    between = F.row_number().over(Window.partitionBy("after").orderBy("rank", "block"))
    return scheduled.unionByName(missing.select("rank", "block", (F.col("after") * GAP + between).alias("slot")))


@dataclass(frozen=True)
class Mix:
    """``documents``: every input row with its place in its source's stream;
    ``pieces``: (slot, rank, block, start, begin, length), the parts of documents each slot holds;
    ``taken``: every input row with the words the mix takes of it."""

    documents: DataFrame
    pieces: DataFrame
    taken: DataFrame


def mix(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
        weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS, block: int = BLOCK) -> Mix:
    """Mix documents so that each source's words come near its target.

    Each source's documents, shuffled by a hash of their content, form one stream of words
    that runs for ``epochs`` rounds and is cut into blocks of ``block`` words. Slot ``t``
    of the mix takes the van der Corput point of ``t`` through the cumulative targets to a
    source, and the k-th slot of a source holds its k-th block, until the words of the source
    are its target, rounded; the last block is shorter. A document at a cut is taken in part. Null or empty texts have no words, take part with size 0, and are never
    taken; a null source is a source of its own; rows that repeat are mixed as rows; an
    empty table gives an empty mix.

    Running sums are made in two levels, so no source is gathered in one task.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n_words = F.coalesce(F.regexp_count(named(text).cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0))
    sized = df.select(named(key).alias("doc_id"), named(source).alias("source"), n_words.cast("bigint").alias("size"),
                      content_digest(named(key), named(text)).alias("digest")).checkpoint()
    sources = source_targets(sized, weights, share, epochs).withColumn(
        "words", F.floor(F.col("target") + 0.5)).checkpoint()
    n_rows = sized.count()
    total, n_sources = sources.agg(F.coalesce(F.sum("target"), F.lit(0.0)), F.count("*")).first()
    n_buckets = max(1, n_rows // DOCS_PER_BUCKET)

    ranked = sized.join(_small(sources.withColumnRenamed("source", "of"), n_sources), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    ranked = ranked.withColumn("bucket", F.floor(
        F.conv(F.substring("digest", 1, 8), 16, 10).cast("bigint") * n_buckets / (1 << 32)))
    before = ranked.groupBy("rank", "bucket").agg(F.sum("size").alias("n")).select(
        "rank", "bucket", F.coalesce(F.sum("n").over(Window.partitionBy("rank").orderBy("bucket").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    within = F.coalesce(F.sum("size").over(Window.partitionBy("rank", "bucket").orderBy("digest", "size").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    documents = ranked.withColumn("within", within).join(before, ["rank", "bucket"]).withColumn(
        "start", F.col("before") + F.col("within")).drop("bucket", "before", "within").checkpoint()

    slots = _schedule(spark, sources, n_sources, max(1, round(total / block)), max(total, 1.0), block)
    rounds = documents.where("size > 0").select(
        "rank", "start", "size", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("epoch"), "source_size", "words")
    rounds = rounds.withColumn("at", F.col("epoch") * F.col("source_size") + F.col("start")).withColumn(
        "upto", F.least(F.col("at") + F.col("size"), "words")).where("at < upto")
    cuts = rounds.withColumn("block", F.explode(F.sequence(
        F.floor(F.col("at") / block), F.floor((F.col("upto") - 1) / block))))
    cuts = cuts.withColumn("begin", F.greatest(F.col("block") * block, F.col("at"))).withColumn(
        "length", F.least((F.col("block") + 1) * block, "upto") - F.col("begin"))
    pieces = cuts.join(slots, ["rank", "block"]).select(
        "slot", "rank", "block", "start", (F.col("begin") - F.col("at")).alias("begin"), "length")

    # Within a source, documents that have words have different starts.
    words = pieces.groupBy("rank", "start").agg(F.sum("length").alias("taken"))
    some = documents.where("size > 0").join(words, ["rank", "start"], "left")
    none = documents.where("size = 0").withColumn("taken", F.lit(None).cast("bigint"))
    taken = some.unionByName(none).withColumn("taken", F.coalesce("taken", F.lit(0)))
    return Mix(documents, pieces, taken)


def mixed_documents(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
                    **options) -> DataFrame:
    """The rows of ``df``, each as often as the mix takes it: its words taken by its size, rounded.

    Columns stay as they are. Rows alike in key and text share their words evenly.
    """
    if df.isEmpty():
        return df
    own, of, name, copies, copy = (unused(df, c) for c in ("own_digest", "digest", "of_source", "copies", "copy"))
    taken = mix(df, key, text, source, **options).taken.groupBy("digest", "source").agg(
        F.round(F.sum("taken") / F.greatest(F.sum("size"), F.lit(1))).cast("int").alias("times"))
    taken = taken.where("times > 0").select(
        F.col("digest").alias(of), F.col("source").alias(name), F.col("times").alias(copies))
    # By position: the table may have several columns of one name.
    rows = df.select("*", content_digest(named(key), named(text)).alias(own))
    rows = rows.join(taken, (F.col(own) == F.col(of)) & named(source).eqNullSafe(F.col(name)))
    return rows.select("*", F.explode(F.sequence(F.lit(1), F.col(copies))).alias(copy)).drop(own, of, name, copies, copy)
