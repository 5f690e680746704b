"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ensemblescore.sources.scratch import ensure_checkpoint_dir

#: A node's links are spread over so many keys when its smallest neighbour is sent to them.
SPREAD = 16


def _to_smallest(links: DataFrame) -> DataFrame:
    """(node, other, least): every link with the smallest of its node and the node's neighbours.

    A node may have a large part of all links; the minimum combines before the shuffle, and
    the way back is spread by the other end."""
    least = links.groupBy("node").agg(F.min("other").alias("least")).select(
        "node", F.least("node", "least").alias("least"),
        F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("spread"))
    return links.withColumn("spread", F.pmod(F.xxhash64("other"), F.lit(SPREAD)).cast("int")).join(
        least, ["node", "spread"]).select("node", "other", "least")


def _signature(links: DataFrame) -> tuple:
    return tuple(links.agg(
        F.count("*"), F.sum(F.xxhash64("node", "other").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component``, the smallest node reachable, for every node that has a link.

    Links may repeat and point either way; a null end or a link to itself says nothing.
    Rounds of large and small stars run until nothing changes, a few for groups of any
    diameter; each is cut by a checkpoint in the shared folder.
    """
    ensure_checkpoint_dir(links.sparkSession)
    links = links.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("node"), F.least(a, b).alias("other")).distinct().checkpoint()
    before = _signature(links)
    while before[0]:
        both = links.unionByName(links.select(F.col("other").alias("node"), F.col("node").alias("other")))
        large = _to_smallest(both).where("other > node").select(
            F.col("other").alias("node"), F.col("least").alias("other")).distinct()
        near = _to_smallest(large)
        links = near.where("other != least").select(F.col("other").alias("node"), F.col("least").alias("other")) \
            .unionByName(near.select("node", F.col("least").alias("other"))).distinct().checkpoint()
        after = _signature(links)
        if after == before:
            break
        before = after
    return links.select("node", F.col("other").alias("component"))
