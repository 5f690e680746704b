"""Look strings up in a table that is too large to send to every executor."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ensemblescore.functions.coerce import unused

#: Values kept apart as frequent, and values the sketch that finds them tracks in a task.
FREQUENT, TRACKED = 100, 10_000


def coded(df: DataFrame, value: Column, known: DataFrame, code: str) -> DataFrame:
    """Add ``code``: what ``known(value, code)``, a row per value, says of ``value``; NaN if null or unknown.

    One frequent value may be a large part of all rows. A sketch of bounded size, read from the column
    alone, names at most ``FREQUENT`` values; their codes are sent to every executor, and their rows, like
    those without a value, go to the join under a key of their input partition that meets nothing. Whom the
    sketch names decides where rows go, and no code. A stream, which has no sketch, joins all values.
    """
    own, rest, hit, found = (unused([*df.columns, code], f"{code}_{n}") for n in ("value", "rest", "hit", "found"))
    rows = df.select("*", value.cast("string").alias(own))
    table = known.select(F.col("value").alias(own), F.col("code").alias(found))
    if df.isStreaming:
        rows = rows.withColumn(hit, F.lit(None).cast("struct<code: float>"))
    else:
        sketch = df.select(value.cast("string").alias("value")).agg(
            F.expr(f"approx_top_k(value, {FREQUENT}, {TRACKED})").alias("top"))
        top = sketch.select(F.explode("top.item").alias(own)).where(F.col(own).isNotNull()).limit(FREQUENT)
        known_top = table.join(F.broadcast(top), own)
        heavy = top.join(F.broadcast(known_top), own, "left").select(own, F.struct(F.col(found).alias("code")).alias(hit))
        rows = rows.join(F.broadcast(heavy), own, "left")
    nowhere = F.col(own).isNull() | F.col(hit).isNotNull()
    rows = rows.withColumn(rest, F.when(nowhere, F.lit(1) + F.spark_partition_id()).otherwise(0)).withColumn(
        own, F.coalesce(own, F.lit("")))
    rows = rows.join(table.withColumn(rest, F.lit(0)), [own, rest], "left")
    nan = F.lit(float("nan")).cast("float")
    return rows.withColumn(code, F.coalesce(F.col(hit)["code"], found, nan)).drop(own, rest, hit, found)
