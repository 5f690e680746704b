"""Use all cores for an input that comes in too few pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import DateType, NumericType, StringType, TimestampType

from ensemblescore.functions.coerce import column

# A file source this small may hold fewer row groups than the cluster has cores.
MAX_SPREAD_BYTES = 1 << 30


def spread_small(df: DataFrame, max_bytes: int = MAX_SPREAD_BYTES) -> DataFrame:
    """Deal the rows of a small input to all cores before heavy scoring.

    Scoring itself never shuffles. One Parquet row group, however, is one task; for
    a table below ``max_bytes`` a shuffle costs less than leaving the other cores
    idle. Larger inputs are returned as they are. Rows go by the hash of their
    content, which needs no sort and sends a retried row to the same place.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.isStreaming or size > max_bytes or cores < 2:
        return df
    hashed = [column(f.name) for f in df.schema
              if isinstance(f.dataType, (NumericType, StringType, DateType, TimestampType))]
    return df.repartition(cores, *hashed)
