"""Model tables as DataFrames: read, write, pick one model."""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ensemblescore.errors import ModelError
from ensemblescore.sources.schema import TABLES


ARROW = {
    "string": pa.string(), "int": pa.int32(), "float": pa.float32(),
    "array<string>": pa.list_(pa.string()), "array<int>": pa.list_(pa.int32()),
}


# Sides of joins with more rows are not sent to every executor.
MAX_BROADCAST_ROWS = 50_000


def beside(df: DataFrame, n_rows: int) -> DataFrame:
    """``df`` as a side of a join, where that side with keys of models has ``n_rows``.

    Spark judges a stored table by its bytes on disk, and model tables take few bytes a row: what
    looks small there may be more than a driver can gather. Many rows are therefore merged."""
    return df.hint("merge") if n_rows > MAX_BROADCAST_ROWS else df


@dataclass(frozen=True)
class ModelTables:
    """``header``, ``inputs``, ``trees`` and ``nodes`` of one model or of a registry."""

    header: DataFrame
    inputs: DataFrame
    trees: DataFrame
    nodes: DataFrame

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> ModelTables:
        """Open the four Parquet tables under ``path``; no data is read yet."""
        frames = {}
        for name, schema in TABLES.items():
            try:
                frames[name] = spark.read.schema(schema).parquet(f"{path}/{name}")
            except AnalysisException as e:
                raise ModelError(f"no readable model table '{name}' under {path!r}: {e}") from e
        return cls(**frames)

    @classmethod
    def from_rows(cls, spark: SparkSession, rows: dict[str, list]) -> ModelTables:
        """Hand-built models; such tables are small, so each is one partition."""
        frames = {}
        for name, schema in TABLES.items():
            columns = list(zip(*rows[name])) or [()] * len(schema)
            table = pa.table([pa.array(c, ARROW[f.dataType.simpleString()])
                              for c, f in zip(columns, schema)], names=schema.names)
            frames[name] = spark.createDataFrame(table, schema).coalesce(1)
        return cls(**frames)

    def write(self, path: str, mode: str = "errorifexists") -> str:
        """Store the tables as Parquet, sorted by model so that reading one model skips row groups.

        Rows are dealt by model and tree first: a registry may be derived from a file that is one task."""
        for name in TABLES:
            table = getattr(self, name)
            keys = [c for c in ("model_id", "tree_id") if c in table.columns]
            table = table.repartition(*keys).sortWithinPartitions("model_id")
            table.write.mode(mode).parquet(f"{path}/{name}")
        return path

    def only(self, model_id: str) -> ModelTables:
        return self.map(lambda df: df.where(F.col("model_id") == model_id))

    def map(self, fn) -> ModelTables:
        return ModelTables(**{name: fn(getattr(self, name)) for name in TABLES})

    def union(self, other: ModelTables) -> ModelTables:
        return ModelTables(
            **{n: getattr(self, n).unionByName(getattr(other, n)) for n in TABLES}
        )
