"""Versions of model tables that appear at once.

A version is written whole into a folder of its own, which is never written to again; then
one row with its number and folder is appended to the manifest. That append is a commit of Spark's
own writer, whose file appears by one rename, so a reader finds all four tables of a version or
does not find the version; one that is open keeps the folders it has.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ensemblescore.errors import ModelError
from ensemblescore.sources.tables import ModelTables

MANIFEST = "version long, folder string"


def published_versions(spark: SparkSession, root: str) -> DataFrame:
    """``version`` and ``folder`` of what has been published under ``root``; no rows if nothing has."""
    try:
        return spark.read.schema(MANIFEST).parquet(f"{root}/manifest")
    except AnalysisException as fault:
        if fault.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def publish_models(tables: ModelTables, root: str) -> int:
    """Write ``tables`` as the next version under ``root`` and return its number.

    Two jobs that publish at once may take the same number; readers then agree on one of the two,
    the one whose folder's name is the greater."""
    spark = tables.header.sparkSession
    folder = f"versions/{uuid.uuid4().hex}"
    tables.write(f"{root}/{folder}")
    version = 1 + (published_versions(spark, root).agg(F.max("version")).head()[0] or 0)
    spark.createDataFrame([(version, folder)], MANIFEST).coalesce(1).write.mode("append").parquet(f"{root}/manifest")
    return version


def published_models(spark: SparkSession, root: str, version: int | None = None) -> ModelTables:
    """The tables of one version, by default of the newest there is now."""
    rows = published_versions(spark, root)
    if version is not None:
        rows = rows.where(F.col("version") == version)
    newest = rows.orderBy(F.desc("version"), F.desc("folder")).head()
    if newest is None:
        raise ModelError(f"nothing has been published under {root!r}" if version is None
                         else f"no version {version} under {root!r}")
    return ModelTables.read(spark, f"{root}/{newest.folder}")
