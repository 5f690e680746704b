"""Where jobs may put intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


_local_folders: dict[str, str] = {}


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder; on
    a cluster a machine-local folder would be lost with its machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        if context.applicationId not in _local_folders:
            _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="ensemblescore-")
        shared = _local_folders[context.applicationId]
    return f"{shared.rstrip('/')}/ensemblescore/{label}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Point ``DataFrame.checkpoint`` at the shared folder, if nobody has yet."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_path(spark, "checkpoints"))
