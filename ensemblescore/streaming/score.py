"""Score an unbounded input with the same transformer, or with a registry that may change meanwhile."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ensemblescore.operators.registry import score_registry
from ensemblescore.operators.transformer import EnsembleModel
from ensemblescore.sources.publish import published_models


def score_stream(model: EnsembleModel, stream: DataFrame, path: str, checkpoint: str, *,
                 columns: list[str] | None = None, available_now: bool = False) -> StreamingQuery:
    """Append scored rows to Parquet under ``path``.

    Scoring is row by row, so there is no state and no watermark. The checkpoint
    and the file sink's log make every input row appear once, restarts included.
    """
    if not stream.isStreaming:
        raise ValueError("score_stream needs a streaming DataFrame; use model.transform otherwise")
    scored = model.transform(stream)
    if columns is not None:
        scored = scored.select(*columns)
    writer = (scored.writeStream.format("parquet").outputMode("append")
              .option("path", path).option("checkpointLocation", checkpoint))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def score_registry_stream(stream: DataFrame, root: str, path: str, checkpoint: str, *,
                          model_id_col: str = "model_id", columns: list[str] | None = None,
                          available_now: bool = False, **options) -> StreamingQuery:
    """Score a stream whose rows each name their model, into Parquet under ``path``.

    Every micro-batch is scored by the newest version published under ``root`` when it begins, by any
    plan of ``score_registry``, which gets ``options``. A batch has a folder of its own,
    ``path/batch=<number>``, overwritten if it is run again, so every input row appears once and a batch
    has one version. No state is kept.
    """
    if not stream.isStreaming:
        raise ValueError("score_registry_stream needs a streaming DataFrame; use score_registry otherwise")

    def score(batch: DataFrame, number: int) -> None:
        scored = score_registry(batch, published_models(batch.sparkSession, root), model_id_col, **options)
        if columns is not None:
            scored = scored.select(*columns)
        scored.write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = stream.writeStream.foreachBatch(score).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
