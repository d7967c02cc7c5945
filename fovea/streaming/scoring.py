"""Scoring of newly arriving rows or files with a model that was fitted in batch.

Nothing here keeps state: the checkpoint only remembers which input files were done.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from fovea.sources.files import BINARY_SCHEMA


def stream_binary(
    spark: SparkSession, path: str, pattern: str | None = None, max_files: int | None = None
) -> DataFrame:
    """Files under `path` as they arrive; `max_files` bounds one micro-batch."""
    reader = spark.readStream.format("binaryFile").schema(BINARY_SCHEMA)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.load(path)


def score_stream(
    rows: DataFrame,
    model: PipelineModel,
    keep: list[str],
    output: str,
    checkpoint: str,
) -> StreamingQuery:
    """Append (keep..., model output) of all input available now to a Parquet table."""
    scored = model.transform(rows).select(*keep)
    return (
        scored.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .option("path", output)
        .trigger(availableNow=True)
        .start()
    )
