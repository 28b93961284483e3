"""Scoring a stream with a fitted pipeline: file source, map-only plan, file sink."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tabloom.operators.scoring import OUTPUTS, score


def open_stream(
    spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet", **options
) -> DataFrame:
    """New files below ``path`` as a stream. ``maxFilesPerTrigger`` bounds a batch."""
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)


def score_stream(
    model: PipelineModel,
    stream: DataFrame,
    keep: Sequence[str] = (),
    outputs: Sequence[str] = OUTPUTS,
) -> DataFrame:
    """The stream with the model's outputs. It needs no state, so late rows are no matter."""
    if not stream.isStreaming:
        raise ValueError("not a stream; use score() for a table")
    return score(model, stream, keep, outputs)


def write_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    interval: str | None = None,
) -> StreamingQuery:
    """Append to files, each row once. Without ``interval`` it stops when all is read.

    Both paths belong on storage that all executors share.
    """
    writer = stream.writeStream.format(fmt).outputMode("append")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    if interval is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()
