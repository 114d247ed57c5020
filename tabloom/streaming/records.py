"""Fitted steps applied to records as they arrive.

Fitted transforms are column expressions, so they run on a stream unchanged and keep
no state. Steps that start jobs of their own (neighbour imputation) go through
``each_batch``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.kinds import nan_to_null


def record_stream(spark: SparkSession, folder: str, schema: T.StructType | str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return nan_to_null(reader.json(folder))


def chain(df: DataFrame, steps: Sequence[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    for step in steps:
        df = step(df)
    return df


def write_stream(
    df: DataFrame, path: str, checkpoint: str, format: str = "json", available_now: bool = True
) -> StreamingQuery:
    """Append-only sink with exactly-once files."""
    writer = df.writeStream.format(format).outputMode("append").option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)


def each_batch(
    df: DataFrame, steps: Sequence[Callable[[DataFrame], DataFrame]], path: str, checkpoint: str,
    format: str = "json", available_now: bool = True,
) -> StreamingQuery:
    """Run batch-only steps per micro-batch. A replayed batch overwrites its own folder."""

    def write(batch: DataFrame, number: int) -> None:
        chain(batch, steps).write.mode("overwrite").format(format).save(f"{path}/batch={number}")

    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
