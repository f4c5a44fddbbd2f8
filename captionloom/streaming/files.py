"""Streams of item files: the same column expressions as in batch, with back-pressure and a checkpoint."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def read_stream(spark: SparkSession, path: str, schema: str, fmt: str = "parquet", files_at_once: int = 100) -> DataFrame:
    """New files under a folder, at most `files_at_once` in a batch."""
    return spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_at_once).load(path)


def process(stream: DataFrame, path: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame], success: str = "success", available_now: bool = True) -> StreamingQuery:
    """Each batch transformed and split into captions and failures.

    A batch is written under its own number, so that a batch that runs again replaces what it wrote before; what is finished
    is in the checkpoint and is not read again after a crash.
    """

    def write(batch: DataFrame, number: int) -> None:
        done = transform(batch).persist()
        try:
            for name, rows in (("captions", done.where(success)), ("failed", done.where(f"NOT coalesce({success}, false)"))):
                rows.write.mode("overwrite").parquet(f"{path}/{name}/batch={number}")
        finally:
            done.unpersist()

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def append(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> StreamingQuery:
    """Rows appended as they come, exactly once for file sinks."""
    return stream.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
