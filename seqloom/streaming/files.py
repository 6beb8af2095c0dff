"""Incremental runs over arriving files: each is read once, results stay up to date after a restart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def arriving(spark: SparkSession, folder: str, schema: str, kind: str = "parquet", files_per_batch: int = 1_000, **options: str) -> DataFrame:
    """Files of a folder as a stream; a file that was read is not read again."""
    reader = spark.readStream.format(kind).schema(schema).option("maxFilesPerTrigger", files_per_batch)
    for name, value in options.items():
        reader = reader.option(name, value)
    return reader.load(folder)


def run_available(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Handle what has arrived, in batches, and stop. ``sink`` must write a batch of one number once (``overwrite`` by it)."""
    query = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def batch_writer(folder: str, transform: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """A sink that writes each batch in a folder of its number: a repeated batch replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return write


def windowed_counts(stream: DataFrame, time: str, keys: list[str], width: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Counts per key and window of time; rows later than ``late`` are left out and state is dropped behind it."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width).alias("window"), *keys).agg(F.count("*").alias("count"))


def partial_counts(frame: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Sums of a batch, to be added to those of other batches."""
    return frame.groupBy(*keys).agg(F.sum(value).alias(value))


def total_counts(spark: SparkSession, folder: str, keys: list[str], value: str) -> DataFrame:
    """Sums over all batches written so far."""
    return spark.read.parquet(folder).groupBy(*keys).agg(F.sum(value).alias(value))
