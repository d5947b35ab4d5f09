"""Incremental runs with Structured Streaming: new rows once, data written before the marks of what was seen."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_new(spark: SparkSession, folder: str, schema: StructType | str, ts: str, keys: list[str], delay: str) -> DataFrame:
    """A stream of rows of Parquet files in folder whose keys weren't seen within `delay` of event time; later ones are late."""
    stream = spark.readStream.schema(schema).parquet(folder)
    if dict(stream.dtypes)[ts] == "timestamp_ntz":
        stream = stream.withColumn(ts, F.col(ts).cast("timestamp"))
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def run_available(stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None]) -> None:
    """Handles all that is there and stops. write(batch, number) must be idempotent: Spark marks a batch as seen only after
    it returns, so a failed batch comes again."""
    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def windowed_counts(stream: DataFrame, ts: str, keys: list[str], window: str, delay: str) -> DataFrame:
    """Counts per key and event-time window, for rows at most `delay` late."""
    return stream.withWatermark(ts, delay).groupBy(F.window(ts, window), *keys).agg(F.count("*").alias("n"))


def parquet_batches(path: str) -> Callable[[DataFrame, int], None]:
    """Writes each batch into its own folder, overwriting what an earlier attempt left."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return write
