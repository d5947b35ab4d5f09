"""Stored tables that batches are merged into: hash buckets as partitions, of which only those that a batch touches are rewritten."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from prumo.operators.writes import append_log
from prumo.shared import kept

Merge = Callable[[DataFrame, DataFrame], DataFrame]


class StoredTable:
    """A Parquet table of one row a key at path, in `buckets` partitions by the hash of its keys.

    merge(old, new) gives the rows of the buckets that new touches from what they held and from new. It must be such that merging the same
    rows again changes nothing; then a batch that is repeated after a failure leaves the table as it was after the first time, and
    what was half written is put right. Merged rows are written aside first, so no file is read and replaced in one job; the other
    buckets keep their files.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: list[str], buckets: int):
        self.spark, self.path, self.keys, self.buckets = spark, path, keys, buckets
        self.schema = spark.createDataFrame([], schema).schema

    def _bucketed(self, df: DataFrame) -> DataFrame:
        return df.withColumn("bucket", F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

    def read(self) -> DataFrame:
        """All rows with their buckets; none before the first batch."""
        where = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not where.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(where):
            return self._bucketed(self.spark.createDataFrame([], self.schema))
        return self.spark.read.schema(StructType([*self.schema.fields, StructField("bucket", IntegerType())])).parquet(self.path)

    def upsert(self, new: DataFrame, merge: Merge) -> None:
        new = kept(self._bucketed(new), "batch")
        touched = [r.bucket for r in new.select("bucket").distinct().collect()]  # at most `buckets` numbers
        if not touched:
            return
        old = self.read().filter(F.col("bucket").isin(touched)).drop("bucket")
        merged = kept(self._bucketed(merge(old, new.drop("bucket"))), "merged")
        merged.repartition(len(touched), "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(self.path)

    def follow(self, stream: DataFrame, merge: Merge, checkpoint: str) -> None:
        """Merge all that a stream has by now, batch by batch, and stop."""
        query = stream.writeStream.foreachBatch(lambda batch, _: self.upsert(batch, merge)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()


def latest(keys: list[str], order: list[str]) -> Merge:
    """Of each key the last row by order; ties go to what was there."""

    def merge(old: DataFrame, new: DataFrame) -> DataFrame:
        columns = [c for c in new.columns if c not in keys]
        both = old.withColumn("_old", F.lit(1)).unionByName(new.withColumn("_old", F.lit(0)))
        return both.groupBy(*keys).agg(F.max_by(F.struct(*columns), F.struct(*order, "_old")).alias("_v")).select(*keys, *(f"_v.{c}" for c in columns))

    return merge


def fill_nulls(keys: list[str], columns: list[str], order: list[str]) -> Merge:
    """What is known stays; a null takes the first value in order that a row brings, also among the new rows."""

    def merge(old: DataFrame, new: DataFrame) -> DataFrame:
        both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
        by = F.struct("_new", *order)
        rest = [c for c in new.columns if c not in (*keys, *columns)]
        firsts = [F.min_by(c, F.when(F.col(c).isNotNull(), by)).alias(c) for c in columns]
        return both.groupBy(*keys).agg(*firsts, F.min_by(F.struct(*rest), by).alias("_r")).select(*keys, *columns, *(f"_r.{c}" for c in rest))

    return merge


def write_counted(df: DataFrame, path: str, metrics: dict[str, Column], log: str, run: str, at: Column) -> dict:
    """Write df to path and, from the same pass over it, the metrics (aggregates) to an audit log, one row a metric. A run that is repeated
    writes both anew in their places. Returns the metrics."""
    counted = Observation(run)
    df.observe(counted, *(c.alias(n) for n, c in metrics.items())).write.mode("overwrite").parquet(path)
    found = counted.get
    rows = df.sparkSession.createDataFrame([(n, float(v) if v is not None else None) for n, v in found.items()], "metric string, value double")
    append_log(rows, log, at, run)
    return found
