"""Rows from files: CSV dimensions, archives of JSON, texts of unknown encoding, folders by day."""

from __future__ import annotations

import io
import zipfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def dimension(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A dimension from CSV files with a header, in UTF-8; fields that don't fit the schema become null."""
    return spark.read.csv(path, schema=schema, header=True, enforceSchema=False, mode="PERMISSIVE", encoding="UTF-8")


def with_coordinates(df: DataFrame, coordinates: DataFrame, code: str) -> DataFrame:
    """df with latitude and longitude of its code where they are missing; a code that comes more than once counts once (the
    smallest pair). coordinates: code, latitude, longitude."""
    known = coordinates.groupBy(code).agg(F.min(F.struct("latitude", "longitude")).alias("_at"))
    joined = df.join(known, code, "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.col(f"_at.{c}")) for c in ("latitude", "longitude")}).drop("_at")


def decoded(content: Column) -> Column:
    """Text of bytes: UTF-8 if they are valid, else Latin-1."""
    return F.coalesce(F.try_validate_utf8(content.cast("string")), F.decode(content, "ISO-8859-1"))


def kind_of(content: Column) -> Column:
    """pdf, zip or other, by the first bytes."""
    return F.when(F.substring(content, 1, 5) == F.lit(b"%PDF-"), "pdf").when(F.substring(content, 1, 4) == F.lit(b"PK\x03\x04"), "zip").otherwise("other")


def _unzip(batches):
    """One entry at a time, so that no more than an archive and one of its files is held."""
    for batch in batches:
        names = [n for n in batch.schema.names if n != "content"]
        for k in range(batch.num_rows):
            own = [batch.column(n).slice(k, 1) for n in names]
            try:
                with zipfile.ZipFile(io.BytesIO(batch.column("content")[k].as_py() or b"")) as archive:
                    for i in archive.infolist():
                        if not i.is_dir():
                            yield pa.RecordBatch.from_arrays([*own, pa.array([i.filename], pa.string()), pa.array([archive.read(i)], pa.binary())], [*names, "entry", "data"])
            except zipfile.BadZipFile:
                pass


def archive_rows(df: DataFrame, keys: list[str], content: str, field: str, schema: str) -> DataFrame:
    """One row per object of the JSON array `field` in every file of ZIP archives; archives that don't open, files that aren't
    JSON and a field that is null give none."""
    from pyspark.sql import types as T

    held = df.select(*keys, F.col(content).alias("content"))
    files = held.mapInArrow(_unzip, T.StructType([*held.drop("content").schema.fields, T.StructField("entry", T.StringType()), T.StructField("data", T.BinaryType())]))
    rows = F.from_json(decoded(F.col("data")), f"{field} array<struct<{schema}>>")[field]
    return files.select(*keys, "entry", F.explode(rows).alias("_r")).select(*keys, "entry", "_r.*")


def between_days(spark: SparkSession, path: str, first: str, last: str, day: str = "day") -> DataFrame:
    """Parquet folders partitioned by day, only those from first to last: the filter prunes folders before any file is read."""
    return spark.read.parquet(path).filter(F.col(day).between(F.lit(first).cast("date"), F.lit(last).cast("date")))
