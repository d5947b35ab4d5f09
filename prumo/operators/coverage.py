"""What is covered, and what went silent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def uncovered(df: DataFrame, coverage: DataFrame, keys: list[str], scope: str) -> DataFrame:
    """Rows whose key isn't covered, only in scopes where something is."""
    seen = coverage.select(*keys).distinct()
    return df.join(seen, keys, "left_anti").join(df.join(seen, keys, "left_semi").select(scope).distinct(), scope, "left_semi")


def status(df: DataFrame, keys: list[str], found: Column, failed: Column) -> DataFrame:
    """Per key coberto (something found), erro (only failures) or sem_dados."""
    flags = df.groupBy(*keys).agg(F.bool_or(F.coalesce(found, F.lit(False))).alias("_f"), F.bool_or(F.coalesce(failed, F.lit(False))).alias("_e"))
    return flags.select(*keys, F.when(F.col("_f"), "coberto").when(F.col("_e"), "erro").otherwise("sem_dados").alias("status"))


def silent_days(df: DataFrame, key: str, day: str, first: str, last: str) -> DataFrame:
    """Business days from first to last on which a key that occurs in df has no row."""
    every = F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date")))
    wanted = df.select(key).dropna().distinct().select(key, every.alias(day)).filter(F.weekday(day) < 5)
    return wanted.join(df.select(key, day).distinct(), [key, day], "left_anti")
