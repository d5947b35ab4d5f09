"""Sets of numbers as bitmaps: exact distinct counts that merge over days, unions and overlaps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def id_sets(df: DataFrame, groups: list[str], id: str) -> DataFrame:
    """groups, block, bits: the ids (whole numbers; nulls left out) of each group as bitmaps of 32,768 bits, made in partial aggregates."""
    known = df.filter(F.col(id).isNotNull()).withColumn("block", F.bitmap_bucket_number(id))
    return known.groupBy(*groups, "block").agg(F.bitmap_construct_agg(F.bitmap_bit_position(id)).alias("bits"))


def merged(sets: DataFrame, groups: list[str]) -> DataFrame:
    """Unions of sets over what isn't in groups (days, say)."""
    return sets.groupBy(*groups, "block").agg(F.bitmap_or_agg("bits").alias("bits"))


def sizes(sets: DataFrame, groups: list[str], out: str) -> DataFrame:
    return sets.groupBy(*groups).agg(F.sum(F.bitmap_count("bits")).alias(out))


def gross_and_distinct(sets: DataFrame, groups: list[str]) -> DataFrame:
    """groups, gross, distinct, overlap: the sizes of a group's sets added up, the size of their union, and what is in more than one set
    counted as often as it comes again."""
    union = sizes(merged(sets, groups), groups, "distinct")
    both = sizes(sets, groups, "gross").join(union, groups) if groups else sizes(sets, [], "gross").join(F.broadcast(union))
    return both.withColumn("overlap", F.col("gross") - F.col("distinct"))
