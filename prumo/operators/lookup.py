"""First, latest and best rows per key; semi and anti joins with conditions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def pick_per_key(df: DataFrame, keys: list[str], order: list[Column], columns: list[str], latest: bool = False) -> DataFrame:
    """The columns of each key's first row by `order` (last if latest); a grouped minimum, so no window sorts a group. A null
    counts as smaller than all values; pick_by_date puts rows without a date last."""
    by = F.struct(*order)
    value = F.struct(*columns)
    return df.groupBy(*keys).agg((F.max_by if latest else F.min_by)(value, by).alias("_v")).select(*keys, *(F.col(f"_v.{c}").alias(c) for c in columns))


def with_and_without(df: DataFrame, keys: list[str], has: Column, lacks: Column) -> DataFrame:
    """Keys with a row that meets `has` and none that meets `lacks`: a semi and an anti join in one grouped pass."""
    return df.groupBy(*keys).agg(F.bool_or(F.coalesce(has, F.lit(False))).alias("_a"), F.bool_or(F.coalesce(lacks, F.lit(False))).alias("_b")).filter("_a and not _b").select(*keys)


def not_since(df: DataFrame, log: DataFrame, keys: list[str], recent: Column) -> DataFrame:
    """Rows of df without a recent row in the log (a cool-down)."""
    return df.join(log.filter(recent).select(*keys).distinct(), keys, "left_anti")


def first_seen(df: DataFrame, seen: DataFrame, keys: list[str], order: list[Column], columns: list[str]) -> DataFrame:
    """Insert-or-ignore: of new keys the first row; keys already seen are ignored."""
    return pick_per_key(df.join(seen.select(*keys).distinct(), keys, "left_anti"), keys, order, columns)


def null_score(*columns: Column) -> Column:
    """How many columns are null."""
    return sum((c.isNull().cast("int") for c in columns[1:]), columns[0].isNull().cast("int"))


def missing_names(**columns: Column) -> Column:
    """Names of the columns that are null, in the order given."""
    return F.array_join(F.array_compact(F.array(*(F.when(c.isNull(), F.lit(n)) for n, c in columns.items()))), ",")


def pick_by_date(df: DataFrame, keys: list[str], day: str, tie: list[Column], columns: list[str], latest: bool) -> DataFrame:
    """Per key the columns of its latest or earliest row; a row without a date comes last either way, the first by `tie` wins
    among equal dates."""
    when = F.unix_date(F.col(day).cast("date"))
    return pick_per_key(df, keys, [F.col(day).isNull(), -when if latest else when, *tie], columns)


def insert_flags(df: DataFrame, seen: DataFrame, keys: list[str], order: list[Column], row: str) -> DataFrame:
    """Per row whether insert-or-ignore adds it: it is the first of its key in df, and the key isn't in seen."""
    fresh = first_seen(df, seen, keys, order, [row]).select(F.col(row).alias("_first"))
    return df.select(row).join(fresh, F.col(row) == F.col("_first"), "left").select(row, F.col("_first").isNotNull().alias("is_new"))


def once_per(df: DataFrame, log: DataFrame, keys: list[str], ts: str, days: int) -> DataFrame:
    """Rows of df that come `days` or more after the last logged row of their key, or whose key isn't logged. Keys are compared
    as 128 bits of hashes, so that the log needs no names."""
    hashed = F.struct(F.xxhash64(*keys).alias("a"), F.xxhash64(F.lit(1), *keys).alias("b"))
    last = log.groupBy(hashed.alias("_h")).agg(F.max(ts).alias("_last"))
    held = df.withColumn("_h", hashed).join(last, "_h", "left")
    return held.filter(F.col("_last").isNull() | (F.col(ts) >= F.col("_last") + F.make_dt_interval(F.lit(days)))).drop("_h", "_last")


def in_any(column: Column, wanted: list[str]) -> Column:
    """Whether an array shares a value with a list; false for null."""
    return F.coalesce(F.arrays_overlap(column, F.array(*map(F.lit, wanted))), F.lit(False))


def rotation(names: list[str], day: Column, each: int, every_days: int) -> Column:
    """The day's `each` names of a fixed list, going round; the start moves on once in every_days days."""
    start = F.floor((F.datediff(day, F.lit("0001-01-01").cast("date")) + 1) / every_days) * each
    every = F.array(*map(F.lit, names))
    return F.transform(F.sequence(F.lit(0), F.lit(each - 1)), lambda i: F.element_at(every, F.pmod(start + i, F.lit(len(names))).cast("int") + 1))


def batch_of_day(df: DataFrame, key: str, size: int, day: int, block: int = 1000) -> DataFrame:
    """Of the rows in the order of a whole-number key, cut into batches of `size`, the batch number day modulo how many there are.

    A row's place is the rows in blocks of keys before its own, plus its place in its block. Counts of blocks are summed in two
    levels (blocks of blocks), so that the one window over all groups has a row for each block squared keys only.
    """
    cut = df.withColumn("_b", F.floor(F.col(key) / block)).withColumn("_c", F.floor(F.col("_b") / block))
    blocks = cut.groupBy("_c", "_b").agg(F.count("*").alias("_n"))
    up = W.partitionBy("_c").orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    tops = blocks.groupBy("_c").agg(F.sum("_n").alias("_n"))
    tops = tops.select(F.col("_c").alias("_top"), F.coalesce(F.sum("_n").over(W.orderBy("_c").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"), F.sum("_n").over(W.orderBy("_c").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)).alias("_all"))
    placed = blocks.withColumn("_own", F.coalesce(F.sum("_n").over(up), F.lit(0))).join(tops, F.col("_c") == F.col("_top"))
    starts = placed.select(F.col("_b").alias("_block"), (F.col("_before") + F.col("_own")).alias("_start"), F.col("_all"))
    rank = F.row_number().over(W.partitionBy("_b").orderBy(key)) - 1
    return cut.withColumn("_r", rank).join(starts, F.col("_b") == F.col("_block")).filter(F.floor((F.col("_r") + F.col("_start")) / size) == F.lit(day) % F.ceil(F.col("_all") / size)).select(*df.columns)


def without_any(df: DataFrame, other: DataFrame, ways: list[list[tuple[str, Column]]]) -> DataFrame:
    """Rows of df that no row of other meets in any of the ways; a way is a list of (column of df, expression of other) that must all be
    equal. Not (A or B) is not A and not B, so each way is an equi anti join of its own, one after the other, and none is a nested loop.
    A null meets nothing."""
    for way in ways:
        there = other.select(*(e.alias(f"_w{k}") for k, (_, e) in enumerate(way))).distinct()
        df = df.join(there, [F.col(c) == F.col(f"_w{k}") for k, (c, _) in enumerate(way)], "left_anti")
    return df
