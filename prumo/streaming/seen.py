"""What was seen before: a Bloom filter a day, mergeable and dropped when it is too old, before the exact anti join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of one block of a filter, as Spark's bitmap aggregates have them.
BITS = 32768
#: Bits that a key sets in its block.
PROBES = 5


def blocks_for(keys: int, per_block: int = 2048) -> int:
    """Blocks of a filter for about so many live keys: at per_block keys a block, 0.2 % of unseen keys look seen."""
    return max(1, -(-keys // per_block))


def block_of(keys: list[str], blocks: int) -> Column:
    """The block that a key belongs to."""
    return F.pmod(F.xxhash64(*keys), F.lit(blocks).cast("long"))


def _places(keys: list[str]) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(k), *keys), F.lit(BITS).cast("long")) for k in range(1, PROBES + 1)]


def day_filters(seen: DataFrame, keys: list[str], ts: str, blocks: int) -> DataFrame:
    """day, block, bits: of each day's keys, one bitmap of 4 KB a block that has any. Bits are set in partial aggregates, so what
    is shuffled is a bitmap for each task, day and block, whatever the number of keys."""
    marked = seen.select(F.to_date(ts).alias("day"), block_of(keys, blocks).alias("block"), F.explode(F.array(*_places(keys))).alias("_at"))
    return marked.groupBy("day", "block").agg(F.bitmap_construct_agg("_at").alias("bits"))


def live_filter(filters: DataFrame, as_of: Column, days: int) -> DataFrame:
    """block, bits of the days not older than `days` before as_of, merged; older filters have no say any more and may be deleted."""
    return filters.filter(F.col("day") > F.date_sub(as_of, days)).groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits"))


def holds(bits: Column, keys: list[str]) -> Column:
    """Whether a block has all bits of a key; false without a block."""
    byte = lambda at: F.conv(F.hex(F.substring(bits, F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    every = F.lit(True)
    for at in _places(keys):
        every = every & (F.getbit(byte(at), (at % 8).cast("int")) == 1)
    return F.coalesce(every, F.lit(False))


def maybe_seen(new: DataFrame, live: DataFrame, keys: list[str], blocks: int, out: str) -> DataFrame:
    """new with whether its key may have been seen: false is certain. The live filter has at most `blocks` rows of 4 KB; Spark
    broadcasts it only where that is under its own bound."""
    bits = live.withColumnRenamed("block", "_block").withColumnRenamed("bits", "_bits")
    joined = new.withColumn("_block", block_of(keys, blocks)).join(bits, "_block", "left")
    return joined.withColumn(out, holds(F.col("_bits"), keys)).drop("_block", "_bits")


def unseen(new: DataFrame, seen: DataFrame, live: DataFrame, keys: list[str], ts: str, as_of: Column, days: int, blocks: int) -> DataFrame:
    """Rows of new whose keys no row of seen has that is younger than `days` before as_of. seen: keys and ts; live: see
    live_filter, of the same keys and blocks.

    What the filter doesn't know is new at once; only the rest meets the seen keys, in an anti join. Null keys count as keys like
    others. A row of new stays as it is, repeats and all.
    """
    marked = maybe_seen(new, live, keys, blocks, "_maybe")
    recent = seen.filter(F.to_date(ts) > F.date_sub(as_of, days)).select(*(F.col(k).alias(f"_{k}") for k in keys))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    asked = marked.filter("_maybe").join(recent, same, "left_anti")
    return marked.filter("not _maybe").unionByName(asked).drop("_maybe")


def begins_seen(items: DataFrame, prefix: str, seen: DataFrame, id: str, out: str) -> DataFrame:
    """items with whether any seen id begins with the item's prefix (an item has been handled once one of its parts was).

    Seen ids are cut at the lengths that prefixes have (a short list, one row) and meet them in an equi join; a null prefix is never
    seen, an empty one if there is any id.
    """
    lengths = items.filter(F.col(prefix).isNotNull()).agg(F.collect_set(F.length(prefix)).alias("_lengths"))
    cut = seen.filter(F.col(id).isNotNull()).join(F.broadcast(lengths)).select(F.explode(F.transform(F.filter("_lengths", lambda n: n <= F.length(id)), lambda n: F.left(F.col(id), n))).alias("_p"))
    return items.join(cut.distinct().withColumn(out, F.lit(True)), F.col(prefix) == F.col("_p"), "left").drop("_p").withColumn(out, F.coalesce(out, F.lit(False)))
