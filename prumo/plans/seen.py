"""Queries on what was seen before."""

from __future__ import annotations

from pyspark.sql import functions as F

from prumo.plans.common import table
from prumo.streaming import seen

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLE_SQL[f.__name__] = f, sql
        return f

    return add


def _sides(spark, sf):
    """Events of the last five days, those before, and the last day."""
    e = table(spark, sf, "events").withColumn("band", F.floor(F.col("value") / 10))
    last = F.lit(e.agg(F.to_date(F.max("ts"))).first()[0])
    new = F.to_date("ts") > F.date_sub(last, 5)
    return e.filter(new), e.filter(~new), last


_LAST = "(SELECT CAST(max(ts) AS DATE) FROM events)"


@query(f"""WITH e AS (SELECT *, floor(value / 10) AS band, CAST(ts AS DATE) AS day FROM events), o AS (SELECT user_id, band FROM e WHERE day <= {_LAST} - 5 AND day > {_LAST} - 14)
SELECT event_id, user_id FROM e WHERE day > {_LAST} - 5 AND (user_id, band) NOT IN (SELECT user_id, band FROM o)""")
def seen_filter(spark, sf):
    """Events of the last five days whose user and band of values weren't seen in the nine days before."""
    new, old, last = _sides(spark, sf)
    keys, blocks = ["user_id", "band"], 64
    live = seen.live_filter(seen.day_filters(old, keys, "ts", blocks), last, 14)
    return seen.unseen(new, old, live, keys, "ts", last, 14, blocks).select("event_id", "user_id")


@query("""WITH d AS (SELECT CAST(ts AS DATE) AS day, count(DISTINCT user_id) AS n FROM events GROUP BY ALL) SELECT day, n AS users, 0::BIGINT AS missed FROM d""")
def seen_filter_days(spark, sf):
    """Users by day, and how many of them that day's filter doesn't know: none."""
    e = table(spark, sf, "events")
    filters = seen.day_filters(e, ["user_id"], "ts", 8)
    users = e.select(F.to_date("ts").alias("day"), "user_id").distinct()
    bits = filters.withColumnsRenamed({"day": "_day", "block": "_block", "bits": "_bits"})
    held = users.join(bits, (F.col("day") == F.col("_day")) & (seen.block_of(["user_id"], 8) == F.col("_block")), "left").withColumn("maybe", seen.holds(F.col("_bits"), ["user_id"]))
    return held.groupBy("day").agg(F.count("*").alias("users"), F.count_if(~F.col("maybe")).alias("missed"))


@query("""SELECT c_custkey, EXISTS (SELECT 1 FROM orders WHERE o_orderstatus = 'F' AND starts_with('max_' || o_custkey || '_' || o_orderkey, 'max_' || c_custkey || '_')) AS handled FROM customer""")
def begins_seen(spark, sf):
    """Customers one of whose orders has been handled: its id begins with theirs."""
    done = table(spark, sf, "orders").filter("o_orderstatus = 'F'").select(F.concat_ws("_", F.lit("max"), "o_custkey", "o_orderkey").alias("id"))
    items = table(spark, sf, "customer").select("c_custkey", F.concat(F.lit("max_"), F.col("c_custkey").cast("string"), F.lit("_")).alias("begin"))
    return seen.begins_seen(items, "begin", done, "id", "handled").select("c_custkey", "handled")
