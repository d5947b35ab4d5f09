"""Queries on event state: quotas, budgets, spacing, failure runs, high-water marks, page differences."""

from __future__ import annotations

from pyspark.sql import functions as F

from prumo.plans.common import table
from prumo.streaming import control

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLE_SQL[f.__name__] = f, sql
        return f

    return add


@query("""SELECT event_id, CAST(ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/Los_Angeles' AS DATE) AS day, row_number() OVER d AS used, row_number() OVER d <= 300 AS within_cap FROM events
WINDOW d AS (PARTITION BY CAST(ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/Los_Angeles' AS DATE) ORDER BY ts, event_id)""")
def tz_day_quota(spark, sf):
    e = table(spark, sf, "events").withColumn("day", control.local_day(F.col("ts"), "America/Los_Angeles"))
    return control.capped(e, "day", ["ts", "event_id"], 300, "ts").select("event_id", "day", F.col("used").cast("long").alias("used"), "within_cap")


@query("""SELECT event_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL '1' HOUR PRECEDING AND CURRENT ROW), 2) AS spent FROM events""")
def rolling_budget(spark, sf):
    return control.rolling_sum(table(spark, sf, "events"), "user_id", "ts", "value", "'1' hour", "spent").select("event_id", F.round("spent", 2).alias("spent"))


@query("""WITH m AS (SELECT *, sum((event_type <> 'error')::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM events)
SELECT user_id, min(ts) AS started, max(ts) AS ended, count(*) AS run_length FROM m WHERE event_type = 'error' GROUP BY user_id, island HAVING count(*) >= 3""")
def breaker_runs(spark, sf):
    return control.runs(table(spark, sf, "events"), "user_id", ["ts", "event_id"], F.col("event_type") == "error", 3, "ts")


@query("""WITH g AS (SELECT event_id, event_type, floor((epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY event_type ORDER BY ts, event_id))) / 1000000.0)::BIGINT AS gap_seconds FROM events)
SELECT event_id, event_type, gap_seconds FROM g WHERE gap_seconds < 60""")
def min_spacing(spark, sf):
    return control.spacing_violations(table(spark, sf, "events"), "event_type", ["ts", "event_id"], "ts", 60).select("event_id", "event_type", "gap_seconds")


@query("""WITH seen AS (SELECT event_id FROM events WHERE ts < TIMESTAMP '2024-01-20 00:00:00' AND event_type <> 'error')
SELECT event_id, event_type FROM events WHERE event_id >= (SELECT max(event_id) FROM seen) - 600 AND event_id NOT IN (SELECT event_id FROM seen)""")
def high_water(spark, sf):
    """All but the errors of the first days have been seen; errors within the margin come late."""
    e = table(spark, sf, "events")
    seen = e.filter((F.col("ts") < F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")) & (F.col("event_type") != "error"))
    return control.reread(e, "event_id", seen.select("event_id"), 600).select("event_id", "event_type")


@query("""WITH k(kind, rank) AS (VALUES ('view', 0), ('click', 1), ('error', 2), ('other', 3)), d AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events),
c AS (SELECT d.day, k.kind, k.rank, count(e.event_id) AS n FROM d CROSS JOIN k LEFT JOIN events e ON CAST(e.ts AS DATE) = d.day AND e.event_type = k.kind AND e.user_id % 2 = 0 GROUP BY ALL)
SELECT day, arg_min(kind, row(n, rank)) AS kind, min(n) AS n FROM c WHERE kind <> 'other' GROUP BY day""")
def least_used(spark, sf):
    e = table(spark, sf, "events")
    even = e.withColumn("event_type", F.when(F.col("user_id") % 2 == 0, F.col("event_type")))
    return control.least_used(even, F.to_date("ts"), "event_type", ["view", "click", "error"])


@query(r"""WITH s AS (SELECT conv_id, turn, unnest(string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(10), 'g'), chr(10))) AS s FROM conversations),
f AS (SELECT conv_id, trim(s) AS s, min(turn) AS turn FROM s WHERE trim(s) <> '' GROUP BY ALL) SELECT conv_id, turn, count(*) AS n_new FROM f GROUP BY ALL""")
def sentence_diff(spark, sf):
    return control.new_sentences(table(spark, sf, "conversations"), "conv_id", "turn", "text")


@query("""WITH w AS (SELECT user_id, ts, event_id, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL '30' MINUTE THEN 0 ELSE 1 END AS fresh FROM events),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM w) SELECT user_id, min(ts) AS started, count(*) AS n FROM s GROUP BY user_id, session""")
def sessions(spark, sf):
    gap = table(spark, sf, "events").withColumn("_t", F.col("ts").cast("timestamp"))
    out = gap.groupBy("user_id", F.session_window("_t", "30 minutes 1 microsecond")).agg(F.min("ts").alias("started"), F.count("*").alias("n"))
    return out.select("user_id", "started", "n")
