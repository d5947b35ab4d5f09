"""Queries that run a stream over the events and return what it decided."""

from __future__ import annotations

from pyspark.sql import functions as F

from prumo.plans.common import table
from prumo.shared import shared_folder
from prumo.streaming import incremental, live

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(sql: str):
    def add(f):
        def run(spark, sf):
            stream = spark.readStream.schema(table(spark, sf, "events").schema).parquet(f"{sf}/events.parque[t]")
            path = shared_folder(spark, f.__name__)
            live.run_to_parquet(f(stream), f"{path}/rows", f"{path}/checkpoint")
            return spark.read.parquet(f"{path}/rows").withColumnRenamed("id", "event_id")

        run.__name__, run.__doc__ = f.__name__, f.__doc__
        QUERIES[f.__name__], ORACLE_SQL[f.__name__] = run, sql
        return run

    return add


_ZONE = "America/Sao_Paulo"
_DAY = f"CAST(ts AT TIME ZONE 'UTC' AT TIME ZONE '{_ZONE}' AS DATE)"


@query("""SELECT event_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL '1' HOUR PRECEDING AND CURRENT ROW), 2) AS spent FROM events""")
def live_budget(events):
    """What each user has spent in the hour up to each event."""
    return live.budget(events, "user_id", "ts", "event_id", "value", 3600, "0 seconds").withColumn("spent", F.round("spent", 2))


@query("""WITH i AS (SELECT *, sum((event_type <> 'error')::INT) OVER w AS island FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
f AS (SELECT *, (sum((event_type = 'error')::INT) OVER (PARTITION BY user_id, island ORDER BY ts, event_id))::INT AS failures FROM i)
SELECT event_id, failures, coalesce(max(CASE WHEN failures >= 2 THEN ts END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + INTERVAL '12' HOUR > ts, false) AS out FROM f""")
def live_breaker(events):
    """Users that failed twice in a row are out for twelve hours."""
    return live.breaker(events, "user_id", "ts", "event_id", F.col("event_type") == "error", 2, 12 * 3600, "0 seconds")


@query(f"""SELECT event_id, row_number() OVER d AS used, row_number() OVER d <= 40 AS within_cap FROM events WINDOW d AS (PARTITION BY event_type, {_DAY} ORDER BY ts, event_id)""")
def live_day_quota(events):
    """40 events of each type in a day of São Paulo."""
    return live.day_quota(events, "event_type", "ts", "event_id", 40, _ZONE, "0 seconds")


@query(f"""WITH k(kind, rank, cap) AS (VALUES ('large', 0, 5), ('medium', 1, 90), ('small', 2, 150)),
s AS (SELECT kind, row_number() OVER (ORDER BY slot, rank) AS n FROM k, range(1, 1000) r(slot) WHERE slot <= cap),
e AS (SELECT event_id, row_number() OVER (PARTITION BY {_DAY} ORDER BY ts, event_id) AS n FROM events)
SELECT event_id, kind FROM e LEFT JOIN s USING (n)""")
def live_dispatch(events):
    """Each event to the model least used that day, until the models' caps are reached."""
    return live.dispatch(events, "ts", "event_id", {"large": 5, "medium": 90, "small": 150}, _ZONE, "0 seconds")


def _plain(f, sql: str) -> None:
    QUERIES[f.__name__], ORACLE_SQL[f.__name__] = f, sql


def events_once(spark, sf):
    """Each event once, though the stream is started twice; data first, marks of what was seen after."""
    path, schema = shared_folder(spark, "once"), table(spark, sf, "events").schema
    for _ in range(2):
        stream = incremental.read_new(spark, f"{sf}/events.parque[t]", schema, "ts", ["event_id"], "1 hour")
        incremental.run_available(stream, f"{path}/checkpoint", incremental.parquet_batches(f"{path}/rows"))
    return spark.read.parquet(f"{path}/rows").select("event_id", "user_id", "event_type")


def events_by_hour(spark, sf):
    """Counts by type and six hours that a stream has closed by its watermark, appended as they close."""
    path, schema = shared_folder(spark, "hours"), table(spark, sf, "events").schema
    stream = spark.readStream.schema(schema).parquet(f"{sf}/events.parque[t]").withColumn("ts", F.col("ts").cast("timestamp"))
    counts = incremental.windowed_counts(stream, "ts", ["event_type"], "6 hours", "0 seconds")
    query = counts.writeStream.format("parquet").option("path", f"{path}/rows").option("checkpointLocation", f"{path}/checkpoint").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.parquet(f"{path}/rows").select(F.col("window.start").cast("timestamp_ntz").alias("start"), "event_type", "n")


_plain(events_once, "SELECT event_id, user_id, event_type FROM events")
_plain(events_by_hour, "SELECT start, event_type, count(*) AS n FROM (SELECT time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') AS start, event_type FROM events) WHERE start + INTERVAL 6 HOUR <= (SELECT max(ts) FROM events) GROUP BY start, event_type")
