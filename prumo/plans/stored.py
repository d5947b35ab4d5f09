"""Queries on stored tables, counted writes, archives by day and sets as bitmaps."""

from __future__ import annotations

import io
import zipfile

import pyarrow as pa
from pyspark.sql import functions as F

from prumo.operators import bitmaps
from prumo.plans.common import table
from prumo.shared import shared_folder
from prumo.sources import files
from prumo.streaming import stored

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLE_SQL[f.__name__] = f, sql
        return f

    return add


@query("""SELECT user_id, arg_max(event_type, row(ts, event_id)) AS status, arg_max(event_id, row(ts, event_id)) AS event_id FROM events GROUP BY ALL""")
def stored_status(spark, sf):
    """The latest status of each user in a stored table that a stream of events is merged into, then the first days once more."""
    path, e = shared_folder(spark, "status"), table(spark, sf, "events")
    columns = ["user_id", F.col("event_type").alias("status"), "event_id", "ts"]
    held = stored.StoredTable(spark, f"{path}/rows", "user_id long, status string, event_id long, ts timestamp_ntz", ["user_id"], 8)
    merge = stored.latest(["user_id"], ["ts", "event_id"])
    held.follow(spark.readStream.schema(e.schema).parquet(f"{sf}/events.parque[t]").select(*columns), merge, f"{path}/checkpoint")
    held.upsert(e.filter("ts < timestamp_ntz'2024-01-10'").select(*columns), merge)
    return held.read().select("user_id", "status", "event_id")


@query("""SELECT o_custkey, arg_min(o_orderstatus, o_orderkey) FILTER (WHERE o_orderstatus <> 'F') AS status, min(o_totalprice) FILTER (WHERE o_orderkey = f) AS price, f AS first FROM (SELECT *, min(o_orderkey) OVER (PARTITION BY o_custkey) AS f FROM orders) GROUP BY o_custkey, f""")
def stored_fill(spark, sf):
    """Orders merged in two batches into one row a customer: known values stay, nulls are filled by what comes later."""
    held = stored.StoredTable(spark, shared_folder(spark, "fill"), "o_custkey long, status string, price double, first long", ["o_custkey"], 8)
    o = table(spark, sf, "orders").select("o_custkey", F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus")).alias("status"), F.col("o_totalprice").alias("price"), F.col("o_orderkey").alias("first"))
    middle = o.agg(F.expr("percentile_approx(first, 0.5)")).first()[0] or 0
    for part in (o.filter(F.col("first") <= middle), o.filter(F.col("first") > middle), o.filter(F.col("first") > middle)):
        held.upsert(part, stored.fill_nulls(["o_custkey"], ["status"], ["first"]))
    return held.read().select("o_custkey", "status", "price", "first")


@query("""SELECT unnest(['rows', 'errors', 'users', 'spent']) AS metric, unnest([count(*)::DOUBLE, count(*) FILTER (WHERE event_type = 'error')::DOUBLE, count(DISTINCT user_id % 7)::DOUBLE, round(sum(value) FILTER (WHERE event_type = 'purchase'))]) AS value FROM events""")
def counted_write(spark, sf):
    """Metrics of a write from the pass that writes, in the audit log; the run is repeated and counts once."""
    path, e = shared_folder(spark, "counted"), table(spark, sf, "events")
    metrics = {"rows": F.count("*"), "errors": F.count_if(F.col("event_type") == "error"), "users": F.size(F.collect_set(F.col("user_id") % 7)), "spent": F.round(F.sum(F.when(F.col("event_type") == "purchase", F.col("value"))))}
    for _ in range(2):
        stored.write_counted(e, f"{path}/rows", metrics, f"{path}/log", "run-1", F.lit("2026-01-01"))
    return spark.read.parquet(f"{path}/log").select("metric", "value")


def _archives(batches):
    for batch in batches:
        out = []
        for rows in batch.column("rows").to_pylist():
            packed = io.BytesIO()
            with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
                for k in range(0, len(rows), 3):
                    z.writestr(f"{k}.json", '{"autopublicacoes": [' + ", ".join(rows[k : k + 3]) + "]}")
                z.writestr("none.json", '{"autopublicacoes": null}')
            out.append(packed.getvalue())
        yield pa.RecordBatch.from_arrays([batch.column("day"), batch.column("part"), pa.array(out, pa.binary())], ["day", "part", "content"])


@query("""SELECT page_id, DATE '2026-01-01' + (page_id % 9)::INT AS day, length(html)::INT AS size FROM pages WHERE page_id % 9 BETWEEN 2 AND 5""")
def archives_between_days(spark, sf):
    """Archives of JSON files by day, made of the pages; of the days that aren't asked for no file is opened."""
    row = F.to_json(F.struct("page_id", F.length("html").alias("size")))
    p = table(spark, sf, "pages").withColumn("day", F.date_add(F.lit("2026-01-01").cast("date"), (F.col("page_id") % 9).cast("int")))
    packed = p.groupBy("day", (F.col("page_id") % 2).alias("part")).agg(F.collect_list(row).alias("rows")).mapInArrow(_archives, "day date, part long, content binary")
    path = shared_folder(spark, "archives")
    packed.write.partitionBy("day").parquet(path)
    wanted = files.between_days(spark, path, "2026-01-03", "2026-01-06")
    return files.archive_rows(wanted, ["day"], "content", "autopublicacoes", "page_id long, size int").select("page_id", "day", "size")


@query("""WITH d AS (SELECT DISTINCT event_type, CAST(ts AS DATE) AS day, user_id FROM events)
SELECT event_type, count(*)::BIGINT AS gross, count(DISTINCT user_id)::BIGINT AS "distinct", (count(*) - count(DISTINCT user_id))::BIGINT AS overlap FROM d GROUP BY ALL""")
def users_by_bitmaps(spark, sf):
    """Users of each type of event: by day added up, over all days, and how often they come again, from daily sets."""
    daily = bitmaps.id_sets(table(spark, sf, "events").withColumn("day", F.to_date("ts")), ["event_type", "day"], "user_id")
    one = daily.groupBy("event_type", "day").agg(F.sum(F.bitmap_count("bits")).alias("n")).groupBy("event_type").agg(F.sum("n").alias("gross"))
    union = bitmaps.sizes(bitmaps.merged(daily, ["event_type"]), ["event_type"], "distinct")
    return one.join(union, "event_type").withColumn("overlap", F.col("gross") - F.col("distinct"))


@query("""SELECT (SELECT count(DISTINCT l_partkey) FROM lineitem WHERE l_returnflag = 'R') + (SELECT count(DISTINCT l_partkey) FROM lineitem WHERE l_returnflag <> 'R') AS gross, (SELECT count(DISTINCT l_partkey) FROM lineitem) AS "distinct",
(SELECT count(*) FROM (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' INTERSECT SELECT l_partkey FROM lineitem WHERE l_returnflag <> 'R')) AS overlap""")
def coverage_by_bitmaps(spark, sf):
    """Parts that were returned, parts that weren't, all of them and both."""
    sets = bitmaps.id_sets(table(spark, sf, "lineitem").withColumn("kind", F.col("l_returnflag") == "R"), ["kind"], "l_partkey")
    return bitmaps.gross_and_distinct(sets, [])
