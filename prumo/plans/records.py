"""Queries on consensus, lookups and canonical records."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from prumo.operators import canonical, consensus, lookup
from prumo.plans.common import table
from prumo.shared import spread

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLE_SQL[f.__name__] = f, sql
        return f

    return add


_TALLY = """
WITH c AS (SELECT o_custkey, o_orderstatus AS d, count(*) AS n FROM orders GROUP BY ALL),
g AS (SELECT o_custkey, sum(n)::BIGINT AS group_size, max(n) AS top FROM c GROUP BY ALL),
m AS (SELECT c.o_custkey, any_value(g.group_size) AS group_size, CASE WHEN count(*) FILTER (WHERE n = top) = 1 THEN any_value(d) FILTER (WHERE n = top) END AS mode,
      string_agg(n || ' ' || d, ', ' ORDER BY n DESC, d) AS histogram FROM c JOIN g ON c.o_custkey = g.o_custkey GROUP BY c.o_custkey)
"""


@query(_TALLY + "SELECT o_orderkey, o_custkey, o_orderstatus, group_size, mode, histogram FROM orders JOIN m USING (o_custkey) WHERE group_size >= 3 AND mode IS NOT NULL AND o_orderstatus <> mode")
def consensus_divergent(spark, sf):
    return consensus.divergent(table(spark, sf, "orders"), ["o_custkey"], "o_orderstatus").select("o_orderkey", "o_custkey", "o_orderstatus", "group_size", "mode", "histogram")


@query(_TALLY + "SELECT o_custkey, group_size, histogram FROM m")
def consensus_histogram(spark, sf):
    return consensus.tally(table(spark, sf, "orders"), ["o_custkey"], "o_orderstatus").select("o_custkey", "group_size", "histogram")


@query("""WITH k AS (SELECT CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN 'priority' WHEN o_orderstatus <> 'P' THEN 'status' ELSE 'alone' END AS tier,
  CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderpriority WHEN o_orderstatus <> 'P' THEN o_orderstatus ELSE o_orderkey::VARCHAR END AS key FROM orders)
SELECT tier, key, count(*) AS n FROM k GROUP BY ALL""")
def consensus_fallback_key(spark, sf):
    o = table(spark, sf, "orders")
    key = consensus.tiered_key(("priority", F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED"))), ("status", F.nullif("o_orderstatus", F.lit("P"))), ("alone", F.col("o_orderkey")))
    return o.select(key.alias("k")).groupBy("k.tier", "k.key").agg(F.count("*").alias("n"))


@query("""SELECT p_brand, regexp_replace(p_name, ' [^ ]+$', '') AS base, count(*) AS n, min(p_partkey) AS representative, min(p_retailprice) AS least FROM part GROUP BY ALL HAVING count(*) > 1""")
def base_key_grouping(spark, sf):
    p = table(spark, sf, "part").withColumn("base", F.regexp_replace("p_name", " [^ ]+$", ""))
    return p.groupBy("p_brand", "base").agg(F.count("*").alias("n"), F.min("p_partkey").alias("representative"), F.min("p_retailprice").alias("least")).filter("n > 1")


_ORDER = "row(l_shipdate, l_linenumber, l_partkey, l_suppkey, l_extendedprice)"
_KEYS = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


@query(f"""WITH f AS (SELECT l_orderkey, arg_min(row(l_partkey, l_suppkey, l_extendedprice), {_ORDER}) AS v FROM lineitem GROUP BY ALL)
SELECT o_orderkey, o_orderstatus, v[1] AS l_partkey, v[2] AS l_suppkey, v[3] AS l_extendedprice FROM orders JOIN f ON o_orderkey = l_orderkey""")
def first_evidence(spark, sf):
    first = lookup.pick_per_key(table(spark, sf, "lineitem"), ["l_orderkey"], [F.col(c) for c in _KEYS], ["l_partkey", "l_suppkey", "l_extendedprice"])
    return table(spark, sf, "orders").join(first, F.col("o_orderkey") == F.col("l_orderkey")).select("o_orderkey", "o_orderstatus", "l_partkey", "l_suppkey", "l_extendedprice")


@query(f"""WITH f AS (SELECT l_orderkey, arg_min(l_partkey, {_ORDER}) AS l_partkey FROM lineitem GROUP BY ALL)
SELECT o_orderkey, l_partkey FROM orders LEFT JOIN f ON o_orderkey = l_orderkey""")
def first_evidence_scalar(spark, sf):
    first = lookup.pick_per_key(table(spark, sf, "lineitem"), ["l_orderkey"], [F.col(c) for c in _KEYS], ["l_partkey"])
    return table(spark, sf, "orders").join(first, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_orderkey", "l_partkey")


@query(f"""SELECT l_orderkey, arg_min(l_partkey, {_ORDER}) AS l_partkey, min(l_shipdate) AS l_shipdate FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL""")
def first_of_filtered(spark, sf):
    return lookup.pick_per_key(table(spark, sf, "lineitem").filter("l_returnflag = 'R'"), ["l_orderkey"], [F.col(c) for c in _KEYS], ["l_partkey", "l_shipdate"])


@query("""WITH c AS (SELECT l_orderkey, count(*) AS n_children, sum(l_quantity)::BIGINT AS quantity, string_agg(l_partkey || ':' || l_linenumber, ',' ORDER BY l_linenumber, l_partkey) AS children FROM lineitem GROUP BY ALL)
SELECT o_orderkey, coalesce(n_children, 0) AS n_children, quantity, children FROM orders LEFT JOIN c ON o_orderkey = l_orderkey""")
def children_collect(spark, sf):
    kids = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("k"), F.count("*").alias("n"), F.sum("l_quantity").cast("long").alias("quantity"))
    rows = table(spark, sf, "orders").join(kids, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    text = F.array_join(F.transform("k", lambda x: F.concat(x["l_partkey"].cast("string"), F.lit(":"), x["l_linenumber"].cast("string"))), ",")
    return rows.select("o_orderkey", F.coalesce("n", F.lit(0)).alias("n_children"), "quantity", text.alias("children"))


@query("""SELECT l_orderkey FROM lineitem GROUP BY ALL HAVING bool_or(l_returnflag = 'R') AND NOT bool_or(l_returnflag = 'A')""")
def only_index_source(spark, sf):
    return lookup.with_and_without(table(spark, sf, "lineitem"), ["l_orderkey"], F.col("l_returnflag") == "R", F.col("l_returnflag") == "A")


@query("""SELECT DISTINCT user_id FROM events WHERE user_id IS NOT NULL AND user_id NOT IN (SELECT user_id FROM events WHERE event_type IN ('error', 'signup') AND ts > TIMESTAMP '2024-01-29 12:00:00')""")
def cooldown_anti(spark, sf):
    e = table(spark, sf, "events")
    recent = F.col("event_type").isin("error", "signup") & (F.col("ts") > F.lit("2024-01-29 12:00:00").cast("timestamp_ntz"))
    return lookup.not_since(e.select("user_id").dropna().distinct(), e, ["user_id"], recent)


@query("""SELECT p.p_partkey, p.p_brand, p.p_type FROM part p
WHERE NOT EXISTS (SELECT 1 FROM part q WHERE q.p_brand = p.p_brand AND q.p_retailprice < p.p_retailprice)
  AND NOT EXISTS (SELECT 1 FROM part q WHERE q.p_type = p.p_type AND q.p_size = p.p_size AND q.p_retailprice < p.p_retailprice)""")
def or_anti(spark, sf):
    """NOT (A or B) as two steps, each against a grouped minimum instead of a pairwise comparison."""
    p = table(spark, sf, "part")
    by_brand = p.groupBy("p_brand").agg(F.min("p_retailprice").alias("m1"))
    by_type = p.groupBy("p_type", "p_size").agg(F.min("p_retailprice").alias("m2"))
    return p.join(by_brand, "p_brand").filter("p_retailprice <= m1").join(by_type, ["p_type", "p_size"]).filter("p_retailprice <= m2").select("p_partkey", "p_brand", "p_type")


@query("""WITH n AS (SELECT event_id, ts, (nullif(event_type, 'error') IS NULL)::INT + (nullif(user_id % 5, 0) IS NULL)::INT + (CASE WHEN value > 10 THEN value END IS NULL)::INT AS score FROM events)
SELECT event_id, score FROM n WHERE score >= 2 ORDER BY score DESC, ts DESC, event_id LIMIT 200""")
def null_score_queue(spark, sf):
    score = lookup.null_score(F.nullif("event_type", F.lit("error")), F.nullif(F.col("user_id") % 5, F.lit(0)), F.when(F.col("value") > 10, F.col("value")))
    return table(spark, sf, "events").withColumn("score", score).filter("score >= 2").orderBy(F.desc("score"), F.desc("ts"), "event_id").limit(200).select("event_id", "score")


@query("""SELECT o_orderkey, nullif(o_orderpriority, '1-URGENT') AS priority FROM orders WHERE o_orderstatus = 'P' ORDER BY priority ASC NULLS LAST, o_orderdate DESC, o_orderkey LIMIT 500""")
def nulls_last_queue(spark, sf):
    o = table(spark, sf, "orders").filter("o_orderstatus = 'P'").withColumn("priority", F.nullif("o_orderpriority", F.lit("1-URGENT")))
    return o.orderBy(F.col("priority").asc_nulls_last(), F.desc("o_orderdate"), "o_orderkey").limit(500).select("o_orderkey", "priority")


@query("""WITH c AS (SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS seg, c_nationkey FROM customer), s AS (SELECT s_suppkey, CASE WHEN s_acctbal > 3000 THEN 'MACHINERY' END AS seg, s_nationkey FROM supplier)
SELECT c_custkey, count(*) AS n, min(s_suppkey) AS first FROM c JOIN s ON c_nationkey = s_nationkey AND c.seg IS NOT DISTINCT FROM s.seg GROUP BY c_custkey""")
def null_safe_match(spark, sf):
    """Null matches null. One side is aggregated by the key first, so that the join adds no rows."""
    c = table(spark, sf, "customer").select("c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("seg"), "c_nationkey")
    s = table(spark, sf, "supplier").groupBy("s_nationkey", F.when(F.col("s_acctbal") > 3000, "MACHINERY").alias("seg2")).agg(F.count("*").alias("n"), F.min("s_suppkey").alias("first"))
    return c.join(s, (F.col("c_nationkey") == F.col("s_nationkey")) & F.col("seg").eqNullSafe(F.col("seg2"))).select("c_custkey", "n", "first")


@query("""SELECT o_orderkey FROM orders WHERE (nullif(o_orderstatus, 'F') IS NULL OR o_orderdate >= TIMESTAMP '1997-01-01') AND (nullif(o_orderstatus, 'O') IS NULL OR o_orderdate < TIMESTAMP '1998-01-01')""")
def open_window(spark, sf):
    lower = F.when(F.col("o_orderstatus") != "F", F.lit("1997-01-01").cast("timestamp_ntz"))
    upper = F.when(F.col("o_orderstatus") != "O", F.lit("1998-01-01").cast("timestamp_ntz"))
    inside = (lower.isNull() | (F.col("o_orderdate") >= lower)) & (upper.isNull() | (F.col("o_orderdate") < upper))
    return table(spark, sf, "orders").filter(inside).select("o_orderkey")


@query("""SELECT user_id, arg_min(CASE WHEN event_type <> 'error' THEN event_type END, row(ts, event_id)) FILTER (WHERE event_type <> 'error') AS kind,
  arg_min(value, row(ts, event_id)) FILTER (WHERE value > 50) AS amount, arg_min(props, row(ts, event_id)) FILTER (WHERE event_type = 'purchase') AS props, count(*) AS sightings FROM events GROUP BY user_id""")
def canonical_upsert(spark, sf):
    e = table(spark, sf, "events").withColumns({"kind": F.nullif("event_type", F.lit("error")), "amount": F.when(F.col("value") > 50, F.col("value")), "props": F.when(F.col("event_type") == "purchase", F.col("props"))})
    return canonical.fold_known(e, ["user_id"], [F.col("ts"), F.col("event_id")], ["kind", "amount", "props"])


@query("""WITH seen AS (SELECT DISTINCT user_id, event_type FROM events WHERE value > 490)
SELECT user_id, event_type, arg_min(event_id, row(ts, event_id)) AS event_id FROM events e WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.user_id = e.user_id AND s.event_type = e.event_type) GROUP BY ALL""")
def insert_ignore(spark, sf):
    e = table(spark, sf, "events")
    return lookup.first_seen(e, e.filter("value > 490"), ["user_id", "event_type"], [F.col("ts"), F.col("event_id")], ["event_id"])


@query("""SELECT user_id, event_type, arg_max(value, row(ts, event_id)) AS value, arg_max(props, row(ts, event_id)) AS props FROM events GROUP BY ALL""")
def latest_status(spark, sf):
    return lookup.pick_per_key(table(spark, sf, "events"), ["user_id", "event_type"], [F.col("ts"), F.col("event_id")], ["value", "props"], latest=True)


@query("""SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS calls, coalesce(sum((value < 5)::INT), 0)::BIGINT AS errors FROM events GROUP BY ALL""")
def counter_upsert(spark, sf):
    return canonical.counters(table(spark, sf, "events").withColumn("day", F.to_date("ts")), ["day", "event_type"], F.col("value") < 5)


@query("""WITH o AS (SELECT c_nationkey AS k, max(c_name) AS name, nullif(max(c_mktsegment), 'MACHINERY') AS seg FROM customer WHERE c_acctbal > 5000 GROUP BY ALL),
n AS (SELECT n_nationkey AS k, n_name AS name, CASE WHEN n_regionkey > 1 THEN n_name END AS seg, true AS fresh FROM nation WHERE n_regionkey <> 3)
SELECT coalesce(n.k, o.k) AS k, CASE WHEN fresh THEN n.name ELSE o.name END AS name, coalesce(n.seg, o.seg) AS seg FROM o FULL JOIN n ON o.k = n.k""")
def dim_upsert_coalesce(spark, sf):
    old = table(spark, sf, "customer").filter("c_acctbal > 5000").groupBy(F.col("c_nationkey").alias("k")).agg(F.max("c_name").alias("name"), F.nullif(F.max("c_mktsegment"), F.lit("MACHINERY")).alias("seg"))
    new = table(spark, sf, "nation").filter("n_regionkey <> 3").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name"), F.when(F.col("n_regionkey") > 1, F.col("n_name")).alias("seg"))
    return canonical.upsert_dimension(old, new, ["k"], ["name"], ["seg"])


@query("""WITH a AS (SELECT DISTINCT s_nationkey AS k FROM supplier), b AS (SELECT DISTINCT c_nationkey AS k FROM customer WHERE c_acctbal > 5000)
SELECT (SELECT count(*) FROM a) + (SELECT count(*) FROM b) AS gross, (SELECT count(*) FROM (FROM a UNION FROM b)) AS n_distinct, (SELECT count(*) FROM a JOIN b USING (k)) AS overlap""")
def set_union_overlap(spark, sf):
    a = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("k")).distinct().withColumn("side", F.lit(1))
    b = table(spark, sf, "customer").filter("c_acctbal > 5000").select(F.col("c_nationkey").alias("k")).distinct().withColumn("side", F.lit(2))
    per = a.unionByName(b).groupBy("k").agg(F.count("*").alias("n"))
    return per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("gross"), F.count("*").alias("n_distinct"), F.count_if(F.col("n") > 1).alias("overlap"))


@query("SELECT lang, string_agg(DISTINCT source, ',' ORDER BY source) AS sources, count(*) AS n FROM documents GROUP BY ALL")
def sources_joined(spark, sf):
    return table(spark, sf, "documents").groupBy("lang").agg(F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sources"), F.count("*").alias("n"))


@query("""WITH b AS (SELECT o_custkey, arg_min(row(o_orderkey, o_orderstatus), row(CASE o_orderstatus WHEN 'O' THEN 0 WHEN 'P' THEN 1 ELSE 2 END, -epoch(o_orderdate), o_orderkey)) AS v FROM orders GROUP BY ALL)
SELECT o_custkey, v[1] AS o_orderkey, v[2] AS o_orderstatus FROM b""")
def tiered_pick(spark, sf):
    tier = F.when(F.col("o_orderstatus") == "O", 0).when(F.col("o_orderstatus") == "P", 1).otherwise(2)
    return lookup.pick_per_key(table(spark, sf, "orders"), ["o_custkey"], [tier, -F.unix_seconds(F.col("o_orderdate").cast("timestamp")), F.col("o_orderkey")], ["o_orderkey", "o_orderstatus"])


@query("""WITH s AS (SELECT user_id, arg_max(value, row(ts, event_id)) FILTER (WHERE event_type = 'view') AS view_value, arg_max(value, row(ts, event_id)) FILTER (WHERE event_type = 'click') AS click_value,
  arg_min(ts, row(ts, event_id)) FILTER (WHERE event_type = 'signup') AS first_signup, max(ts) FILTER (WHERE event_type = 'signup') AS last_signup FROM events GROUP BY ALL) FROM s""")
def version_merge(spark, sf):
    """Each section keeps its last version; one date the first, one the last."""
    by = F.struct("ts", "event_id")
    of = lambda kind, c="value": F.when(F.col("event_type") == kind, F.col(c))
    last = lambda kind: F.max_by("value", F.when(F.col("event_type") == kind, by))
    return table(spark, sf, "events").groupBy("user_id").agg(last("view").alias("view_value"), last("click").alias("click_value"), F.min(of("signup", "ts")).alias("first_signup"), F.max(of("signup", "ts")).alias("last_signup"))


@query("""WITH n AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS r, count(*) OVER () AS total FROM customer)
SELECT c_custkey FROM n WHERE r // 35 = 200 % ceil(total / 35.0)::INT""")
def rotation_batch(spark, sf):
    """The day's batch of 35 (day of year modulo the number of batches)."""
    c = table(spark, sf, "customer").select("c_custkey")
    return lookup.batch_of_day(c, "c_custkey", 35, 200)


@query("""SELECT CAST(ts AS DATE) AS day, arg_min(event_id, row(md5(CAST(ts AS DATE)::VARCHAR || ':' || event_id), event_id)) AS event_id FROM events GROUP BY ALL""")
def stable_pick(spark, sf):
    e = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    return lookup.pick_per_key(e, ["day"], [F.md5(F.concat_ws(":", F.col("day").cast("string"), F.col("event_id").cast("string"))), F.col("event_id")], ["event_id"])


@query("""SELECT 'negative_balance' AS check_name, c_custkey AS id FROM customer WHERE c_acctbal < 0
UNION ALL SELECT 'order_without_items', o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
UNION ALL SELECT 'shipped_before_order', l_orderkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate < o_orderdate""")
def integrity_suite(spark, sf):
    o, li = table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), table(spark, sf, "lineitem").select("l_orderkey", "l_shipdate")
    rows = li.count()  # from the files' footers; a task sorts about as many rows whatever their number
    o, li = spread(o, "o_orderkey", rows=rows), spread(li, "l_orderkey", rows=rows)
    found = {
        "negative_balance": table(spark, sf, "customer").filter("c_acctbal < 0").select(F.col("c_custkey").alias("id")),
        "order_without_items": o.join(li, F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").select(F.col("o_orderkey").alias("id")),
        "shipped_before_order": li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).filter("l_shipdate < o_orderdate").select(F.col("l_orderkey").alias("id")),
    }
    return consensus.checks(found, ["id"])


@query("""WITH truth AS (SELECT doc_id, quality FROM labels WHERE toxic = 0), found AS (SELECT doc_id FROM documents WHERE n_chars > 800)
SELECT quality, count(*) AS n, count(f.doc_id) AS refound, round(100.0 * count(f.doc_id) / count(*), 2)::DOUBLE AS recall_pct FROM truth t LEFT JOIN found f USING (doc_id) GROUP BY ALL""")
def recall_backtest(spark, sf):
    truth = table(spark, sf, "labels").filter("toxic = 0")
    found = table(spark, sf, "documents").filter("n_chars > 800").select("doc_id", F.lit(1).alias("hit"))
    per = truth.join(found, "doc_id", "left").groupBy("quality").agg(F.count("*").alias("n"), F.count("hit").alias("refound"))
    return per.withColumn("recall_pct", F.round((F.lit(100) * F.col("refound") / F.col("n")).cast("decimal(12,6)"), 2).cast("double"))


@query("""SELECT source, count(*) AS docs, count(*) FILTER (WHERE n_chars > 1000) AS long_docs, count(l.doc_id) AS labelled, coalesce(sum(toxic), 0)::BIGINT AS toxic FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY ALL""")
def funnel_metrics(spark, sf):
    d = table(spark, sf, "documents").join(table(spark, sf, "labels").withColumn("has", F.lit(1)), "doc_id", "left")
    return d.groupBy("source").agg(F.count("*").alias("docs"), F.count_if(F.col("n_chars") > 1000).alias("long_docs"), F.count("has").alias("labelled"), F.coalesce(F.sum("toxic"), F.lit(0)).cast("long").alias("toxic"))
