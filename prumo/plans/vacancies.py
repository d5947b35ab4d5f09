"""Queries on canonical records, resolution of places and contests, the call monitor, sinks with logs and control of runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from prumo.functions import text
from prumo.operators import canonical, lookup, monitor, resolve, writes
from prumo.plans.common import table
from prumo.streaming import control

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLE_SQL[f.__name__] = f, sql
        return f

    return add


# canonical records: sightings from events, canonical rows from nations


def _upserted(spark, sf) -> canonical.Upserted:
    e, n = table(spark, sf, "events"), table(spark, sf, "nation")
    even = F.col("event_id") % 2 == 0
    new = e.select(
        "event_id", "ts", (F.col("user_id") % 20).alias("city"), F.when(F.col("event_type") != "error", F.col("event_type")).alias("number"),
        F.when(even, "Prefeitura do Município de Luz").otherwise("Prefeitura Municipal de Luz - SMS").alias("organ"), F.when(even, "Médico Ginecologista/Obstetra").otherwise("medico  ginecologista / obstetra").alias("role"),
        F.lit("aberta").alias("status"), F.when(F.col("value") > 50, F.col("value")).alias("pay"), F.when(F.col("value") > 450, F.col("props")).alias("terms"),
        F.when(F.col("value") < 250, F.col("event_type")).alias("problem"), (F.col("value") > 100).alias("flag"), (F.col("event_id") % 3).alias("source"), F.concat(F.lit("x"), F.floor(F.col("event_id") / 6)).alias("external"),
    )
    known = n.select(
        F.concat(F.lit("n"), F.col("n_nationkey")).alias("id"), (F.col("n_nationkey") % 20).cast("long").alias("city"), F.when(F.col("n_regionkey") != 4, F.lit("view")).alias("number"), F.lit("PREFEITURA DE LUZ").alias("organ"),
        F.lit("Medico Ginecologista/Obstetra").alias("role"), F.lit("revisada").alias("status"), F.when(F.col("n_regionkey") == 1, F.lit(1.0)).alias("pay"), F.lit(None).cast("string").alias("terms"), F.lit("old").alias("problem"),
    )
    seen = e.filter("event_type = 'signup'").select((F.col("event_id") % 3).alias("source"), F.concat(F.lit("x"), F.floor(F.col("event_id") / 6)).alias("external"))
    folded = {"organ": text.organ_key(F.col("organ")), "role": text.dedup_key(F.col("role"))}
    return canonical.upsert_records(known, seen, new, row="event_id", order=[F.col("ts"), F.col("event_id")], keys=["city"], number="number", folded=folded, fixed=["status"], optional=["pay", "terms"], problem="problem", overwrite="flag", evidence=["source", "external"])


_SIGHTINGS = """WITH e AS (SELECT event_id, ts, user_id % 20 AS city, CASE WHEN event_type <> 'error' THEN event_type END AS number, CASE WHEN value > 50 THEN value END AS pay, CASE WHEN value > 450 THEN props END AS terms,
  CASE WHEN value < 250 THEN event_type END AS problem, value > 100 AS flag, event_id % 3 AS source, 'x' || (event_id // 6) AS external, event_type FROM events),
k AS (SELECT min('n' || n_nationkey) AS id, n_nationkey % 20 AS city, 'view' AS number FROM nation WHERE n_regionkey <> 4 GROUP BY n_nationkey % 20),
g AS (SELECT e.*, CASE WHEN e.number IS NULL THEN 'row ' || event_id ELSE e.city || ' ' || e.number END AS grp, k.id AS old FROM e LEFT JOIN k ON e.city = k.city AND e.number = k.number),
f AS (SELECT grp, any_value(old) AS old, any_value(city) AS city, any_value(number) AS number, arg_min(event_id, row(ts, event_id)) AS maker, arg_min(pay, row(ts, event_id)) FILTER (WHERE pay IS NOT NULL) AS pay, arg_min(terms, row(ts, event_id)) FILTER (WHERE terms IS NOT NULL) AS terms,
  bool_or(flag) AS flagged, max(row(ts, event_id, problem)) FILTER (WHERE flag) AS said, min(row(ts, event_id, problem)) AS first FROM g GROUP BY grp)
"""


@query(_SIGHTINGS + """SELECT n.city, n.number, 'revisada' AS status, coalesce(n.pay, f.pay) AS pay, f.terms AS terms, CASE WHEN coalesce(f.flagged, false) THEN said[3] ELSE 'old' END AS problem FROM
  (SELECT 'n' || n_nationkey AS id, n_nationkey % 20 AS city, CASE WHEN n_regionkey <> 4 THEN 'view' END AS number, CASE WHEN n_regionkey = 1 THEN 1.0 END AS pay FROM nation) n LEFT JOIN f ON f.old = n.id
UNION ALL SELECT city, number, 'aberta', pay, terms, CASE WHEN flagged THEN said[3] ELSE first[3] END FROM f WHERE old IS NULL""")
def canonical_records(spark, sf):
    """All records after an upsert: known ones keep what they know, sightings without a number stay apart."""
    return _upserted(spark, sf).records.select("city", "number", "status", "pay", "terms", "problem")


@query(_SIGHTINGS + """, o AS (SELECT source, external, arg_min(event_id, row(ts, event_id)) AS owner FROM e GROUP BY ALL), s AS (SELECT DISTINCT source, external FROM e WHERE event_type = 'signup')
SELECT g.event_id, g.old AS known_id, g.old IS NULL AND g.event_id = f.maker AS created, o.owner = g.event_id AND s.source IS NULL AS evidence FROM g JOIN f USING (grp) JOIN o ON g.source = o.source AND g.external = o.external LEFT JOIN s ON g.source = s.source AND g.external = s.external""")
def canonical_results(spark, sf):
    """What each sighting did: its record if it was known, whether it made one, whether its evidence is new."""
    r = _upserted(spark, sf).results
    return r.select("event_id", F.when(F.col("id").rlike("^n[0-9]+$"), F.col("id")).alias("known_id"), "created", F.col("evidence_id").isNotNull().alias("evidence"))


# resolution


@query("SELECT s_suppkey, n_nationkey AS code FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey AND n_regionkey <> 2")
def folded_name_join(spark, sf):
    left = table(spark, sf, "supplier").select("s_suppkey", F.concat(F.lit("Naçõ "), F.col("s_nationkey")).alias("name"), F.lit("MG").alias("uf"))
    n = table(spark, sf, "nation").filter("n_regionkey <> 2").select(F.explode(F.array(F.col("n_nationkey"), F.col("n_nationkey") + 100)).alias("code"), F.concat(F.lit("NACO "), F.col("n_nationkey")).alias("name"), F.lit("MG").alias("uf"))
    return resolve.by_folded_name(left, n, "name", ["uf"], "code").select("s_suppkey", "code")


@query("""SELECT o_orderkey, n_nationkey AS code FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE n_nationkey >= 10""")
def places_in_order_titles(spark, sf):
    """Every order's title names the nation of its customer; names of one digit are the beginning of longer ones."""
    o, c, n = (table(spark, sf, t) for t in ("orders", "customer", "nation"))
    titles = o.join(c, F.col("o_custkey") == F.col("c_custkey")).filter("c_nationkey >= 10").select("o_orderkey", F.concat(F.lit("Edital da Prefeitura de Náção "), F.col("c_nationkey").cast("string"), F.lit(", abertura")).alias("title"), F.lit("http://x").alias("link"))
    places = n.select(F.col("n_nationkey").alias("code"), F.concat(F.lit("Nacao "), F.col("n_nationkey")).alias("name"), F.lit("MG").alias("uf"))
    return resolve.place_in_title(titles, "o_orderkey", "title", "link", places, "code", "name", "uf")


@query("""SELECT p_partkey, CASE WHEN p_size > 25 THEN p_size ELSE q.least END AS pay FROM part LEFT JOIN (SELECT p_brand, min(p_size) AS least FROM part WHERE p_retailprice > 1000 GROUP BY ALL) q USING (p_brand)""")
def fill_by_role(spark, sf):
    p = table(spark, sf, "part")
    page = p.select("p_partkey", F.concat(F.lit("Função "), "p_brand").alias("role"), F.when(F.col("p_size") > 25, F.col("p_size")).alias("pay"))
    notice = p.filter("p_retailprice > 1000").groupBy("p_brand").agg(F.min("p_size").alias("pay")).select(F.concat(F.lit("FUNCAO  "), F.lower("p_brand")).alias("role"), "pay")
    return resolve.fill_by_role(page, notice, "role", ["pay"]).select("p_partkey", "pay")


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_custkey WHEN o_orderstatus = 'O' THEN -o_custkey END AS pay FROM orders""")
def entry_in_array(spark, sf):
    """The first entry of a reply's list with the wanted role; a status P asks for one that isn't there."""
    roles = F.array(F.struct(F.lit("Médico").alias("role"), F.col("o_custkey").alias("pay")), F.struct(F.lit("Enfermeiro").alias("role"), (-F.col("o_custkey")).alias("pay")), F.struct(F.lit("MEDICO").alias("role"), F.lit(0).cast("long").alias("pay")))
    wanted = F.when(F.col("o_orderstatus") == "F", "médico ").when(F.col("o_orderstatus") == "O", "ENFERMEIRO").otherwise("Motorista")
    o = table(spark, sf, "orders").select("o_orderkey", roles.alias("entries"), wanted.alias("wanted"))
    return resolve.entry_of(o, "o_orderkey", "entries", "role", "wanted").select("o_orderkey", F.col("entry.pay").alias("pay"))


# the call monitor


@query("""SELECT doc_id AS key, o_custkey AS watch FROM documents JOIN (SELECT o_custkey, min(o_orderkey) AS d FROM orders GROUP BY ALL) ON doc_id = d WHERE doc_id % 3 <> 0""")
def watched_names_in_documents(spark, sf):
    """Names put at the end of documents whose ids are orders; each third document gets them with a signature."""
    d, o = table(spark, sf, "documents"), table(spark, sf, "orders").groupBy("o_custkey").agg(F.min("o_orderkey").alias("key"))
    name = F.concat(F.lit("Zulmira Xk"), F.translate(F.col("o_custkey").cast("string"), "0123456789", "abcdefghij"), F.lit(" de Paiva"))
    watch = o.select(F.col("o_custkey").alias("watch"), name.alias("name"), F.lit(None).cast("int").alias("rank"), "key")
    said = F.concat("text", F.lit(" Convoca a candidata "), "name", F.when(F.col("key") % 3 == 0, ", Secretaria de Obras").otherwise(", aprovada."))
    pubs = d.join(watch.select("key", "name"), F.col("doc_id") == F.col("key")).select("key", F.lit("Ato").alias("title"), said.alias("text"))
    return monitor.watched_names(pubs, watch.drop("key")).select("key", "watch")


# picks by date, sinks, control of runs


@query("""SELECT o_custkey, arg_max(o_orderkey, row(coalesce(d, DATE '0001-01-01'), -o_orderkey)) AS latest, arg_min(o_orderkey, row(coalesce(d, DATE '9999-12-31'), o_orderkey)) AS earliest
FROM (SELECT o_custkey, o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN CAST(o_orderdate AS DATE) END AS d FROM orders) GROUP BY ALL""")
def dated_picks(spark, sf):
    """The latest and the earliest order by a date that is often missing: a missing one never wins over a known one."""
    o = table(spark, sf, "orders").withColumn("d", F.when(F.col("o_orderstatus") != "F", F.to_date("o_orderdate")))
    last = lookup.pick_by_date(o, ["o_custkey"], "d", [F.col("o_orderkey")], ["o_orderkey"], True).withColumnRenamed("o_orderkey", "latest")
    return last.join(lookup.pick_by_date(o, ["o_custkey"], "d", [F.col("o_orderkey")], ["o_orderkey"], False).withColumnRenamed("o_orderkey", "earliest"), "o_custkey")


@query("""SELECT event_id, event_type <> 'signup' AND row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1 AS is_new FROM events""")
def insert_flags(spark, sf):
    e = table(spark, sf, "events")
    return lookup.insert_flags(e, e.filter("event_type = 'signup'"), ["user_id", "event_type"], [F.col("ts"), F.col("event_id")], "event_id")


@query("""SELECT o_orderkey, o_orderstatus AS before, CASE WHEN o_orderpriority = '5-LOW' THEN 'P' ELSE 'F' END AS after FROM orders WHERE o_orderpriority = '5-LOW' AND o_orderstatus <> 'P' OR o_orderpriority <> '5-LOW' AND o_totalprice > 300000 AND o_orderstatus <> 'F'""")
def state_log(spark, sf):
    """The log of a change of states: rows that have the state already log nothing."""
    to = {"P": F.col("o_orderpriority") == "5-LOW", "F": F.col("o_totalprice") > 300000}
    _, log = writes.transition(table(spark, sf, "orders"), "o_orderkey", "o_orderstatus", to, F.lit("2026-01-01"))
    return log.drop("at")


@query("""SELECT n_nationkey, n_name, '| ' || n_nationkey || ' | a\\|' || n_name || ' |  |' AS line FROM nation""")
def markdown_report(spark, sf):
    n = table(spark, sf, "nation").select("n_nationkey", "n_name", F.concat(F.lit("a|"), "n_name").alias("t"), F.lit(None).cast("string").alias("empty"))
    return writes.markdown_rows(n, ["n_nationkey", "t", "empty"]).join(n.select("n_nationkey", "n_name"), "n_nationkey").select("n_nationkey", "n_name", "line")


@query("""SELECT user_id, CAST(max(ts) AS DATE) AS day FROM events GROUP BY user_id HAVING max(ts) FILTER (WHERE event_type = 'signup') IS NULL OR max(ts) >= max(ts) FILTER (WHERE event_type = 'signup') + INTERVAL 7 DAY""")
def once_in_seven_days(spark, sf):
    e = table(spark, sf, "events")
    last = e.groupBy("user_id").agg(F.max("ts").alias("ts"))
    return lookup.once_per(last, e.filter("event_type = 'signup'"), ["user_id"], "ts", 7).select("user_id", F.to_date("ts").alias("day"))


@query("SELECT event_id, 'bad number' AS error FROM events WHERE event_type = 'error' OR value < 5")
def isolated_failures(spark, sf):
    """One bad item doesn't end the lot: its error is a row."""
    e = table(spark, sf, "events")
    said = F.when(F.col("event_type") == "error", F.lit("x")).when(F.col("value") < 5, F.lit("")).otherwise(F.col("value").cast("string"))
    return writes.isolated(e, F.when(said.try_cast("double").isNull(), "bad number"))[1].select("event_id", "error")


@query("""WITH b AS (SELECT event_id // 500 AS batch, bool_or(event_type = 'error' AND value > 480) AS alive FROM events GROUP BY ALL)
SELECT batch, alive, batch < coalesce((SELECT min(batch) FROM b WHERE NOT alive), 1000000000000) AS trusted FROM b""")
def canary_batches(spark, sf):
    return control.canary(table(spark, sf, "events"), "batch", "event_id", (F.col("event_type") == "error") & (F.col("value") > 480), 500)


@query("""SELECT event_id, greatest(20, coalesce(max(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING), 20)) AS estimate FROM events""")
def cost_estimates(spark, sf):
    return control.estimates(table(spark, sf, "events"), "user_id", ["ts", "event_id"], "value", 20.0).select("event_id", "estimate")


@query("""WITH m AS (SELECT *, sum((event_type <> 'error')::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM events)
SELECT user_id, max(ts) AS since, max(ts) + INTERVAL 600 SECOND AS until FROM m WHERE event_type = 'error' GROUP BY user_id, island HAVING count(*) >= 3""")
def quarantine(spark, sf):
    failed = control.runs(table(spark, sf, "events"), "user_id", ["ts", "event_id"], F.col("event_type") == "error", 3, "ts")
    return control.quarantine(failed, "user_id", 600)


@query("""WITH u AS (SELECT CAST(ts AS DATE) AS day, event_type AS kind, count(*) AS n FROM events GROUP BY ALL), r AS (SELECT day, kind, n, CASE kind WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'error' THEN 3 END AS rank FROM u WHERE kind IN ('view', 'click', 'error'))
SELECT day, arg_min(kind, row(n, rank)) FILTER (WHERE n < CASE kind WHEN 'view' THEN 60 ELSE 1000000000000 END AND NOT (kind = 'error' AND isodow(day) = 1)) AS kind FROM r GROUP BY day""")
def capped_dispatch(spark, sf):
    """Per day the least used kind under its cap; errors are out on Mondays."""
    e = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    out = e.filter(F.weekday("day") == 0).select("day", F.lit("error").alias("event_type"))
    used = e.groupBy("day", "event_type").agg(F.count("*").alias("n"))
    return control.dispatch(used, "day", "event_type", "n", ["view", "click", "error"], {"view": 60}, out).withColumnRenamed("event_type", "kind")


@query("""WITH s AS (SELECT conv_id, turn, trim(unnest(string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(10), 'g'), chr(10)))) AS s FROM conversations),
n AS (SELECT conv_id, s, min(turn) AS turn FROM s WHERE s <> '' GROUP BY ALL), f AS (SELECT conv_id, min(turn) AS first FROM n GROUP BY ALL)
SELECT conv_id, turn, count(*) AS n FROM n JOIN f USING (conv_id) WHERE turn > first OR contains(lower(s), 'the') GROUP BY ALL""")
def first_read_alerts(spark, sf):
    """New sentences that may alert: of a page's first read only those with the watched word."""
    rows = control.sentence_rows(table(spark, sf, "conversations"), ["conv_id", "turn"], "text").groupBy("conv_id", "sentence").agg(F.min("turn").alias("turn"))
    return control.first_reads(rows, "conv_id", "turn", F.lower("sentence").contains("the")).groupBy("conv_id", "turn").agg(F.count("*").alias("n"))


@query("SELECT event_id FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 10 DAY")
def late_rows(spark, sf):
    e = table(spark, sf, "events")
    mark = e.agg(F.max("ts").alias("mark"))
    return control.late(e.join(F.broadcast(mark)), "ts", F.col("mark"), "10 days").select("event_id")


@query("""SELECT p_partkey, p_size AS code, CASE WHEN p_size % 4 = 0 THEN p_size / 2.0 WHEN n_nationkey IS NOT NULL THEN n_nationkey + 0.5 END AS latitude FROM part LEFT JOIN nation ON p_size = n_nationkey""")
def coordinates(spark, sf):
    """Missing coordinates from a map of codes in which each code comes twice."""
    from prumo.sources import files

    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("code"), F.explode(F.array((F.col("n_nationkey") + 0.5).cast("double"), (F.col("n_nationkey") + 9.5).cast("double"))).alias("latitude"), F.lit(1.0).alias("longitude"))
    p = table(spark, sf, "part").select("p_partkey", F.col("p_size").alias("code"), F.when(F.col("p_size") % 4 == 0, F.col("p_size") / 2).alias("latitude"), F.lit(None).cast("double").alias("longitude"))
    return files.with_coordinates(p, n, "code").select("p_partkey", "code", "latitude")


