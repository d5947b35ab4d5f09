"""Queries on feeds, JSON and HTML sources, on sinks, on coverage and on guards before them."""

from __future__ import annotations

from pyspark.sql import functions as F

from prumo.functions import text, values
from prumo.operators import coverage, lookup, writes
from prumo.plans.common import table
from prumo.sources import feeds, html

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLE_SQL[f.__name__] = f, sql
        return f

    return add


# sources


@query("""SELECT n_regionkey, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS ordinal, n_name AS title, 'http://feed/' || n_nationkey AS link FROM nation WHERE n_regionkey <> 3""")
def rss_feed(spark, sf):
    """Feeds of nations, one per region; the feed of region 3 is cut off in the middle of a tag."""
    item = F.concat(F.lit("<item><title>"), "n_name", F.lit("</title><link>http://feed/"), F.col("n_nationkey").cast("string"), F.lit("</link></item>"))
    n = table(spark, sf, "nation").groupBy("n_regionkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", item.alias("x")))), lambda e: e["x"]), "").alias("x"))
    whole = F.concat(F.lit("<rss><channel>"), "x", F.lit("</channel></rss>"))
    feed = n.withColumn("xml", F.when(F.col("n_regionkey") == 3, F.lit("<rss><channel><item><tit")).otherwise(whole))
    return feeds.rss_items(feed, "n_regionkey", "xml").select("n_regionkey", F.col("ordinal").cast("long").alias("ordinal"), "title", "link")


@query("""SELECT l_orderkey, l_linenumber AS line, l_partkey AS part FROM lineitem WHERE l_returnflag <> 'A' AND l_orderkey % 10 <> 0""")
def embedded_json_rows(spark, sf):
    """Arrays inside page scripts. Rows without a part are left out, as are pages whose array holds arrays, not objects."""
    row = F.struct(F.col("l_linenumber").alias("line"), F.when(F.col("l_returnflag") != "A", F.col("l_partkey")).alias("part"))
    o = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.to_json(F.collect_list(row)).alias("j"))
    array = F.when(F.col("l_orderkey") % 10 == 0, '[["no", "rows"]]').otherwise(F.col("j"))
    page = o.withColumn("page", F.concat(F.lit('<html><script>var d = {"total": 1, "jsonArray": '), array, F.lit(', "end": []};</script></html>')))
    return feeds.json_rows(page, ["l_orderkey"], feeds.embedded_array(F.col("page"), "jsonArray"), "line int, part long", "part")


@query("""SELECT s_nationkey, s_suppkey::VARCHAR AS code, s_name AS name FROM supplier WHERE s_suppkey % 7 <> 0""")
def data_table_records(spark, sf):
    """Tables sent as names and rows of values, 500 suppliers at most each; each seventh row has a value too few."""
    full = F.array(F.col("s_suppkey").cast("string"), F.col("s_name"))
    row = F.when(F.col("s_suppkey") % 7 == 0, F.slice(full, 1, 1)).otherwise(full)
    sent = table(spark, sf, "supplier").groupBy("s_nationkey", F.floor(F.col("s_suppkey") / 500)).agg(F.to_json(F.collect_list(row)).alias("rows"))
    got = feeds.data_table(sent, "s_nationkey", F.lit('["Code", "Name"]'), F.col("rows"))
    return got.select("s_nationkey", F.col("record")["Code"].alias("code"), F.col("record")["Name"].alias("name"))


@query("""SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k, 'a\\d' || user_id AS path FROM events""")
def json_repair(spark, sf):
    """Replies in a code fence with a backslash that starts no escape."""
    reply = F.concat(F.lit('```json\n{"path": "a\\d'), F.col("user_id").cast("string"), F.lit('", "inner": '), F.col("props"), F.lit("}\n```"))
    e = table(spark, sf, "events").withColumn("j", feeds.repaired(reply))
    return e.select("event_id", values.json_int(F.col("j"), "$.inner.k").alias("k"), F.get_json_object("j", "$.path").alias("path"))


@query("""SELECT c_custkey, r::INT AS row, c::INT AS cell, CASE WHEN r = 0 THEN ['Cargo', 'Valor'][c + 1] WHEN c = 0 THEN c_mktsegment ELSE c_nationkey::VARCHAR END AS value
FROM customer, range(2) a(r), range(2) b(c)""")
def html_table_cells(spark, sf):
    page = F.concat(F.lit('<table class="x"><tr><th>Cargo</th><th> Valor </th></tr>\n<tr id="1"><td><b>'), "c_mktsegment", F.lit("</b></td><td>\n"), F.col("c_nationkey").cast("string"), F.lit("</td></tr></table>"))
    return html.table_cells(table(spark, sf, "customer").withColumn("page", page), "c_custkey", "page")


@query("""SELECT c_custkey, c_name AS nome, c_mktsegment AS segmento FROM customer""")
def detail_labels(spark, sf):
    """Label and value pairs of two layouts; a label that comes again doesn't overwrite."""
    a = F.concat(F.lit("<ul><li>Nome: "), "c_name", F.lit("</li><li>Segmento : "), "c_mktsegment", F.lit("</li><li>Nome: other</li></ul>"))
    b = F.concat(F.lit("<p>Titulo: "), "c_name", F.lit("</p><p>SEGMENTO: "), "c_mktsegment", F.lit("</p>"))
    m = table(spark, sf, "customer").withColumn("m", html.labelled_values(F.when(F.col("c_custkey") % 2 == 0, a).otherwise(b)))
    return m.select("c_custkey", F.coalesce(F.col("m")["nome"], F.col("m")["titulo"]).alias("nome"), F.col("m")["segmento"].alias("segmento"))


# sinks


@query("""SELECT c_custkey, CASE WHEN c_nationkey = 3 THEN 'REVIEWED' ELSE c_mktsegment END AS c_mktsegment, CASE WHEN c_acctbal >= 0 THEN c_acctbal WHEN c_nationkey = 3 THEN 0 END AS c_acctbal FROM customer""")
def allowed_update(spark, sf):
    """A plain set of one column and a set of another only where it is null."""
    c = table(spark, sf, "customer").withColumn("c_acctbal", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")))
    allowed, here = {"c_mktsegment", "c_acctbal"}, F.col("c_nationkey") == 3
    c = writes.set_columns(c, here, {"c_mktsegment": F.lit("REVIEWED")}, allowed)
    return writes.set_columns(c, here, {"c_acctbal": F.lit(0.0)}, allowed, only_null=True).select("c_custkey", "c_mktsegment", "c_acctbal")


@query("""SELECT c_custkey, coalesce(nullif(c_mktsegment, 'BUILDING'), CASE WHEN n_nationkey % 2 = 0 THEN n_name END) AS seg FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""")
def fill_only_null(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("k"), F.nullif("c_mktsegment", F.lit("BUILDING")).alias("seg"))
    new = table(spark, sf, "nation").filter("n_nationkey % 2 = 0").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("seg"))
    return writes.fill_null(c, new, ["k"], "seg").select("c_custkey", "seg")


@query("""SELECT source, lang, CASE WHEN lang = 'en' THEN 'old-' || source ELSE left(sha256('{"source":' || coalesce('"' || source || '"', 'null') || ',"lang":' || coalesce('"' || lang || '"', 'null') || '}'), 16) END AS id, coalesce(lang <> 'en', true) AS created
FROM (SELECT DISTINCT source, lang FROM documents)""")
def get_or_create(spark, sf):
    d = table(spark, sf, "documents")
    known = d.filter("lang = 'en'").select("source", "lang").distinct().withColumn("id", F.concat(F.lit("old-"), "source"))
    return writes.get_or_create(d, known, ["source", "lang"], "id")


@query("""SELECT event_id, row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts, event_id) = 1 AS owned FROM events""")
def claim_rows(spark, sf):
    return writes.claim(table(spark, sf, "events"), ["event_type", "user_id"], [F.col("ts"), F.col("event_id")], "event_id")


@query("""SELECT user_id, CAST(ts AS DATE) AS day, arg_min(event_id, row(CASE event_type WHEN 'purchase' THEN 1 WHEN 'signup' THEN 2 ELSE 3 END, ts, event_id)) AS event_id FROM events GROUP BY ALL""")
def priority_insert(spark, sf):
    e = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    return writes.priority_insert(e, ["user_id", "day"], "event_type", ["purchase", "signup"], [F.col("ts"), F.col("event_id")], ["event_id"])


# coverage, filters, sorts


@query("""WITH s AS (SELECT DISTINCT s_nationkey AS k FROM supplier WHERE s_acctbal > 7000) SELECT n_nationkey, n_name FROM nation
WHERE n_nationkey NOT IN (FROM s) AND n_regionkey IN (SELECT n_regionkey FROM nation JOIN s ON n_nationkey = k)""")
def uncovered_keys(spark, sf):
    seen = table(spark, sf, "supplier").filter("s_acctbal > 7000").select(F.col("s_nationkey").alias("n_nationkey"))
    return coverage.uncovered(table(spark, sf, "nation"), seen, ["n_nationkey"], "n_regionkey").select("n_nationkey", "n_name")


@query("""SELECT user_id, CASE WHEN bool_or(event_type = 'purchase' AND value > 400) THEN 'coberto' WHEN bool_or(event_type = 'error') THEN 'erro' ELSE 'sem_dados' END AS status FROM events GROUP BY ALL""")
def coverage_status(spark, sf):
    return coverage.status(table(spark, sf, "events"), ["user_id"], (F.col("event_type") == "purchase") & (F.col("value") > 400), F.col("event_type") == "error")


@query("""WITH w AS (SELECT user_id, CAST(d AS DATE) AS day FROM (SELECT DISTINCT user_id FROM events), generate_series(DATE '2024-01-01', DATE '2024-01-30', INTERVAL 1 DAY) g(d) WHERE isodow(d) < 6 AND user_id IS NOT NULL)
SELECT user_id, day FROM w ANTI JOIN (SELECT user_id, CAST(ts AS DATE) AS day FROM events) USING (user_id, day)""")
def silent_days(spark, sf):
    e = table(spark, sf, "events").select("user_id", F.to_date("ts").alias("day"))
    return coverage.silent_days(e, "user_id", "day", "2024-01-01", "2024-01-30")


@query("""WITH h AS (SELECT page_id, regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1)), '^www\\.', '') AS host FROM pages)
SELECT page_id, host FROM h WHERE host NOT IN (SELECT host FROM h GROUP BY host HAVING count(*) >= 3)""")
def unknown_domains(spark, sf):
    p = table(spark, sf, "pages").select("page_id", text.host(F.col("url")).alias("host"))
    return p.join(p.groupBy("host").agg(F.count("*").alias("n")).filter("n >= 3"), "host", "left_anti").select("page_id", "host")


@query("""SELECT page_id, v.kind, v.kind = 'as is' AS safe FROM pages, (VALUES ('as is'), ('user'), ('address'), ('local'), ('file'), ('null')) v(kind)""")
def safe_urls(spark, sf):
    forms = {"as is": F.col("url"), "user": F.replace("url", F.lit("://"), F.lit("://admin@")), "address": F.lit("http://169.254.169.254/latest"), "local": F.lit("https://db.internal:5432/x"), "file": F.lit("file:///etc/passwd"), "null": F.lit(None).cast("string")}
    all_forms = F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), u.alias("u")) for k, u in forms.items())))
    return table(spark, sf, "pages").select("page_id", all_forms.alias("f")).select("page_id", "f.kind", text.safe_url(F.col("f.u")).alias("safe"))


@query("""SELECT p_partkey FROM part WHERE (p_name ILIKE '%WIDGET' OR p_name ILIKE 'Large%') AND replace(p_name, ' ', '_') LIKE '%\\_b%' ESCAPE '\\' OR left(coalesce(p_type, ''), 4) <> 'ECON' AND p_size IN (1, 5, 9)""")
def pattern_filters(spark, sf):
    either = F.col("p_name").ilike("%WIDGET") | F.col("p_name").ilike("Large%")
    escaped = F.replace("p_name", F.lit(" "), F.lit("_")).like(r"%\_b%")
    return table(spark, sf, "part").filter((either & escaped) | (~F.coalesce("p_type", F.lit("")).startswith("ECON") & F.col("p_size").isin(1, 5, 9))).select("p_partkey")


@query("""SELECT o_orderkey FROM orders WHERE o_orderstatus IS NOT NULL AND nullif(o_orderpriority, '5-LOW') IS NOT NULL AND o_orderdate > TIMESTAMP '1996-01-01' - INTERVAL 400 DAY
AND (o_orderstatus = 'P' OR date_diff('day', DATE '1996-01-01', CAST(o_orderdate AS DATE)) >= 5)""")
def publishable(spark, sf):
    """All mandatory fields known and not empty, recent, and an end date that is unknown or five days ahead."""
    end, today = F.when(F.col("o_orderstatus") != "P", F.to_date("o_orderdate")), F.lit("1996-01-01").cast("date")
    must = [F.col("o_orderstatus"), F.nullif("o_orderpriority", F.lit("5-LOW"))]
    known = F.forall(F.array(*must), lambda x: x.isNotNull() & (x != ""))
    fresh = F.col("o_orderdate") > F.date_sub(today, 400).cast("timestamp_ntz")
    return table(spark, sf, "orders").filter(known & fresh & F.coalesce(F.datediff(end, today) >= 5, F.lit(True))).select("o_orderkey")


@query("""SELECT user_id, arg_min(event_type, row(ts, event_id)) AS first_type, bool_or(value > 480) AS any_large FROM events GROUP BY ALL""")
def distinct_first_wins(spark, sf):
    """Distinct by key in arrival order: the first row stays and takes over a flag that any row has."""
    return table(spark, sf, "events").groupBy("user_id").agg(F.min_by("event_type", F.struct("ts", "event_id")).alias("first_type"), F.bool_or(F.col("value") > 480).alias("any_large"))


@query("""SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F' ORDER BY (o_orderpriority = '1-URGENT') DESC, o_orderkey LIMIT 300""")
def signal_first(spark, sf):
    """A stable partition: urgent rows first, each part in its own order; the first 300."""
    return table(spark, sf, "orders").filter("o_orderstatus <> 'F'").orderBy(F.desc(F.col("o_orderpriority") == "1-URGENT"), "o_orderkey").limit(300).select("o_orderkey")


@query("""SELECT l_orderkey, string_agg(l_partkey, ',' ORDER BY l_linenumber, l_partkey) AS children FROM lineitem WHERE l_orderkey IN (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R' ORDER BY 1 LIMIT 100) AND l_returnflag = 'R' GROUP BY ALL""")
def first_groups(spark, sf):
    """Children of the first 100 groups only: groups are chosen before their children are collected."""
    l = table(spark, sf, "lineitem").filter("l_returnflag = 'R'")  # noqa: E741
    chosen = l.select("l_orderkey").distinct().orderBy("l_orderkey").limit(100)
    kids = l.join(chosen, "l_orderkey", "left_semi").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("k"))
    return kids.select("l_orderkey", F.array_join(F.transform("k", lambda x: x["l_partkey"].cast("string")), ",").alias("children"))


@query("""SELECT event_id FROM events e WHERE event_type = 'click' AND NOT EXISTS (SELECT 1 FROM events v WHERE v.event_type = 'view' AND v.user_id = e.user_id AND CAST(v.ts AS DATE) = CAST(e.ts AS DATE))""")
def suppress_repeats(spark, sf):
    """Findings of a later source whose key and day an earlier source already gave are left out."""
    e = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    return lookup.not_since(e.filter("event_type = 'click'"), e, ["user_id", "day"], F.col("event_type") == "view").select("event_id")


# functions


@query("""SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_size ELSE p_size % 10 + 1 END AS days FROM part WHERE p_size % 5 <> 0
UNION ALL SELECT p_partkey, NULL FROM part WHERE p_size % 5 = 0""")
def deadline_words(spark, sf):
    n = F.col("p_size")
    word = F.element_at(F.array(*map(F.lit, values.NUMBER_WORDS)), (n % 10 + 1).cast("int"))
    said = F.when(n % 5 == 0, F.lit("sem prazo")).when(n % 2 == 0, F.concat(F.lit("no Prazo de "), n.cast("string"), F.lit(" (x) dias"))).otherwise(F.concat(F.lit("prazo de "), word, F.lit(" dias")))
    return table(spark, sf, "part").select("p_partkey", values.deadline_days(said).alias("days"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 < 2 THEN CAST(o_orderdate AS DATE) END AS day, CASE WHEN o_orderkey % 3 < 2 THEN isodow(o_orderdate)::INT - 1 END AS weekday FROM orders""")
def date_mixed(spark, sf):
    k, d = F.col("o_orderkey") % 3, F.col("o_orderdate")
    said = F.when(k == 0, F.date_format(d, "yyyy-MM-dd HH:mm")).when(k == 1, F.date_format(d, "dd/MM/yyyy")).otherwise(F.lit("31/02/2024"))
    day = values.date_mixed(said)
    return table(spark, sf, "orders").select("o_orderkey", day.alias("day"), F.weekday(day).alias("weekday"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice::DECIMAL(12, 2) END AS monthly, CASE WHEN o_orderkey % 3 = 1 THEN 'R$ 50 por hora' END AS shift, CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey::INT END AS openings, o_orderkey % 4 = 0 AS reserve FROM orders""")
def pay_and_openings(spark, sf):
    """Strict amounts need cents after R$; pay by the hour stays text; counts may name a reserve list."""
    k = F.col("o_orderkey")
    pay = F.when(k % 3 == 0, values.brl(F.col("o_totalprice").cast("decimal(12,2)"))).when(k % 3 == 1, F.lit("R$ 50 por hora")).otherwise(F.lit("a combinar"))
    count = F.when(k % 4 == 0, F.concat(k.cast("string"), F.lit(" + CR"))).when(k % 2 == 0, k.cast("string")).otherwise(F.lit("crescente"))
    return table(spark, sf, "orders").select("o_orderkey", values.strict_brl(pay).alias("monthly"), values.paid_by_shift(pay).alias("shift"), values.parse_count(count).alias("openings"), values.reserve_list(count).alias("reserve"))


@query("""SELECT p_partkey, replace(p_name, ' ', '-') || '-do-' || lower(p_type) || '|' || replace(p_name, ' ', '') || 'do' || lower(p_type) || '|' || replace(p_name, ' ', '-') || '-' || lower(p_type) || '|' || replace(p_name, ' ', '') || lower(p_type) AS slugs,
p_name AS rest FROM part""")
def slug_variants(spark, sf):
    place = F.concat("p_name", F.lit(" do "), "p_type")
    rest = text.strip_prefix(F.concat(F.lit("Prefeitura de "), "p_name"), ["CAMARA DE", "PREFEITURA DE"])
    return table(spark, sf, "part").select("p_partkey", F.array_join(text.slug_variants(place), "|").alias("slugs"), rest.alias("rest"))
