"""Queries on text, HTML, numbers, dates, rules and entity resolution."""

from __future__ import annotations

from pyspark.sql import functions as F

from prumo.functions import rules, text, values
from prumo.operators import lookup, resolve
from prumo.plans.common import table
from prumo.sources import html

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


_FOLD_A = r"trim(regexp_replace(translate(strip_accents(lower({0})), 'ºª', 'oa'), '[^\x00-\x7F]', '', 'g'))"
_SLUG = "regexp_replace(regexp_replace({0}, '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')"


@query(r"SELECT doc_id, md5(trim(regexp_replace(strip_accents(lower(text)), '\s+', ' ', 'g'))) AS folded FROM documents")
def fold_b_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(text.fold_keep(F.col("text"))).alias("folded"))


@query("SELECT doc_id, md5(" + _FOLD_A.format("text") + ") AS folded FROM documents")
def fold_a_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(text.fold_ascii(F.col("text"))).alias("folded"))


@query(r"SELECT p_partkey, regexp_replace(regexp_replace(lower(replace(p_name, ' ', ' / ')) || ' ' || lower(p_brand), '\s*/\s*', '/', 'g'), '\s+', ' ', 'g') AS k FROM part")
def dedup_key(spark, sf):
    raw = F.concat(F.replace("p_name", F.lit(" "), F.lit(" / ")), F.lit(" "), F.col("p_brand"))
    return table(spark, sf, "part").select("p_partkey", text.dedup_key(raw).alias("k"))


@query("SELECT page_id, substring(" + _SLUG.format(_FOLD_A.format("regexp_extract(html, '<title>(.*?)</title>', 1, 's')")) + ", 1, 60) AS slug FROM pages")
def slug_title(spark, sf):
    return table(spark, sf, "pages").select("page_id", text.slug(html.title(F.col("html")), 60).alias("slug"))


@query(r"SELECT page_id, regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1)), '^www\.', '') AS host, regexp_extract(url, '^[a-z]+://[^/]+/([a-z]{2})/', 1) AS segment FROM pages")
def url_host(spark, sf):
    return table(spark, sf, "pages").select("page_id", text.host(F.col("url")).alias("host"), F.regexp_extract("url", "^[a-z]+://[^/]+/([a-z]{2})/", 1).alias("segment"))


@query("""WITH f AS (SELECT page_id, regexp_extract_all(html, 'href="([^"]+)"', 1) AS l FROM pages), u AS (SELECT page_id, unnest(l) AS href, generate_subscripts(l, 1) AS p FROM f),
d AS (SELECT page_id, href, min(p) AS p FROM u GROUP BY ALL) SELECT page_id, href, row_number() OVER (PARTITION BY page_id ORDER BY p) - 1 AS ordinal FROM d""")
def html_links(spark, sf):
    return html.links(table(spark, sf, "pages"), "page_id", "html").withColumn("ordinal", F.col("ordinal").cast("long"))


_CUT = "|".join(rf"<{t}\b.*?</{t}>" for t in ("head", "script", "style", "nav", "header", "footer"))
_BODY = rf"regexp_replace(regexp_replace(regexp_replace(html, '{_CUT}', ' ', 'gs'), '<!--.*?-->', ' ', 'gs'), '<[^>]*>', ' ', 'g')"


@query(rf"""SELECT page_id, md5(trim(regexp_replace(replace(replace(replace(replace(replace({_BODY}, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&nbsp;', ' '), '&amp;', '&'), '\s+', ' ', 'g'))) AS body FROM pages""")
def html_text(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.md5(html.article_text(F.col("html"))).alias("body"))


@query(f"""SELECT page_id FROM pages WHERE {' OR '.join(f"contains(lower(html), '{m}')" for m in rules.BLOCK_MARKERS)} OR (page_id % 5 = 0 AND length(html) < 4000)""")
def block_markers(spark, sf):
    status = F.when(F.col("page_id") % 5 == 0, 403).otherwise(200)
    return table(spark, sf, "pages").filter(rules.blocked(F.col("html"), status, 4000)).select("page_id")


_ROLES = ("Médico Pediatra", "Médico Veterinário", "Enfermeiro", "Analista de Sistemas", "Engenheiro Civil", "Secretária Médica", "Fisioterapeuta Geriátrico", "Estagiário - Medicina", "Psiquiatra", "Professor de Enfermagem", "Cirurgião Geral", "Motorista")


@query("""SELECT o_orderkey, o_orderkey % 12 IN (0, 8, 10) AS physician, ['outra', 'outra', 'enfermagem', 'ti', 'engenharia', 'outra', 'outra', 'outra', 'outra', 'outra', 'outra', 'outra'][o_orderkey % 12 + 1] AS area FROM orders""")
def classify_rules(spark, sf):
    role = F.element_at(F.array(*map(F.lit, _ROLES)), (F.col("o_orderkey") % len(_ROLES) + 1).cast("int"))
    folded = text.fold_keep(role)
    return table(spark, sf, "orders").select("o_orderkey", rules.physician(folded).alias("physician"), rules.area(folded).alias("area"))


_NOTICE = "CASE l_linenumber WHEN 1 THEN 'Edital de Concurso Público' WHEN 2 THEN 'Edital - Processo Seletivo' WHEN 3 THEN 'Retificação do Edital' WHEN 4 THEN 'Edital de Credenciamento' ELSE 'Convocação' END"


@query(f"""WITH r AS (SELECT l_orderkey, l_linenumber, strip_accents(lower({_NOTICE})) AS f FROM lineitem)
SELECT l_orderkey, l_linenumber, contains(f, 'edital') AND NOT regexp_matches(f, 'retifica|resultado|convoca|homolog|gabarito') AS opening,
  CASE WHEN contains(f, 'seletivo') THEN 'processo_seletivo_temporario' WHEN contains(f, 'credenciamento') THEN 'credenciamento' WHEN contains(f, 'concurso') THEN 'concurso_efetivo' ELSE 'outro' END AS opportunity FROM r""")
def opening_notices(spark, sf):
    n = F.col("l_linenumber")
    folded = text.fold_keep(F.when(n == 1, "Edital de Concurso Público").when(n == 2, "Edital - Processo Seletivo").when(n == 3, "Retificação do Edital").when(n == 4, "Edital de Credenciamento").otherwise("Convocação"))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", rules.opening_notice(folded).alias("opening"), rules.opportunity(folded).alias("opportunity"))


@query("""SELECT o_orderkey, 'R$ ' || translate(format('{:,.2f}', o_totalprice), ',.', '.,') AS shown, o_totalprice::DECIMAL(12,2) AS parsed FROM orders""")
def money_parse(spark, sf):
    shown = values.brl(F.col("o_totalprice"))
    return table(spark, sf, "orders").select("o_orderkey", shown.alias("shown"), values.parse_brl(shown).alias("parsed"))


@query("""SELECT o_orderkey, CAST(o_orderdate AS DATE) AS br, CAST(o_orderdate AS DATE) AS words, CAST(o_orderdate AS DATE) AS iso, CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS broken FROM orders""")
def date_parse(spark, sf):
    d = F.col("o_orderdate")
    month = F.element_at(F.array(*map(F.lit, values.MONTHS)), F.month(d))
    words = F.concat_ws(" de ", F.dayofmonth(d).cast("string"), month, F.year(d).cast("string"))
    broken = F.when(F.col("o_orderkey") % 2 == 0, F.lit("31/02/2020")).otherwise(F.date_format(d, "dd/MM/yyyy"))
    return table(spark, sf, "orders").select("o_orderkey", values.date_br(F.date_format(d, "dd/MM/yyyy")).alias("br"), values.date_words(words).alias("words"), values.date_iso(d.cast("string")).alias("iso"), values.date_br(broken).alias("broken"))


@query("""WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS b, CAST(o_orderdate AS DATE) + 40 AS e FROM orders) SELECT o_orderkey, b AS period_begin, e AS period_end FROM o""")
def period_parse(spark, sf):
    """Periods without a first year, some of them across New Year."""
    b = F.to_date("o_orderdate")
    begin, end = values.period(F.concat(F.lit("de "), F.date_format(b, "dd/MM"), F.lit(" a "), F.date_format(F.date_add(b, 40), "dd/MM/yyyy")))
    return table(spark, sf, "orders").select("o_orderkey", begin.alias("period_begin"), end.alias("period_end"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_quantity > 10 THEN round(CAST(l_extendedprice / (l_quantity * 52 / 12) AS DECIMAL(18,6)), 2)::DOUBLE END AS hourly FROM lineitem")
def hourly_value(spark, sf):
    hours = F.when(F.col("l_quantity") > 10, F.col("l_quantity"))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", values.hourly(F.col("l_extendedprice"), hours).cast("double").alias("hourly"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag = 'N' OR o_orderdate IS NULL THEN 'incomplete' WHEN l_shipdate < o_orderdate THEN 'reversed' WHEN l_shipdate = o_orderdate THEN 'same day' ELSE 'in order' END AS label
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey""")
def chronology_label(spark, sf):
    rows = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", values.chronology(F.col("o_orderdate"), F.when(F.col("l_returnflag") != "N", F.col("l_shipdate"))).alias("label"))


@query("""SELECT o_orderkey, CASE WHEN e < DATE '1998-06-15' THEN 'encerrada' WHEN b > DATE '1998-06-15' THEN 'futura' ELSE 'aberta' END AS status,
  CASE WHEN e < DATE '1998-06-15' THEN 'closed' WHEN e - DATE '1998-06-15' = 0 THEN 'last day' WHEN e - DATE '1998-06-15' = 1 THEN 'one day' WHEN e - DATE '1998-06-15' <= 3 THEN 'few days' ELSE 'open' END AS badge
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS b, CAST(o_orderdate AS DATE) + 30 AS e FROM orders)""")
def lifecycle_badge(spark, sf):
    today, b = F.lit("1998-06-15").cast("date"), F.to_date("o_orderdate")
    e = F.date_add(b, 30)
    return table(spark, sf, "orders").select("o_orderkey", values.lifecycle(b, e, today).alias("status"), values.badge(e, today).alias("badge"))


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k, CASE WHEN CAST(json_extract_string(props, '$.k') AS INT) >= 50 THEN value END AS gated FROM events""")
def json_props(spark, sf):
    k = values.json_int(F.col("props"), "$.k")
    return table(spark, sf, "events").select("event_id", k.alias("k"), F.when(k >= 50, F.col("value")).alias("gated"))


@query("""SELECT o_orderkey, concat_ws(',', CASE WHEN o_orderstatus = 'F' THEN 'status' END, CASE WHEN o_orderpriority = '1-URGENT' THEN 'priority' END, CASE WHEN o_totalprice < 100000 THEN 'price' END) AS missing FROM orders""")
def missing_fields(spark, sf):
    names = lookup.missing_names(status=F.nullif("o_orderstatus", F.lit("F")), priority=F.nullif("o_orderpriority", F.lit("1-URGENT")), price=F.when(F.col("o_totalprice") >= 100000, F.col("o_totalprice")))
    return table(spark, sf, "orders").select("o_orderkey", names.alias("missing"))


_WORDS = r"list_filter(string_split_regex(lower({0}), '\s+'), lambda w: w <> '')"


@query(f"""WITH b AS (SELECT {_WORDS.format('text')} AS w FROM benchmark), n AS (SELECT DISTINCT unnest([array_to_string(w[1:2], ' '), array_to_string(w[1:3], ' ')]) AS name FROM b),
d AS (SELECT doc_id, {_WORDS.format('text')} AS w FROM documents),
g AS (SELECT doc_id, unnest(range(1, len(w))) AS place, 2 AS k, w FROM d UNION ALL SELECT doc_id, unnest(range(1, len(w) - 1)), 3, w FROM d),
h AS (SELECT doc_id, place, array_to_string(w[place:place + k - 1], ' ') AS name FROM g), m AS (SELECT h.* FROM h JOIN n ON h.name = n.name)
SELECT doc_id, arg_min(name, row(-length(name), place, name)) AS name, arg_min(place, row(-length(name), place, name)) AS place FROM m GROUP BY doc_id""")
def resolve_longest(spark, sf):
    w = F.filter(F.split(F.lower("text"), r"\s+"), lambda x: x != "")
    names = table(spark, sf, "benchmark").select(F.explode(F.array(F.array_join(F.slice(w, 1, 2), " "), F.array_join(F.slice(w, 1, 3), " "))).alias("name"))
    out = resolve.longest_name(table(spark, sf, "documents"), "doc_id", F.lower("text"), names, "name", [2, 3])
    return out.withColumn("place", F.col("place").cast("long"))


@query(f"""WITH b AS (SELECT item_id, {_WORDS.format('text')} AS w FROM benchmark),
t AS (SELECT item_id, 0 AS rank, 'name' AS kind, array_to_string(w[1:5], ' ') AS term FROM b UNION ALL SELECT item_id, 1, 'topic', array_to_string(w[1:2], ' ') FROM b),
d AS (SELECT doc_id, {_WORDS.format('text')} AS w FROM documents),
g AS (SELECT doc_id, unnest(range(1, len(w))) AS place, 2 AS k, w FROM d UNION ALL SELECT doc_id, unnest(range(1, len(w) - 3)), 5, w FROM d),
h AS (SELECT doc_id, item_id, rank, kind, place FROM (SELECT doc_id, place, array_to_string(w[place:place + k - 1], ' ') AS term FROM g) JOIN t USING (term))
SELECT doc_id, item_id, arg_min(kind, row(rank, place)) AS kind, arg_min(place, row(rank, place)) AS place FROM h GROUP BY ALL""")
def watchlist_join(spark, sf):
    w = F.filter(F.split(F.lower("text"), r"\s+"), lambda x: x != "")
    watch = table(spark, sf, "benchmark").select("item_id", F.array_join(F.slice(w, 1, 5), " ").alias("name"), F.array_join(F.slice(w, 1, 2), " ").alias("topic"))
    out = resolve.watchlist(table(spark, sf, "documents"), "doc_id", F.lower("text"), watch, "item_id", "name", "topic", 5, 2)
    return out.withColumn("place", F.col("place").cast("long"))


@query("""SELECT s_suppkey, CASE WHEN n_code.n_nationkey IS NOT NULL THEN n_code.v ELSE n_name.v END AS v FROM supplier
LEFT JOIN (SELECT n_nationkey, nullif(n_regionkey, 2) AS v FROM nation WHERE n_regionkey <> 1) n_code ON s_nationkey = n_code.n_nationkey
LEFT JOIN (SELECT n_name, arg_min(nullif(n_regionkey, 2), n_nationkey) AS v FROM nation WHERE n_regionkey <> 1 AND nullif(n_regionkey, 2) IS NOT NULL GROUP BY ALL) n_name ON 'NATION_' || (s_nationkey + 1) = n_name.n_name""")
def code_then_name(spark, sf):
    right = table(spark, sf, "nation").filter("n_regionkey <> 1").select(F.col("n_nationkey").alias("code"), F.col("n_name").alias("label"), F.nullif("n_regionkey", F.lit(2)).alias("v"))
    left = table(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").alias("code"), F.concat(F.lit("NATION_"), F.col("s_nationkey") + 1).alias("label"))
    return resolve.code_then_name(left, right, "code", "label", "v").select("s_suppkey", "v")


@query("""SELECT doc_id, CASE WHEN instr(text, 'the') > 0 THEN substring(text, greatest(instr(text, 'the') - 20, 1), instr(text, 'the') + 23 - greatest(instr(text, 'the') - 20, 1)) END AS kwic FROM documents""")
def kwic(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.snippet(F.col("text"), "the", 20).alias("kwic"))


@query("""SELECT doc_id, round(CASE WHEN length(regexp_replace(text, '[^A-Za-z]', '', 'g')) > 0 THEN length(regexp_replace(text, '[^A-Z]', '', 'g'))::DOUBLE / length(regexp_replace(text, '[^A-Za-z]', '', 'g')) ELSE 0 END, 4) >= 0.6 AS shouting FROM documents""")
def upper_ratio(spark, sf):
    return table(spark, sf, "documents").select("doc_id", (F.round(text.upper_share(F.col("text")), 4) >= 0.6).alias("shouting"))


@query("""WITH w AS (SELECT p_partkey, string_split(p_name || ' ' || lower(p_type) || ' de ' || lower(p_brand), ' ') AS w FROM part)
SELECT p_partkey, array_to_string([array_to_string(w[-n:], ' ') FOR n IN range(4, 0, -1)], '|') AS candidates, array_to_string([CASE WHEN x = 'de' THEN x ELSE upper(x[1:1]) || x[2:] END FOR x IN w], ' ') AS titled FROM w""")
def suffix_candidates(spark, sf):
    raw = F.concat(F.col("p_name"), F.lit(" "), F.lower("p_type"), F.lit(" de "), F.lower("p_brand"))
    return table(spark, sf, "part").select("p_partkey", F.array_join(text.suffixes(raw), "|").alias("candidates"), text.title_pt(raw).alias("titled"))


@query("""SELECT l_orderkey, CASE WHEN count(DISTINCT l_tax) = 1 THEN min(l_tax) END AS uniform_tax, CASE WHEN count(*) FILTER (WHERE l_returnflag = 'R') = 1 THEN min(l_partkey) FILTER (WHERE l_returnflag = 'R') END AS only_returned FROM lineitem GROUP BY ALL""")
def uniform_values(spark, sf):
    """A value that all rows share, and a match that is the only one; else null."""
    returned = F.when(F.col("l_returnflag") == "R", F.col("l_partkey"))
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.when(F.count_distinct("l_tax") == 1, F.min("l_tax")).alias("uniform_tax"), F.when(F.count(returned) == 1, F.min(returned)).alias("only_returned"))
