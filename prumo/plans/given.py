"""Queries on texts made from columns of the given tables, with SQL that works out the answer from the columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from prumo.functions import extraction, rules, text, values
from prumo.operators import consensus, lookup
from prumo.plans.common import table
from prumo.sources import feeds, files, html

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLE_SQL[f.__name__] = f, sql
        return f

    return add


def _pick(n, *texts):
    """The text whose number n modulo their count gives."""
    return F.element_at(F.array(*(F.lit(t) if isinstance(t, str) else t for t in texts)), (n % len(texts)).cast("int") + 1)


# text


@query(r"""SELECT p_partkey, trim(regexp_replace(lower(p_type), '[^a-z0-9]+', ' ', 'g')) || ' no ' || p_partkey || ' acao ' || trim(regexp_replace(lower(p_brand), '[^a-z0-9]+', ' ', 'g')) AS key FROM part""")
def alnum_keys(spark, sf):
    """Letters and digits only, ordinals in their plain form, single spaces."""
    p = table(spark, sf, "part")
    written = F.concat(F.lit(" "), F.upper("p_type"), F.lit(" / Nº "), F.col("p_partkey").cast("string"), F.lit(" -- (Ação) "), "p_brand", F.lit("!"))
    return p.select("p_partkey", text.alnum_key(written).alias("key"))


@query("""SELECT s_suppkey, lower(s_name[1:8]) || s_suppkey || CASE s_suppkey % 4 WHEN 0 THEN '.mg.gov.br' WHEN 1 THEN '.sp.gov.br' WHEN 2 THEN '.zz.gov.br' ELSE '.com.br' END AS host,
CASE s_suppkey % 4 WHEN 0 THEN 'MG' WHEN 1 THEN 'SP' END AS state FROM supplier""")
def states_of_hosts(spark, sf):
    """Hosts with ports, paths and capitals; only those under a state's government name it."""
    s = table(spark, sf, "supplier")
    url = F.concat(F.lit("HTTPS://WWW."), F.left("s_name", F.lit(8)), F.col("s_suppkey").cast("string"), _pick(F.col("s_suppkey"), ".MG.gov.br:8080/x?y=.sp.gov.br", ".sp.gov.br/", ".zz.gov.br", ".com.br/mg.gov.br"))
    return s.select("s_suppkey", text.host(url).alias("host"), text.state_of_host(url).alias("state"))


@query("""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), f AS (SELECT doc_id, repeat('-', 100) || 'zzq' || doc_id || repeat('.', 400) || 'zzq' || repeat('+', 400) AS t FROM d)
SELECT doc_id, left(t, 100) || chr(10) || '[...]' || chr(10) || substring(t, 101 - 0, 3 + 60) || chr(10) || '[...]' || chr(10) || substring(t, strpos(substring(t, 104), 'zzq') + 103 - 20, 83) AS excerpt FROM f""")
def excerpts_of_documents(spark, sf):
    """A third of 300 characters from the start, then windows around two hits behind it."""
    d = table(spark, sf, "documents")
    made = F.concat(F.repeat(F.lit("-"), F.lit(100)), F.lit("zzq"), F.col("doc_id").cast("string"), F.repeat(F.lit("."), F.lit(400)), F.lit("zzq"), F.repeat(F.lit("+"), F.lit(400)))
    return d.select("doc_id", text.excerpt(made, "zzq", 300, 20, 60).alias("excerpt"))


@query("""SELECT c_custkey, 'Ação ' || c_name AS said, CASE WHEN c_custkey % 5 = 0 THEN 'pdf' WHEN c_custkey % 5 = 1 THEN 'zip' ELSE 'other' END AS kind FROM customer""")
def bytes_of_customers(spark, sf):
    """Bytes in UTF-8 or Latin-1, and files known by their first bytes."""
    c = table(spark, sf, "customer")
    said = F.concat(F.lit("Ação "), "c_name")
    content = F.when(F.col("c_custkey") % 2 == 0, F.encode(said, "ISO-8859-1")).otherwise(said.cast("binary"))
    head = F.concat(F.when(F.col("c_custkey") % 5 == 0, F.lit(b"%PDF-1.7")).when(F.col("c_custkey") % 5 == 1, F.lit(b"PK\x03\x04")).otherwise(F.lit(b"")), content)
    return c.select("c_custkey", files.decoded(content).alias("said"), files.kind_of(head).alias("kind"))


# rules

@query("""SELECT p_partkey, p_partkey % 12 IN (0, 1, 2, 3) AS physician, CASE WHEN p_partkey % 12 IN (4, 5, 6) THEN 'enfermagem' WHEN p_partkey % 12 = 8 THEN 'engenharia' WHEN p_partkey % 12 = 9 THEN 'ti' ELSE 'outra' END AS area,
p_partkey % 12 IN (0, 2, 4, 5, 7, 10, 11) AS health, p_size % 3 = 0 AS residency, p_size % 3 = 1 AS internal FROM part""")
def roles_of_parts(spark, sf):
    """Roles with their part's brand: physicians with and without the word, other professions with a physician's root, support roles, vets; areas;
    residencies and internal contests."""
    p = table(spark, sf, "part")
    role = _pick(
        F.col("p_partkey"), "Médico Clínico", "Cardiologista", "MÉDICA - Pediatria", "Psiquiatra", "Enfermeiro - Pediatria", "Técnica Enfermeira", "Técnico de Enfermagem", "Fisioterapeuta Geriátrico", "Engenheiro Civil",
        "Analista de TI", "Secretária Médica", "Médico Veterinário",
    )
    title = F.concat(role, F.lit(" "), "p_brand", _pick(F.col("p_size"), " - Residência", " (concurso INTERNO)", ""))
    folded, bare = text.fold_keep(title), text.fold_keep(role)
    return p.select("p_partkey", rules.physician(folded).alias("physician"), rules.area(folded).alias("area"), rules.health(bare).alias("health"), rules.residency(folded).alias("residency"), rules.internal_contest(folded).alias("internal"))


@query("""SELECT doc_id, doc_id % 8 IN (0, 6) AS candidate, doc_id % 3 = 0 AS quota FROM documents""")
def openings_in_documents(spark, sf):
    """Acts before documents: openings for physicians, and what is none by its category, title, phase or role; errors that say that a quota is used
    up."""
    d, k = table(spark, sf, "documents"), F.col("doc_id")
    gap = F.rpad(F.lit(""), 1300, " -")
    body = _pick(
        k, "Edital de abertura do processo seletivo. Vagas: Médico Clínico, 20 horas, R$ 9.000,00.", "Edital de abertura do processo seletivo. Vagas: Médico Clínico, 20 horas.", "Edital de abertura do concurso público. Médico, 2 vagas.",
        "Processo seletivo. Ficam convocados os candidatos: Médico, vaga 1.", "Inscrições abertas. Médico veterinário, 2 vagas.", "Inscrições abertas para professor, 20 horas. Exame médico.", "Concurso público, inscrições: pediatra, 1 vaga.", "Chamamento público. Médico, 1 vaga.",
    )
    title = _pick(k, "Edital 1/2026", "Edital 2/2026", "RESULTADO DO EDITAL", "Edital 4/2026", "Edital 5/2026", "Edital 6/2026", "Edital 7/2026", "Chamamento nº 3/2026 do Concurso")
    category = _pick(k, "Editais", "Licitações", "Editais", "", "", "", F.lit(None).cast("string"), "")
    said = text.fold_keep(F.concat(body, gap, F.coalesce("text", F.lit(""))))
    error = _pick(k, F.concat(F.lit("Error 429: "), F.left(F.coalesce("lang", F.lit("")), F.lit(2))), "timed out", "connection reset")
    return d.select("doc_id", F.coalesce(rules.opening_candidate(text.fold_keep(title), said, text.fold_keep(category)), F.lit(False)).alias("candidate"), rules.quota_error(error).alias("quota"))


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'incomplete' WHEN o_custkey % 3 = 0 THEN 'reversed' WHEN o_custkey % 3 = 1 THEN 'same day' ELSE 'in order' END AS label,
CASE WHEN CAST(o_orderdate AS DATE) + (CASE o_custkey % 3 WHEN 0 THEN -5 WHEN 1 THEN 0 ELSE 9 END)::INT >= DATE '1995-01-01' THEN CAST(o_orderdate AS DATE) + (CASE o_custkey % 3 WHEN 0 THEN -5 WHEN 1 THEN 0 ELSE 9 END)::INT - DATE '1995-01-01' END::INT AS left_days FROM orders""")
def reviews_of_orders(spark, sf):
    """What a reviewer gets: a record's fields with the label of its dates and the days left."""
    opens = F.to_date("o_orderdate")
    closes = F.date_add(opens, F.when(F.col("o_custkey") % 3 == 0, -5).when(F.col("o_custkey") % 3 == 1, 0).otherwise(9))
    rows = table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") != "F", opens).alias("opens"), closes.alias("closes"))
    return values.review_payload(rows, ["o_orderkey"], "opens", "closes", F.lit("1995-01-01").cast("date"))


# numbers and dates

_CENTS = "(round(o_totalprice * 100)::BIGINT)"


@query(f"""SELECT o_orderkey, CASE WHEN o_custkey % 4 = 3 THEN NULL ELSE ({_CENTS} / 100.0)::DECIMAL(12,2) END AS digits, CASE o_custkey % 4 WHEN 0 THEN o_custkey::INT WHEN 1 THEN 1 END AS n, o_custkey % 4 = 2 AS reserve FROM orders""")
def pay_of_orders(spark, sf):
    """Amounts whatever stands between their digits; counts with fractions, words for them, reserve lists."""
    o, k = table(spark, sf, "orders"), F.col("o_custkey")
    amount = F.format_number(F.col("o_totalprice"), 2)  # 1,234.56
    brl = F.translate(amount, ",.", ".,")
    written = _pick(k, F.concat(F.lit("R$ "), brl), amount, F.concat(F.lit("até "), F.translate(brl, ".", " "), F.lit(" mensais")), "a combinar")
    count = _pick(k, F.concat(k.cast("string"), F.lit(".9")), "true", "Cadastro de Reserva", "crescente")
    return o.select("o_orderkey", values.digits_brl(written).alias("digits"), values.parse_count(count).alias("n"), values.reserve_list(count).alias("reserve"))


@query("""WITH h AS (SELECT p_partkey, p_retailprice::DECIMAL(12,2) AS pay, p_size AS k, p_size % 5 AS kind FROM part), s AS (SELECT *, CASE kind WHEN 3 THEN 12 WHEN 4 THEN k + 0.5 ELSE k END AS hours FROM h)
SELECT p_partkey, CASE WHEN kind IN (0, 1) AND k > 0 THEN round((pay / (k * 52 / 12.0))::DECIMAL(18,6), 2)::DECIMAL(12,2) END AS strict, CASE WHEN kind <> 2 AND hours > 0 THEN round((pay / (hours * 52 / 12.0))::DECIMAL(18,6), 2)::DECIMAL(12,2) END AS shown FROM s""")
def hourly_of_parts(spark, sf):
    """Pay by the hour from written loads: strictly from plain weekly ones, for display from the first number with its decimals; pay by the shift has
    none."""
    p, k = table(spark, sf, "part"), F.col("p_size").cast("string")
    load = _pick(F.col("p_size"), F.concat(k, F.lit("h")), F.concat(F.lit(" "), k, F.lit(" horas semanais ")), F.concat(k, F.lit("h")), "12x36", F.concat(k, F.lit(",5h")))
    kind = F.when(F.col("p_size") % 5 == 2, "plantao").otherwise("mensal")
    pay = F.col("p_retailprice").cast("decimal(12,2)")
    return p.select("p_partkey", values.hourly_of(pay, kind, load).cast("decimal(12,2)").alias("strict"), values.hourly_shown(pay, kind, load).cast("decimal(12,2)").alias("shown"))


@query("""SELECT event_id, CASE WHEN event_id % 3 < 2 THEN date_trunc('minute', ts) END AS first, CASE WHEN event_id % 3 = 0 THEN date_trunc('minute', ts) + INTERVAL 3 DAY END AS last FROM events""")
def moments_of_events(spark, sf):
    """Two moments in a text, the second impossible or missing in some."""
    e, ts = table(spark, sf, "events"), F.col("ts").cast("timestamp")
    later = F.date_format(ts + F.expr("interval 3 days"), "dd/MM/yyyy 'às' HH:mm")
    written = _pick(F.col("event_id"), F.concat(F.lit("de "), F.date_format(ts, "dd/MM/yy HH:mm"), F.lit(" até "), later), F.concat(F.date_format(ts, "dd/MM/yyyy HH:mm"), F.lit(" a 31/02/24 10:00")), "a definir")
    first, last = values.moment_pair(written)
    return e.select("event_id", first.alias("first"), last.alias("last"))


@query("""SELECT o_orderkey, CASE WHEN o_custkey % 4 < 3 THEN CAST(o_orderdate AS DATE) END AS opens, CASE WHEN o_custkey % 4 < 3 THEN CAST(o_orderdate AS DATE) + 20 END AS closes FROM orders""")
def periods_of_orders(spark, sf):
    """Periods in figures, in words, and with the first year left out, across New Year too."""
    o, a = table(spark, sf, "orders"), F.to_date("o_orderdate")
    b = F.date_add(a, 20)
    month = lambda d: F.element_at(F.array(*map(F.lit, values.MONTHS)), F.month(d))
    words = lambda d: F.concat(F.dayofmonth(d).cast("string"), F.lit(" de "), month(d), F.lit(" de "), F.year(d).cast("string"))
    figures = lambda d, f="dd/MM/yyyy": F.date_format(d, f)
    written = _pick(F.col("o_custkey"), F.concat(F.lit("de "), figures(a), F.lit(" até "), figures(b)), F.concat(words(a), F.lit(" a "), words(b)), F.concat(figures(a, "dd/MM"), F.lit(" a "), figures(b)), "encerrado")
    opens, closes = values.period_any(written)
    return o.select("o_orderkey", opens.alias("opens"), closes.alias("closes"))


# replies and pages

_KIND = "o_custkey % 5"


def _replies(spark, sf):
    """Replies on orders in five shapes: a list, an object with a list, one object, a list as text, and one cut off."""
    o, k = table(spark, sf, "orders"), F.col("o_custkey") % 5
    item = F.concat(F.lit('{"cargo": "r'), F.col("o_orderkey").cast("string"), F.lit('", "salario": "'), F.col("o_totalprice").cast("decimal(12,2)").cast("string"), F.lit('"}'))
    reply = F.when(k == 0, F.concat(F.lit(" ["), item, F.lit(","), item, F.lit("]"))).when(k == 1, F.concat(F.lit('{"vagas": ['), item, F.lit("]}"))).when(k == 2, item).when(k == 3, F.to_json(F.struct(F.concat(F.lit("["), item, F.lit("]")).alias("vagas")))).otherwise(F.concat(F.lit('{"vagas": ['), item))
    return o.select("o_orderkey", "o_totalprice", reply.alias("reply"))


@query(f"""SELECT o_orderkey, CASE {_KIND} WHEN 0 THEN 2 WHEN 1 THEN 1 WHEN 2 THEN 1 WHEN 3 THEN 1 ELSE 0 END AS n, CASE WHEN {_KIND} < 4 THEN 'r' || o_orderkey END AS role, CASE WHEN {_KIND} < 4 THEN o_totalprice::DECIMAL(12,2) END AS pay FROM orders""")
def reply_lists(spark, sf):
    """Records of replies whatever their shape, as variants; one that isn't JSON has none."""
    got = extraction.records_of(F.col("reply"), "vagas")
    first = F.get(got, F.lit(0))
    return _replies(spark, sf).select("o_orderkey", F.coalesce(F.size(got), F.lit(0)).alias("n"), extraction.typed(first, "$.cargo", "string").alias("role"), extraction.typed(first, "$.salario", "decimal(12,2)").alias("pay"))


@query(f"""SELECT o_orderkey, CASE WHEN {_KIND} = 1 THEN 1 WHEN {_KIND} = 3 THEN 1 END AS n FROM orders""")
def reply_list_or_text(spark, sf):
    """A list that some replies hold as JSON and others as a text of JSON."""
    got = extraction.list_or_text(F.when(F.col("reply").startswith("{"), F.col("reply")), "vagas", "cargo string")
    return _replies(spark, sf).select("o_orderkey", F.when(F.size(got) > 0, F.size(got)).alias("n"))


@query("""SELECT o_orderkey, CASE WHEN o_custkey % 3 < 2 THEN (o_orderkey % 90 + 0.5)::DECIMAL(12,2) END AS taxa, CASE WHEN o_custkey % 3 = 0 THEN CAST(o_orderdate AS DATE) END AS prova, NULL::VARCHAR AS banca FROM orders""")
def gated_orders(spark, sf):
    """Only trusted replies count, only for what was asked, and an impossible date is dropped; 'banca' wasn't asked for."""
    o, k = table(spark, sf, "orders"), F.col("o_custkey")
    sure = _pick(k, "alta", "media", "baixa")
    date = F.when(k % 3 == 1, "2026-02-31").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    reply = F.to_json(F.struct(sure.alias("confianca"), (F.col("o_orderkey") % 90 + 0.5).cast("string").alias("taxa"), date.alias("prova"), F.lit("X").alias("banca")))
    got = extraction.accepted(reply, F.array(F.lit("taxa"), F.lit("prova")), {"taxa": "decimal(12,2)", "prova": "date", "banca": "string"})
    return o.select("o_orderkey", *(c.alias(n) for n, c in got.items()))


@query("""SELECT o_orderkey, CASE WHEN o_custkey % 4 = 3 THEN NULL WHEN o_custkey % 4 = 2 THEN NULL ELSE (o_custkey % 40)::INT END AS numero_vagas, CASE WHEN o_custkey % 4 < 3 THEN (o_orderkey % 100)::DECIMAL(12,2) END AS taxa_inscricao,
CASE WHEN o_custkey % 4 < 3 THEN '40h' END AS carga_horaria, CASE WHEN o_custkey % 4 < 3 AND o_totalprice > 0 THEN round((o_totalprice::DECIMAL(12,2) / (40 * 52 / 12.0))::DECIMAL(18,6), 2)::DECIMAL(12,2) END AS valor_hora,
CASE WHEN o_custkey % 4 = 0 THEN CAST(o_orderdate AS DATE) END AS data_prova, CASE WHEN o_custkey % 4 < 3 THEN o_orderstatus = 'F' END AS tem_prova FROM orders""")
def named_fields(spark, sf):
    """Fields of a record from a reply's notice and role: counts, amounts, dates, the value of an hour worked out; a broken reply gives none."""
    o, k = table(spark, sf, "orders"), F.col("o_custkey") % 4
    openings = F.when(k == 0, (F.col("o_custkey") % 40).cast("string")).when(k == 1, F.concat(F.lit('"'), (F.col("o_custkey") % 40).cast("string"), F.lit('"'))).otherwise('"CR"')
    role = F.concat(F.lit('{"cargo": "x", "vagas_qtd": '), openings, F.lit(', "carga_horaria": "40h", "salario_tipo": "mensal", "salario": '), F.col("o_totalprice").cast("decimal(12,2)").cast("string"), F.lit("}"))
    date = F.when(k == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("a definir")
    notice = F.concat(F.lit('{"taxa_inscricao": '), (F.col("o_orderkey") % 100).cast("string"), F.lit(', "tem_prova": '), (F.col("o_orderstatus") == "F").cast("string"), F.lit(', "data_prova": "'), date, F.lit('", "vagas": ['), role, F.lit("]}"))
    reply = F.when(k == 3, F.concat(F.lit("sorry "), notice)).otherwise(notice)
    got = extraction.vacancy_fields(reply)
    return o.select("o_orderkey", *(got[n].alias(n) for n in ("numero_vagas", "taxa_inscricao", "carga_horaria", "valor_hora", "data_prova", "tem_prova")))


@query("""SELECT p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS record, p_name AS title, CASE WHEN p_size % 3 > 0 THEN p_size::VARCHAR END AS number FROM part""")
def html_groups_of_brands(spark, sf):
    """Records of a brand's page by position: each begins with its title, some lack a number."""
    number = F.when(F.col("p_size") % 3 > 0, F.concat(F.lit("<span class=number> "), F.col("p_size").cast("string"), F.lit("</span>"))).otherwise("")
    one = F.struct("p_partkey", F.concat(F.lit("<div class='title'><b>"), "p_name", F.lit("</b></div>"), number).alias("x"))
    pages = table(spark, sf, "part").groupBy("p_brand").agg(F.array_join(F.transform(F.array_sort(F.collect_list(one)), lambda e: e["x"]), "").alias("page"))
    return html.groups(pages, "p_brand", "page", ["title", "number"]).withColumn("record", F.col("record").cast("long"))


@query("""SELECT o_custkey, row_number() OVER (PARTITION BY o_custkey, o_custkey % 2 ORDER BY o_orderkey) - 1 AS ordinal, 'o' || o_orderkey AS title, CASE WHEN o_custkey % 2 = 1 OR o_orderkey % 3 < 2 THEN o_orderdate END AS published FROM orders""")
def feed_times_of_orders(spark, sf):
    """RSS and Atom feeds of customers; times with zone names, offsets, in ISO form, or unreadable."""
    o, ts = table(spark, sf, "orders"), F.col("o_orderdate").cast("timestamp")
    key = F.col("o_orderkey")
    west = F.concat(F.date_format(ts - F.expr("interval 3 hours"), "d MMM yyyy HH:mm:ss"), F.lit(" -0300"))
    rfc = _pick(key, F.concat(F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT")), west, "soon")
    item = F.concat(F.lit("<item><title>o"), key.cast("string"), F.lit("</title><link>l</link><pubDate>"), rfc, F.lit("</pubDate></item>"))
    entry = F.concat(F.lit("<entry><title>o"), key.cast("string"), F.lit('</title><link href="l"/><updated>'), F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit("</updated></entry>"))
    body = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", c.alias("x")))), lambda e: e["x"]), "")
    by = o.groupBy("o_custkey").agg(body(item).alias("items"), body(entry).alias("entries"))
    rss = by.filter("o_custkey % 2 = 0").withColumn("xml", F.concat(F.lit("<rss><channel>"), "items", F.lit("</channel></rss>")))
    atom = by.filter("o_custkey % 2 = 1").withColumn("xml", F.concat(F.lit("<feed>"), "entries", F.lit("</feed>")))
    both = feeds.rss_items(rss, "o_custkey", "xml").unionByName(feeds.atom_entries(atom, "o_custkey", "xml"))
    return both.select("o_custkey", F.col("ordinal").cast("long").alias("ordinal"), "title", feeds.published(F.col("published")).cast("timestamp_ntz").alias("published"))


# groups and anti joins


@query("""WITH g AS (SELECT *, regexp_replace(o_orderpriority, '-.*$', '') AS base, count(*) OVER (PARTITION BY o_custkey, regexp_replace(o_orderpriority, '-.*$', '')) AS n, first_value(o_totalprice) OVER (PARTITION BY o_custkey, regexp_replace(o_orderpriority, '-.*$', '') ORDER BY o_orderkey) AS price FROM orders)
SELECT o_orderkey, CASE WHEN price > 200000 THEN 'rejected' ELSE 'approved' END AS verdict FROM g WHERE n >= 2""")
def verdicts_of_orders(spark, sf):
    """What is decided on the first order of a customer and base priority holds for all of them."""
    o = table(spark, sf, "orders").withColumn("base", F.regexp_replace("o_orderpriority", "-.*$", ""))
    verdict = F.when(F.col("o_totalprice") > 200000, "rejected").otherwise("approved")
    return consensus.verdict_for_all(o, ["o_custkey", "base"], [F.col("o_orderkey")], verdict, "verdict").select("o_orderkey", "verdict")


@query("""SELECT c_custkey FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders JOIN customer d ON o_custkey = d.c_custkey WHERE o_totalprice > 498000 AND (c.c_custkey = d.c_custkey OR c.c_nationkey = d.c_nationkey AND lower(c.c_mktsegment) = lower(d.c_mktsegment)))""")
def without_large_orders(spark, sf):
    """Customers without a large order of their own or of one of the same nation and segment."""
    c, o = table(spark, sf, "customer"), table(spark, sf, "orders").filter("o_totalprice > 498000")
    large = o.join(c, F.col("o_custkey") == F.col("c_custkey"))
    left = c.withColumn("segment", F.lower("c_mktsegment"))
    return lookup.without_any(left, large, [[("c_custkey", F.col("o_custkey"))], [("c_nationkey", F.col("c_nationkey")), ("segment", F.lower("c_mktsegment"))]]).select("c_custkey")


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def csv_dimension(spark, sf):
    """A dimension written as CSV with a header and read back with its schema."""
    from prumo.shared import shared_folder

    path = shared_folder(spark, "csv")
    table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey").write.option("header", True).csv(path)
    return files.dimension(spark, path, "n_nationkey int, n_name string, n_regionkey int")
