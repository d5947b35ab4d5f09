"""Queries of the call monitor and of phrase search on acts made from documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from prumo.operators import monitor, phrases, resolve
from prumo.plans.common import table
from prumo.shared import spread

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLE_SQL[f.__name__] = f, sql
        return f

    return add


def _letters(number):
    """Digits as letters, so that names have none."""
    return F.translate(number.cast("string"), "0123456789", "abcdefghij")


_LETTERS = "translate({}::VARCHAR, '0123456789', 'abcdefghij')"
_NAME = f"'Zulmira Xk' || {_LETTERS.format('doc_id')} || ' de Paiva'"


def _named(spark, sf):
    """Documents behind an act that has the document's own name doc_id % 4 + 1 times, close together or 5,000 characters apart."""
    d = table(spark, sf, "documents")
    name = F.concat(F.lit("Zulmira Xk"), _letters(F.col("doc_id")), F.lit(" de Paiva"))
    step = F.when(F.col("doc_id") % 2 == 0, 100).otherwise(5000)
    copy = lambda j: F.rpad(F.concat(F.when(j % 2 == 1, "Convoca a ").otherwise("Elogios a "), name, F.lit(";")), step, " -")
    act = F.array_join(F.transform(F.sequence(F.lit(0), (F.col("doc_id") % 4).cast("int")), copy), "")
    pubs = d.select(F.col("doc_id").alias("key"), F.lit("Ato").alias("title"), F.concat(act, F.rpad(F.lit(""), 2000, " -"), F.coalesce("text", F.lit(""))).alias("text"), (F.col("doc_id") % 3 == 0).alias("statewide"))
    watch = d.select(F.col("doc_id").alias("watch"), name.alias("name"), F.lit(None).cast("int").alias("rank"))
    return pubs, watch


_PLACES = f"""WITH d AS (SELECT DISTINCT doc_id, length({_NAME}) AS len, CASE WHEN doc_id % 2 = 0 THEN 100 ELSE 5000 END AS step FROM documents),
p AS (SELECT doc_id, j, j * step + 10 AS pos, len FROM d, range(4) r(j) WHERE j <= doc_id % 4),
c AS (SELECT a.doc_id, a.pos, a.len, coalesce(bool_or(b.j % 2 = 1 AND b.pos - 10 >= a.pos - 500 AND b.pos - 4 <= a.pos + 400), false) AND a.doc_id % 3 <> 0 AS called FROM p a JOIN p b ON a.doc_id = b.doc_id GROUP BY a.doc_id, a.pos, a.len)
"""


@query(_PLACES + """, s AS (SELECT *, greatest(pos - 2500, 0) AS lo, pos + 1500 AS hi, CASE WHEN greatest(pos - 2500, 0) <= max(pos + 1500) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM c),
w AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM s)
SELECT doc_id AS key, doc_id AS watch, min(lo)::INT AS lo, max(hi)::INT AS hi, count(*) AS places, (min(pos) FILTER (WHERE called))::INT AS place FROM w GROUP BY doc_id, run""")
def name_windows_in_documents(spark, sf):
    """What to read around the names of acts: stretches around each place, overlapping ones as one. Statewide gazettes (each third)
    want a contest's sign nearby, which these acts lack."""
    return monitor.name_windows(*_named(spark, sf)).drop("confidence")


@query(_PLACES + "SELECT doc_id AS key, doc_id AS watch, min(pos) AS place FROM c WHERE called GROUP BY ALL")
def called_in_documents(spark, sf):
    """The first place of each name that stands in a call; some only have later ones."""
    return monitor.watched_names(*_named(spark, sf)).drop("confidence")


_ACTS = """WITH p AS (SELECT DISTINCT doc_id, doc_id % 25 AS town, doc_id % 7 AS kind FROM documents)
"""


def _acts(spark, sf):
    """Documents with acts of towns (Nação 0 to 24): by doc_id % 7 what contest they cite."""
    k, town = F.col("doc_id") % 7, (F.col("doc_id") % 25).cast("string")
    entity = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("Fundo Municipal de Saúde de Nação "), town)).otherwise(F.concat(F.lit("NAÇAO  "), town, F.lit(" - Câmara")))
    cited = F.when(k == 0, F.concat(F.lit("Concurso nº 00"), town, F.lit("/2023"))).when(k == 1, F.concat(F.lit("edital "), town, F.lit("/23."))).when(k == 2, F.concat(F.lit("edital 9"), town, F.lit("/2023"))).when(k == 3, F.concat(F.lit("Seleção Única  de "), F.lit("nação "), town)).when(k == 4, "Exame médico").otherwise("")
    body = F.concat(cited, F.lit("; cargo: "), F.when(k == 6, "Médico Pediatra").otherwise("Motorista"), F.lit(" "), F.rpad(F.lit(""), 100, " -"), F.coalesce("text", F.lit("")))
    title = F.when(F.col("doc_id") % 5 == 0, "EXONERAÇÃO e convocação").otherwise("Edital de Convocação")
    return table(spark, sf, "documents").select(F.col("doc_id").alias("key"), F.lit("MG").alias("state"), entity.alias("entity"), title.alias("title"), body.alias("text"))


def _towns(spark, sf):
    """Entries of nations: numbered, with words for a number, and without; those of region 3 are of another state."""
    n, k = table(spark, sf, "nation"), F.col("n_nationkey") % 3
    town = F.col("n_nationkey").cast("string")
    number = F.when(k == 0, F.concat(town, F.lit("/2023"))).when(k == 1, F.concat(F.lit("SELEÇÃO ÚNICA DE NAÇÃO "), town))
    role = F.when(k == 2, "Médico Pediatra").otherwise("Motorista")
    return n.select(F.col("n_nationkey").cast("long").alias("watch"), F.when(F.col("n_regionkey") == 3, "SP").otherwise("MG").alias("state"), F.concat(F.lit("Nação "), town).alias("city"), number.alias("number"), role.alias("role"))


@query(_ACTS + """SELECT doc_id AS key, n_nationkey::BIGINT AS watch FROM p JOIN nation ON town = n_nationkey WHERE n_regionkey <> 3 AND doc_id % 5 <> 0
AND CASE n_nationkey % 3 WHEN 0 THEN kind IN (0, 1) AND kind <> 6 WHEN 1 THEN kind = 3 ELSE kind = 6 END""")
def contests_in_documents(spark, sf):
    """Calls of watched contests: towns inside the names of entities, numbers in their forms, contests that have words only."""
    return monitor.watched_contests(_acts(spark, sf), _towns(spark, sf))


@query(_ACTS + """SELECT doc_id AS key, n_nationkey::BIGINT AS watch FROM p JOIN nation ON town = n_nationkey WHERE n_regionkey <> 3
AND CASE n_nationkey % 3 WHEN 0 THEN kind IN (0, 1) WHEN 1 THEN kind = 3 ELSE kind = 6 END""")
def targets_of_documents(spark, sf):
    """The contest that an act is about: a cited number, its words, or a medical role where there is no number."""
    return resolve.target_contest(_acts(spark, sf), "key", "state", "entity", "text", _towns(spark, sf), "watch", "city", "number", "role")


@query("""SELECT doc_id AS key, CASE doc_id % 8 WHEN 1 THEN 'nomeacao' ELSE 'convocacao' END AS kind,
CASE doc_id % 8 WHEN 0 THEN 'Concurso Publico ' || doc_id % 1000 || '/2024' WHEN 1 THEN 'Processo Seletivo ' || doc_id % 1000 || '/24' END AS contest FROM documents WHERE doc_id % 8 IN (0, 1, 7)""")
def physician_calls_in_documents(spark, sf):
    """Acts before documents: calls and appointments with a contest, and what is none (no contest, a vet, a service, a meeting, no
    physician)."""
    n, k = (F.col("doc_id") % 1000).cast("string"), F.col("doc_id") % 8
    act = (
        F.when(k == 0, F.concat(F.lit("O Prefeito CONVOCA os aprovados no  Concurso Público nº 0"), n, F.lit("/2024 para Médico Clínico.")))
        .when(k == 1, F.concat(F.lit("Nomeia a médica classificada no Processo Seletivo "), n, F.lit("/24.")))
        .when(k == 2, "Nomeia o candidato para cargo em comissão de médico.")
        .when(k == 3, "Convoca candidatos aprovados: Médico Veterinário.")
        .when(k == 4, "Chamamento público para credenciamento de candidatos médicos.")
        .when(k == 5, "Convoca para a audiência pública os candidatos e o médico.")
        .when(k == 6, "Convoca os professores aprovados.")
        .otherwise(F.concat(F.lit("Convoca para reunião os médicos."), F.rpad(F.lit(""), 1200, " -"), F.lit("Convocação de candidatos: Pediatra e Médico Veterinário.")))
    )
    text = F.concat(act, F.rpad(F.lit(""), 1200, " -"), F.coalesce("text", F.lit("")))
    return monitor.physician_calls(table(spark, sf, "documents").select(F.col("doc_id").alias("key"), text.alias("text"))).select("key", "kind", "contest")


@query(f"""WITH c AS (SELECT c_custkey, {_LETTERS.format("c_custkey")} AS x FROM customer)
SELECT c_custkey AS key, 'Maria Xk' || x || ' da Silva' AS name, (c_custkey % 500 + 1)::INT AS rank, CASE WHEN c_custkey % 2 = 0 THEN '***.123.456-**' END AS cpf FROM c
UNION ALL SELECT c_custkey, 'Ana Yz' || x || ' Souza', NULL, NULL FROM c WHERE c_custkey % 3 <> 0""")
def people_of_customers(spark, sf):
    """Lists of persons: one in capitals by rank, with a masked number or without; one behind a label, unless dropped; a mayor who signs; a
    name twice."""
    x, key = _letters(F.col("c_custkey")), F.col("c_custkey")
    rank = (key % 500 + 1).cast("string")
    first = F.concat(rank, F.lit("º MARIA XK"), F.upper(x), F.lit(" DA SILVA"), F.when(key % 2 == 0, " CPF ***.123.456-**").otherwise(""), F.lit("\\n"))
    first = F.replace(first, F.lit("\\n"), F.lit("\n"))
    second = F.concat(F.lit("Candidata: Ana Yz"), x, F.lit(" Souza"), F.when(key % 3 == 0, " - desistente").otherwise(", cargo Médico"))
    text = F.concat(first, second, F.lit("\nLuz, nome: Carlos Alberto Nunes, Prefeito Municipal\n"), F.when(key % 5 == 0, first).otherwise(""))
    return monitor.listed_people(spread(table(spark, sf, "customer").select("c_custkey"), "c_custkey").select(F.col("c_custkey").alias("key"), text.alias("text")))


_WORDS = r"list_filter(string_split_regex(lower({}), '[\x20\x09-\x0D]+'), lambda w: w <> '')"


@query(rf"""WITH d AS (SELECT doc_id, ' ' || array_to_string({_WORDS.format("text")}, ' ') || ' ' AS t FROM documents),
b AS (SELECT item_id, k, ' ' || array_to_string(list_slice({_WORDS.format("text")}, 1 + k, 4 + k), ' ') || ' ' AS p FROM benchmark, range(3) r(k)),
h AS (SELECT item_id, k, count(DISTINCT doc_id) AS n, min(doc_id) AS one FROM b JOIN d ON contains(t, p) AND trim(p) <> '' GROUP BY ALL)
SELECT item_id * 3 + k AS phrase, CASE WHEN n = 1 THEN one END AS doc_id, coalesce(n, 0) AS texts FROM b LEFT JOIN h USING (item_id, k)""")
def phrases_in_documents(spark, sf):
    """Runs of four words of benchmark items in documents: the one document that has a run, null where none or several do."""
    b = table(spark, sf, "benchmark").withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(2))))
    runs = b.select((F.col("item_id") * 3 + F.col("_k")).alias("phrase"), F.slice(phrases.plain_words(F.col("text")), F.col("_k") + 1, F.lit(4)).alias("words"))
    index = phrases.postings(table(spark, sf, "documents"), "doc_id", phrases.plain_words(F.col("text")))
    return phrases.unique_text(index, "doc_id", runs, "phrase", F.col("words"))


@query("""WITH w AS (SELECT DISTINCT p_partkey, string_split(p_name, ' ') AS w FROM part), g AS (SELECT DISTINCT p_partkey, w[i] || ' ' || w[i + 1] AS g FROM w, range(1, 20) r(i) WHERE i < len(w))
SELECT p_partkey, count(DISTINCT b.other)::BIGINT AS parts FROM g a JOIN (SELECT p_partkey AS other, g FROM g) b ON a.g = b.g GROUP BY ALL""")
def phrases_of_parts(spark, sf):
    """Parts whose names share a pair of neighbouring words with each part's name."""
    p = table(spark, sf, "part")
    words = F.split("p_name", " ")
    pairs = p.select(F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(words) - 1), lambda i: F.slice(words, i, F.lit(2))))).alias("words")).distinct()
    pairs = pairs.filter("size(words) = 2").withColumn("phrase", F.array_join("words", " "))
    found = phrases.occurrences(phrases.postings(p, "p_partkey", words), "p_partkey", pairs, "phrase", F.col("words"))
    return phrases.sharing(found.select("phrase", "p_partkey").distinct(), "p_partkey", "phrase", "parts")
