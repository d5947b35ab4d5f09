"""Boundary cases of functions and operators, each against results written out by hand (as SQL values)."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prumo.functions import extraction, rules, text, values
from prumo.operators import canonical, monitor, resolve
from prumo.sources import feeds, files, html


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).upper()
    if isinstance(value, (int, Decimal)):
        return f"CAST({value} AS DECIMAL(12,2))" if isinstance(value, Decimal) else str(value)
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value}'"
    if isinstance(value, date):
        return f"DATE '{value}'"
    return "'" + str(value).replace("'", "''") + "'"


def expected(columns: str, rows: list[tuple]) -> str:
    """SQL for what boundary cases must give, written out by hand."""
    body = ", ".join("(" + ", ".join(map(_literal, r)) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) v({columns})"


def numbered(spark: SparkSession, texts: list) -> DataFrame:
    """Texts of boundary cases as rows (id from 0, t)."""
    return spark.createDataFrame(list(enumerate(texts)), "id int, t string")


QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLE_SQL[f.__name__] = f, sql
        return f

    return add


def cases(columns: str, rows: list[tuple]):
    """A query over the first entries of rows; the others are what it must return, by id."""
    sql = expected(f"id, {columns}", [(i, *r[1:]) for i, r in enumerate(rows)])

    def add(f):
        def run(spark, sf):
            return numbered(spark, [r[0] for r in rows]).select("id", *f(F.col("t")))

        run.__name__, run.__doc__ = f.__name__, f.__doc__
        QUERIES[f.__name__], ORACLE_SQL[f.__name__] = run, sql
        return run

    return add


@cases("ascii, keep", [("Ā ½ ﬁ", "a 12 fi", "a ½ ﬁ"), ("ČESKÝ  ā", "cesky  a", "cesky a"), ("1º Açaí", "1o acai", "1º acai"), ("São João d’Água", "sao joao dagua", "sao joao d’agua"), ("Straße – nº", "strae  no", "straße – nº"), (None, None, None), ("", "", ""), ("Ｆull Ｗidth", "full width", "ｆull ｗidth")])
def unicode_folds(t):
    """Both folds beyond Portuguese letters: one drops what has no ASCII form, the other only marks."""
    return text.fold_ascii(t).alias("ascii"), text.fold_keep(t).alias("keep")


@cases("dedup, organ, alnum", [
    ("Prefeitura do Município de Corumbataí", "prefeitura de corumbatai", "prefeitura de corumbatai", "prefeitura do municipio de corumbatai"),
    ("Prefeitura Municipal de Corumbataí", "prefeitura de corumbatai", "prefeitura de corumbatai", "prefeitura municipal de corumbatai"),
    ("Câmara Municipal de Corumbataí", "camara municipal de corumbatai", "camara municipal de corumbatai", "camara municipal de corumbatai"),
    ("Prefeitura de Belo Horizonte - SMSA", "prefeitura de belo horizonte - smsa", "prefeitura de belo horizonte", "prefeitura de belo horizonte smsa"),
    ("Prefeitura Municipal de Belo Horizonte - Secretaria Municipal de Saúde", "prefeitura de belo horizonte - secretaria municipal de saude", "prefeitura de belo horizonte", "prefeitura municipal de belo horizonte secretaria municipal de saude"),
    ("Secretaria Municipal de Saúde de Belo Horizonte", "secretaria municipal de saude de belo horizonte", "prefeitura de belo horizonte", "secretaria municipal de saude de belo horizonte"),
    ("Ginecologista /  Obstetra", "ginecologista/obstetra", "ginecologista/obstetra", "ginecologista obstetra"),
    (None, "", "", None),
])
def organisation_folds(t):
    return text.dedup_key(t).alias("dedup"), text.organ_key(t).alias("organ"), text.alnum_key(t).alias("alnum")


@cases("host, state", [("http://exa mple.com/a|b", None, None), ("https://WWW.Luz.mg.gov.br:8080/x?y=1", "luz.mg.gov.br", "MG"), ("https://x.zz.gov.br/", "x.zz.gov.br", None), ("notaurl", None, None), (None, None, None)])
def hosts_of_odd_urls(t):
    return text.host(t).alias("host"), text.state_of_host(t).alias("state")


_LONG = "0123456789" * 3 + " medico " + "x" * 20 + " medico medico " + "y" * 40


@cases("excerpt", [("short medico", "short medico"), (_LONG, _LONG[:20] + "\n[...]\n" + _LONG[28:45] + "\n[...]\n" + _LONG[56:73]), ("z" * 61, "z" * 20), (None, None)])
def excerpts(t):
    """Within 60 characters: a third from the start, then windows around hits behind it, none overlapping."""
    return (text.excerpt(t, "medico", 60, 3, 8).alias("excerpt"),)


@cases("physician", [
    ("Médico Clínico Geral", True), ("Cardiologista", True), ("Médico - Medicina de Emergência", True), ("Médica Pediatra", True), ("Médico do Trabalho", True), ("Psiquiatra", True),
    ("Ginecologista e Obstetra", True), ("Médico Veterinário", False), ("Medicina Veterinária", False), ("Estagiário - Medicina", False), ("Biomedicina", False), ("Fisioterapeuta Geriátrico", False),
    ("Fisioterapeuta", False), ("Enfermeiro", False), (None, False), ("", False), ("Técnico Auxiliar de Regulação Médica", False), ("Secretária Médica", False), ("Cirurgião Vascular", True), ("Odontólogo - Radiologia", False),
])
def physician_rules(t):
    return (rules.physician(text.fold_keep(t)).alias("physician"),)


@cases("area, health, residency, internal", [
    ("Enfermeiro Obstetra", "enfermagem", True, False, False), ("Professor de Enfermagem", "outra", False, False, False), ("Engenheiro de Software", "engenharia", False, False, False),
    ("Analista de TI", "ti", False, False, False), ("Programador Pleno", "ti", False, False, False), ("Estagiário de Ciência da Computação", "outra", False, False, False),
    ("Psicólogo", "outra", True, False, False), ("Médico Residente - Residência Médica", "outra", True, True, False), ("Concurso Interno de Professor", "outra", False, False, True), (None, "outra", False, False, False),
])
def area_rules(t):
    folded = text.fold_keep(t)
    return rules.area(folded).alias("area"), rules.health(folded).alias("health"), rules.residency(folded).alias("residency"), rules.internal_contest(folded).alias("internal")


_ACT = "Prefeitura. Edital de abertura do processo seletivo. Quadro de vagas: Médico Clínico 20 horas R$ 9.000,00."


@cases("candidate, quota", [
    (f"Edital 182/2026|{_ACT}", True, False), (f"Edital de Convocação|{_ACT}", False, False), ("Edital 5/2026|Processo seletivo para professor, 20 horas, R$ 3.000,00", False, False),
    ("Edital 6/2026|Concurso público. Fica convocado o candidato; Médico, vaga 1", False, False), ("Edital 7/2026|Processo seletivo. Apresentar exame médico. Vagas: Motorista", False, False),
    ("Edital 8/2026|Inscrições abertas. Médico veterinário, 2 vagas", False, False), ("erro|You've hit your usage limit. Try again at 9pm", False, True), ("erro|connection reset", False, False),
])
def opening_candidates(t):
    """Title and body split at the bar."""
    title, body = (text.fold_keep(F.split_part(t, F.lit("|"), F.lit(k))) for k in (1, 2))
    return rules.opening_candidate(title, body).alias("candidate"), rules.quota_error(F.split_part(t, F.lit("|"), F.lit(2))).alias("quota")


@cases("blocked, pdf", [("<title>Just a moment...</title>", True, False), ("<p>Pardon Our Interruption</p>", True, False), ("x" * 3000, False, False), ("403 " + "x" * 3000, False, False), ("403 short", True, False), ("%PDF-1.7 data", False, True), (None, False, False)])
def block_pages(t):
    """A text that begins with 403 stands for that status."""
    return rules.blocked(t, F.when(t.startswith("403"), 403).otherwise(200)).alias("blocked"), rules.is_pdf(t.cast("binary")).alias("pdf")


_D = Decimal


@cases("amount, digits", [
    ("R$ 1.234,56", _D("1234.56"), _D("1234.56")), ("1234,56", _D("1234.56"), _D("1234.56")), ("1234,5", _D("1234.50"), _D("12345.00")), ("1.234", _D("1234.00"), _D("1234.00")), ("12.5", None, _D("125.00")),
    ("1.234.567,89", _D("1234567.89"), _D("1234567.89")), ("a combinar", None, None), ("0,50", _D("0.50"), _D("0.50")), ("R$ 3500", _D("3500.00"), _D("3500.00")), (None, None, None),
])
def money_cases(t):
    return values.parse_brl(t).alias("amount"), values.digits_brl(t).alias("digits")


@cases("n, reserve", [("10", 10, False), ("12.9", 12, False), ("CR", None, True), ("3 + CR", 3, True), ("true", 1, False), ("false", 0, False), ("crescente", None, False), ("Cadastro de Reserva", None, True), (None, None, False)])
def count_cases(t):
    return values.parse_count(t).alias("n"), values.reserve_list(t).alias("reserve")


@cases("monthly, shown", [("mensal|40h", _D("23.08"), _D("23.08")), ("mensal|20 horas semanais", _D("46.15"), _D("46.15")), ("mensal|12x36", None, _D("76.92")), ("hora|40h", None, None), ("|30 h/semana", None, _D("30.77")), ("mensal|a definir", None, None)])
def hourly_cases(t):
    """4,000 a month with a kind of pay and a weekly load, split at the bar."""
    kind, load = F.nullif(F.split_part(t, F.lit("|"), F.lit(1)), F.lit("")), F.split_part(t, F.lit("|"), F.lit(2))
    pay = F.lit(4000).cast("decimal(12,2)")
    return values.hourly_of(pay, kind, load).cast("decimal(12,2)").alias("monthly"), values.hourly_shown(pay, kind, load).cast("decimal(12,2)").alias("shown")


@cases("first, last, opens, closes", [
    ("10/02/26 08:00 a 20/03/2026 17:59", datetime(2026, 2, 10, 8), datetime(2026, 3, 20, 17, 59), None, None), ("31/02/2026 08:00", None, None, None, None),
    ("de 10/02/2026 até 12/03/2026", None, None, date(2026, 2, 10), date(2026, 3, 12)), ("1 de março de 2026 a 2 de abril de 2026", None, None, date(2026, 3, 1), date(2026, 4, 2)),
    ("20/12 a 10/01/2027", None, None, date(2026, 12, 20), date(2027, 1, 10)), ("10/01 a 20/01/2027", None, None, date(2027, 1, 10), date(2027, 1, 20)), (None, None, None, None, None),
])
def moment_and_period_cases(t):
    (a, b), (c, d) = values.moment_pair(t), values.period_any(t)
    return a.alias("first"), b.alias("last"), F.when(a.isNull(), c).alias("opens"), F.when(a.isNull(), d).alias("closes")


@cases("title, body", [
    ("<HTML><TITLE lang=pt>A</TITLE><BODY><SCRIPT>var x=1;</SCRIPT>b <B>c</B></BODY>", "A", "A b c"), ("<style>p{}</STYLE ><p>x &lt; y</p><!-- z -->", "", "x < y"), (None, None, None),
])
def html_cases(t):
    return html.title(t).alias("title"), html.article_text(t).alias("body")


@query(expected("id, ordinal, href", [(0, 0, "x"), (0, 1, "y?a=1"), (0, 2, "z"), (2, 0, "/q")]))
def html_link_cases(spark, sf):
    """Single-quoted, bare and upper-case links; another attribute's value is none."""
    pages = numbered(spark, ["<a class=b href='x'>1</a><A HREF=y?a=1>2</A><a href=\"z\">3</a><a href='x'>4</a>", "<p>no href=here</p>", "<link rel=a href=\"/q\"><a data-href='n'>5</a>"])
    return html.links(pages, "id", "t")


@query(expected("id, row, role, pay, load", [(0, 1, "Médico", "9.000,00", "20h"), (0, 2, "Enfermeiro", "4.000,00", None), (1, 1, "Motorista", "2.500,00", None)]))
def html_header_table(spark, sf):
    """Columns found by their headers, whole or by their beginning, in any order and case; a short row lacks its last cells."""
    pages = numbered(spark, [
        "<table><tr><th>CARGO</th><th>Salário base</th><th>Carga</th></tr><tr><td>Médico</td><td>9.000,00</td><td>20h</td></tr><tr><td>Enfermeiro</td><td>4.000,00</td></tr></table>",
        "<TABLE><TR><TD>vencimento</TD><TD><b>Cargo</b></TD></TR><TR><TD>2.500,00</TD><TD>Motorista</TD></TR></TABLE>",
    ])
    return html.header_rows(pages, "id", "t", {"role": ["cargo", "função"], "pay": ["salário base", "salário", "vencimento"], "load": ["carga horária", "carga"]})


@query(expected("id, record, title, number", [(0, 0, "a", "1"), (0, 1, "b", None), (0, 2, "c", "3")]))
def html_groups(spark, sf):
    """Records by position: each begins with its title; the second lacks a number."""
    pages = numbered(spark, ["<div class='title'>a</div><span class=number>1</span><div class='title'>b</div><div class='title'>c</div><span class=number>3</span>"])
    return html.groups(pages, "id", "t", ["title", "number"]).withColumn("record", F.col("record").cast("int"))


@cases("name, age", [("<p><b>Nome:</b> Ana</p><li>Idade: 3<li>Nome: other</li>", "Ana", "3"), ("<P>NOME : <i>Bia</i></P>", "Bia", None), ("<p>no label here</p>", None, None)])
def label_cases(t):
    m = html.labelled_values(t)
    return m["nome"].alias("name"), m["idade"].alias("age")


@cases("found, n", [('<script>var d={"rows": [{"a":[1,2],"b":"x]"},{"a":[]}], "c":1}</script>', '[{"a":[1,2],"b":"x]"},{"a":[]}]', 2), ('{"rows": [1,', "", None), ('{"rows": {}}', "", None), (None, "", None)])
def embedded_array_cases(t):
    """Brackets inside values and texts don't end the array."""
    found = feeds.embedded_array(t, "rows")
    return found.alias("found"), F.json_array_length(found).alias("n")


@cases("a", [('```json\n{"a": "x\\d"}\n```', "x\\d"), ('{"a": "b\\u12"}', "b\\u12"), ('{"a": "\\u0041\\u0000z"}', "Az"), ('{"a": "q\\"r\\\\s"}', 'q"r\\s')])
def json_repair_cases(t):
    return (F.get_json_object(feeds.repaired(t), "$.a").alias("a"),)


_RSS = "<rss><channel><item><title>a</title><link>l1</link><pubDate>Wed, 02 Oct 2026 13:00:00 GMT</pubDate></item><item><title>b</title><link>l2</link><pubDate>02 Oct 2026 10:00:00 -0300</pubDate></item><item><title>c</title><link>l3</link><pubDate>soon</pubDate></item></channel></rss>"
_ATOM = '<feed><entry><title>d</title><link href="l4"/><updated>2026-10-02T13:00:00Z</updated></entry></feed>'


@query(expected("ordinal, title, link, published", [(0, "a", "l1", datetime(2026, 10, 2, 13)), (1, "b", "l2", datetime(2026, 10, 2, 13)), (2, "c", "l3", None), (0, "d", "l4", datetime(2026, 10, 2, 13))]))
def feed_times(spark, sf):
    rss, atom = feeds.rss_items(numbered(spark, [_RSS]), "id", "t"), feeds.atom_entries(numbered(spark, [_ATOM]), "id", "t")
    return rss.unionByName(atom).select("ordinal", "title", "link", feeds.published(F.col("published")).cast("timestamp_ntz").alias("published"))


@cases("taxa, prova, banca", [
    ('{"confianca":"alta","taxa":"50.5","prova":"2026-03-01","banca":"X"}', _D("50.50"), date(2026, 3, 1), None), ('{"confianca":"media","taxa":"x","prova":"2026-02-31"}', None, None, None),
    ('{"confianca":"baixa","taxa":"50.5","prova":"2026-03-01"}', None, None, None), ("not json", None, None, None), (None, None, None, None),
])
def gated_fields(t):
    """Only trusted replies count, only for what was asked, and an impossible date is dropped; 'banca' wasn't asked for."""
    got = extraction.accepted(t, F.array(F.lit("taxa"), F.lit("prova")), {"taxa": "decimal(12,2)", "prova": "date", "banca": "string"})
    return tuple(c.alias(n) for n, c in got.items())


@cases("n, first, links", [
    ('[{"cargo":"a"},{"cargo":"b"}]', 2, "a", None), ('{"vagas":[{"cargo":"c"}]}', 1, "c", None), ('{"cargo":"d","vagas":null}', 1, "d", None), ("oops", 0, None, None),
    ('{"docs":[{"u":"1"}]}', 1, None, "1"), ('{"docs":"[{\\"u\\":\\"2\\"}]"}', 1, None, "2"),
])
def reply_shapes(t):
    """Replies as a list, an object with a list, or one object; and an array that some send as a text."""
    got, docs = extraction.as_list(t, "cargo string"), extraction.list_or_text(t, "docs", "u string")
    return F.size(got).alias("n"), F.get(got, F.lit(0))["cargo"].alias("first"), F.get(docs, F.lit(0))["u"].alias("links")


@cases("said, kind", [("é", "é", "other"), ("%PDF-1.4", "%PDF-1.4", "pdf"), ("PK\x03\x04z", "PK\x03\x04z", "zip"), (None, None, "other")])
def byte_texts(t):
    """Bytes that are no UTF-8 are read as Latin-1: the letter é comes in its one-byte form here."""
    content = F.when(t == "é", F.encode(t, "ISO-8859-1")).otherwise(t.cast("binary"))
    return files.decoded(content).alias("said"), files.kind_of(content).alias("kind")


def _small(spark, rows):
    return spark.createDataFrame([(i, 1, "01/2026", *r) for i, r in enumerate(rows)], "row int, city int, number string, organ string, role string, pay decimal(12,2), problem string, flag boolean, external string")


@query("SELECT * FROM (VALUES ('Prefeitura Municipal de Santa Bárbara', 'Médico Ginecologista/Obstetra', 6080.66::DECIMAL(12,2), NULL, 2), ('Prefeitura de X', 'Médico', 5000::DECIMAL(12,2), NULL, 2), ('Prefeitura de Y', 'ACS', NULL, 'b', 1), ('Prefeitura de Y', 'ACE', NULL, NULL, 3)) v(organ, role, pay, problem, sightings)")
def canonical_cases(spark, sf):
    """Accents and spaces merge and fill the missing pay; a known pay stays; roles differ; a flagged problem is overwritten, by
    null too."""
    from decimal import Decimal as D

    new = _small(spark, [
        ("Prefeitura Municipal de Santa Bárbara", "Médico Ginecologista/Obstetra", None, None, False, "1"), ("Prefeitura Municipal de Santa Barbara", "Médico Ginecologista / Obstetra", D("6080.66"), None, False, "2"),
        ("Prefeitura de X", "Médico", D(5000), None, False, "3"), ("Prefeitura de X", "Médico", D(9999), None, False, "4"), ("Prefeitura de Y", "ACS", None, "b", False, "5"),
        ("Prefeitura de Y", "ACE", None, "a", False, "6"), ("Prefeitura de Y", "ACE", None, "c", False, "7"), ("Prefeitura de Y", "ACE", None, None, True, "8"),
    ])
    known = new.filter("false").select(F.lit("").alias("id"), "city", "number", "organ", "role", "pay", "problem")
    up = canonical.upsert_records(known, new.filter("false"), new, row="row", order=[F.col("row")], keys=["city"], number="number", folded={"organ": text.organ_key(F.col("organ")), "role": text.dedup_key(F.col("role"))}, fixed=[], optional=["pay"], problem="problem", overwrite="flag", evidence=["external"])
    return up.records.join(up.results.groupBy("id").agg(F.count("*").alias("sightings")), "id").select("organ", "role", "pay", "problem", "sightings")


_TITLES = [
    ("Concurso Público - Prefeitura de Abaeté - MG", "http://x.com", 1), ("Prefeitura de Abaetetuba", "http://x.com", 1), ("Câmara de São João del Rei", "http://x.com", 3), ("Polícia Civil do Estado de Minas", "http://x.com", None),
    ("Fundação Ouro Preto", "http://x.com", None), ("Ouro Preto do Oeste abre seleção", "http://x.com", None), ("Prefeitura de Ouro Preto - SP", "http://x.com", None), ("Prefeitura de Ouro Preto", "https://www.ouropreto.mg.gov.br/e", 4),
    ("Prefeitura de Ouro Preto", "https://x.sp.gov.br/e", None), ("Preouro Preto e Ouro Preto", "http://x.com", None), ("Luz abre vagas", "http://x.com", None), (None, None, None),
]


@query(expected("id, code", [(i, r[2]) for i, r in enumerate(_TITLES) if r[2] is not None]))
def place_in_title(spark, sf):
    """The longest place that a title names, with the guards on what stands around it and on its state."""
    titles = spark.createDataFrame([(i, r[0], r[1]) for i, r in enumerate(_TITLES)], "id int, title string, link string")
    places = spark.createDataFrame([(1, "Abaeté", "MG"), (2, "São João", "MG"), (3, "São João del Rei", "MG"), (4, "Ouro Preto", "MG"), (5, "Luz", "MG"), (6, "Minas Gerais", "MG"), (7, "Minas", "MG")], "code int, name string, uf string")
    return resolve.place_in_title(titles, "id", "title", "link", places, "code", "name", "uf")


_ACTS = [
    ("MG", "Prefeitura Municipal de Luz", "Convocação do concurso 001/2023, Médico", 1), ("MG", "Prefeitura de Luz", "Convoca médico pediatra", 2), ("MG", "Luz", "Convoca para exame médico de Motorista", None),
    ("SP", "Prefeitura de Luz", "concurso 1/2023", None), ("MG", "Município de Bambuí", "edital 02/24 e 3/2023", 4), ("MG", "Prefeitura de Luz", "Médico: concurso 11/2023", 2), ("MG", None, "concurso 1/2023", None),
]


@query(expected("id, target", [(i, r[3]) for i, r in enumerate(_ACTS) if r[3]]))
def contest_of_publication(spark, sf):
    """A cited number wins over a role; numbers are equal whatever their zeros and the digits of their year."""
    acts = spark.createDataFrame([(i, *r[:3]) for i, r in enumerate(_ACTS)], "id int, uf string, entity string, body string")
    targets = spark.createDataFrame([(1, "MG", "Luz", "1/2023", "Médico"), (2, "MG", "Luz", None, "Médico Pediatra"), (3, "SP", "Luz", "9/2023", "Médico"), (4, "MG", "Bambui", "2/2024", None)], "target int, uf string, city string, number string, role string")
    return resolve.target_contest(acts, "id", "uf", "entity", "body", targets, "target", "city", "number", "role")


_CALL = "EDITAL DE CONVOCAÇÃO 03/2026"


_PUBS = [
    (0, _CALL, "Convoca-se o candidato JOSE DA CONCEICAO SOUZA para posse"), (1, _CALL, "candidato Souza"), (2, _CALL, "Considerando que o servidor municipal Bianca Maria da Silva do Vale, ocupante do cargo"),
    (3, _CALL, "Convoca a candidata Maria da Silva, classificada em 3º"), (4, _CALL, "86 JOSIANE RIBEIRO DE ALMEIDA MARIA DA SILVA SANTOS 89 PEDRO LIMA"), (5, "PORTARIA 12 EXONERAÇÃO", "exonera Maria da Silva"),
    (6, "Resultado final", "Resultado final. Fica convocada para apresentar documentos a candidata Maria da Silva, 7ª colocada."), (7, "Lei 5", "Denomina a praça Maria da Silva."), (8, _CALL, "Convoca: SILVA, Maria da (2º lugar)"),
    (9, _CALL, "Luz, 3 de maio. Maria da Silva, Prefeita Municipal"), (10, "Atos", "Férias de Maria da Silva. " + "x " * 900 + "Convoca a candidata Maria da Silva, 3º."), (11, None, None),
]


@query(expected("key, watch, confidence", [(0, 1, None), (3, 2, "alta"), (4, 2, None), (4, 3, None), (6, 2, "baixa"), (8, 2, "baixa"), (10, 2, "alta")]))
def watched_names(spark, sf):
    """Full names in calls: no surname alone, no end of a longer name but in lists of capitals, no signature, no other act; a
    later place of the name counts, too."""
    pubs = spark.createDataFrame(_PUBS, "key long, title string, text string")
    watch = spark.createDataFrame([(1, "José da Conceição Souza", None), (2, "Maria da Silva", 3), (3, "Maria da Silva Santos", None), (4, "Souza", None)], "watch long, name string, rank int")
    return monitor.watched_names(pubs, watch).select("key", "watch", "confidence")


_CONTESTS = [
    ("MG", "Prefeitura de Luz", _CALL, "Aprovados no concurso 1/2023. Médico Clínico", True), ("MG", "Prefeitura de Luz", "Ata de registro de preço, convocação", "concurso 1/2023, Médico", False),
    ("MG", "Prefeitura de Luz", _CALL, "concurso 2/2023. Médico", False), ("MG", "Prefeitura de Luz", _CALL, "concurso 1/2023. Exame médico do motorista", False), ("SP", "Prefeitura de Luz", _CALL, "concurso 1/2023 médico", False),
]


@query(expected("key, watch", [(i, 1) for i, r in enumerate(_CONTESTS) if r[4]]))
def watched_contests(spark, sf):
    pubs = spark.createDataFrame([(i, *r[:4]) for i, r in enumerate(_CONTESTS)], "key long, state string, entity string, title string, text string")
    watch = spark.createDataFrame([(1, "MG", "Luz", "001/2023", "Médico")], "watch long, state string, city string, number string, role string")
    return monitor.watched_contests(pubs, watch)


_CALLS = [
    ("O Prefeito convoca os candidatos aprovados no Concurso Público nº 01/2023 para o cargo de Médico Pediatra.", "convocacao", "Concurso Publico 1/2023"), ("Nomeia João para cargo em comissão de médico", None, None),
    ("Nomeia a médica aprovada no processo seletivo 3/24.", "nomeacao", "Processo Seletivo 3/24"), ("Convoca candidatos aprovados: médico veterinário", None, None), ("Convoca para audiência pública os candidatos e o médico", None, None),
    ("Chamamento público para credenciamento de médicos candidatos", None, None), ("Convocação de professores aprovados", None, None), (None, None, None),
]


@query(expected("key, kind, contest", [(i, *r[1:]) for i, r in enumerate(_CALLS) if r[1]]))
def physician_calls(spark, sf):
    return monitor.physician_calls(numbered(spark, [r[0] for r in _CALLS]).select(F.col("id").cast("long").alias("key"), F.col("t").alias("text"))).select("key", "kind", "contest")


@query(expected("key, name, rank, cpf", [(0, "Maria da Silva Santos", 1, "***.123.456-**"), (0, "João Pereira Lima", 2, None), (1, "Ana Souza Pires", None, None), (3, "Pedro Lima Costa", 86, None)]))
def listed_people(spark, sf):
    """Persons of lists: with ranks and masked numbers, behind a label; not the mayor, not who was dropped, each once."""
    lists = numbered(spark, ["1º MARIA DA SILVA SANTOS CPF ***.123.456-**\n2º JOÃO PEREIRA LIMA\n3º RUI BARBOSA NETO - desclassificado", "Candidata: Ana Souza Pires, cargo Médico. Luz, Carlos Alberto Nunes, Prefeito Municipal", "Nenhum nome", "86 PEDRO LIMA COSTA 87 PEDRO LIMA COSTA", None])
    return monitor.listed_people(lists.select(F.col("id").cast("long").alias("key"), F.col("t").alias("text")))


@query(expected("id, label, left_days", [(0, "in order", 9), (1, "reversed", None), (2, "incomplete", 3)]))
def review_payload(spark, sf):
    """What a reviewer gets: the record's fields with the label of its dates and the days left."""
    from prumo.functions import values

    rows = spark.createDataFrame([(0, date(2026, 1, 1), date(2026, 1, 20)), (1, date(2026, 2, 1), date(2026, 1, 5)), (2, None, date(2026, 1, 14))], "id int, opens date, closes date")
    today = F.lit("2026-01-11").cast("date")
    left = F.datediff("closes", today)
    return rows.select("id", values.chronology(F.col("opens"), F.col("closes")).alias("label"), F.when(left >= 0, left).alias("left_days"))
