"""Ordered rules over text: the first that holds gives the label."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Roots of medical specialties that name a physician without the word, on text without accents.
SPECIALTIES = (
    "cardiolog", "pediatr", "psiquiatr", "ginecolog", "ortoped", "anestesiolog",
    "dermatolog", "oftalmolog", "urolog", "endocrinolog", "hematolog", "oncolog",
    "otorrino", "pneumolog", "reumatolog", "geriatr", "infectolog", "mastolog",
    "angiolog", "gastroenterolog", "nefrolog", "clinica medica", "cirurgia geral",
    "cirurgia vascular", "cirurgiao geral", "medicina intensiva", "medicina de familia",
    "medicina do trabalho", "medicina de emergencia",
    "cirurgiao vascular", "neurocirurg", "medicina hospitalar", "arritmolog", "cirurgia plastica",
    "cirurgiao plastico", "cirurgia refrativa", "ceratocone", "radiologia e diagnostico por imagem",
)
#: Other professions whose names hold such a root.
COLLIDING = ("fisioterapeut", "odonto", "dentist", "enfermag", "enfermeir")
#: First words of support roles, for which 'medica' is an adjective.
SUPPORT = "tecnico tecnica tecnicos tecnicas auxiliar auxiliares atendente secretario secretaria recepcionista agente motorista servente tecnologo tecnologa escriturario escrituraria operador operadora".split()
#: Patterns of the areas, on text without accents, and of roles that are never taken.
AREAS = {
    "enfermagem": "enfermeir|enfermagem",
    "engenharia": "engenheir",
    "ti": (
        r"analista de (?:sistemas|ti\b|tecnologia|dados|redes|infraestrutura|seguranca|suporte|desenvolvimento)"
        r"|desenvolvedor|programador|tecnologia da informacao|cientista de dados|ciencia de dados"
        r"|administrador de (?:redes|banco|dados)|seguranca da informacao|engenheiro de (?:software|dados|computacao)"
        r"|\bti\b|ciencia da computacao|infraestrutura de ti"
    ),
}
NEVER = "professor|docente|estagi|monitor|menor aprendiz"
#: Health roles, on text without accents.
HEALTH = r"medic[oa]?s?\b|enfermeir|fisioterapeut|psicolog|nutricionist|fonoaudiolog|odontolog|dentist|farmaceutic|assistente\s+social|biomedic|veterinari|terapeuta\s+ocupacional|agente\s+comunitario\s+de\s+saude|saude"
#: What pages say that keep robots out, and the status codes that refuse.
BLOCK_MARKERS = (
    "just a moment",
    "attention required! | cloudflare",
    "cf-chl",
    "cf_chl_opt",
    "checking your browser before accessing",
    "ddos protection by",
    "sucuri website firewall",
    "incapsula incident id",
    "datadome",
    "perimeterx",
    "please verify you are a human",
    "verifying you are human",
    "enable javascript and cookies to continue",
    "pardon our interruption",
)
REFUSING = (403, 429, 503)
#: Categories and title marks of gazette acts that open no selection, and marks of later phases and of openings.
NO_OPENINGS = ("ata de registro de precos", "licitacoes", "contratos", "leis", "decretos", "portarias")
CLOSED_TITLE = (
    r"c\s?o\s?n\s?v\s?o\s?c|homologa|resultado|classifica|gabarito|errata|prorroga|nomea|exonera|cancel|suspen|recurso|comissao|conselho tutelar|"
    r"extrato de contrato|dispensa|inexigib|credenciamento|\blista\b|relacao d|ensalamento|locais de prova|isenc|deferid|termo de|edital de chamada\b|"
    r"chamamento\s*n\S*\s*\d+/\d+\s*do\s*(?:concurso|processo)|chamada publica suplementar|posse|decreto|portaria|\blei\b|resoluc|sumula|aditivo|plano de contrata|eliminad|candidatos|comunicado"
)
OPENING = r"processo seletivo|concurso publico|\bpss\b|edital de abertura|abertura de inscri|inscric(?:ao|oes)|chamamento publico"
LATER = r"a\s+convocacao dos candidatos|ficam? convocad|classificacao final|homologacao d[aeo]|resultado (?:final|preliminar|d[oa] (?:sorteio|processo|concurso))|avaliacao dos titulos|convocacao d[eo]s? candidat"
OPENING_STRONG = r"edital de abertura|abertura (?:do|de) (?:processo|concurso)|periodo de inscri|inscricoes (?:abertas|serao|poderao)|as inscricoes"
NOT_A_ROLE = r"medico[- ]veterin\w*|(?:exame|laudo|atestado) medico|junta medica|perito medico"
ROLE = r"\bmedic[oa]s?\b|\b(?:clinic[oa] geral|ginecolog|obstetr|pediatr|psiquiatr|ortoped|cardiolog|anestesi)"
PAY = r"r\$|\b\d{1,2}\s?(?:h\b|horas)|\bvagas?\b|\bcargos?\b|salario|vencimento|\bcbo\b|remunera"


def first_rule(rules: list[tuple[str, Column]], otherwise: str) -> Column:
    out = F.lit(otherwise)
    for name, test in reversed(rules):
        out = F.when(test, F.lit(name)).otherwise(out)
    return out


def physician(folded: Column) -> Column:
    """Whether a role on folded text is a physician's. In this order: nothing isn't, a vet isn't, a role with the word is unless
    its first word names a support role, a colliding profession isn't, a specialty is."""
    words = F.split(F.trim(folded), r"\s+")
    named = F.exists(words, lambda w: w.startswith("medico") | w.startswith("medica"))
    rules = F.when(folded.contains("veterinari"), False).when(named, ~words[0].isin(SUPPORT)).when(folded.rlike("|".join(COLLIDING)), False)
    return F.coalesce(rules.otherwise(folded.rlike("|".join(SPECIALTIES))), F.lit(False))


def area(folded: Column) -> Column:
    """The area of a role; roles of teaching and training have none."""
    return first_rule([("outra", folded.rlike(NEVER)), *((name, folded.rlike(rx)) for name, rx in AREAS.items())], "outra")


def health(title: Column, area: Column | None = None) -> Column:
    """Whether the folded title, or the folded area beside it, names a health role."""
    hit = F.coalesce(title.rlike(HEALTH), F.lit(False))
    return hit if area is None else hit | F.coalesce(area.rlike(HEALTH), F.lit(False))


def residency(title: Column) -> Column:
    return F.coalesce(title.rlike("residencia|residente"), F.lit(False))


def internal_contest(title: Column) -> Column:
    return F.coalesce(title.contains("intern"), F.lit(False))


def opening_candidate(title: Column, body: Column, category: Column | None = None) -> Column:
    """Whether a gazette act on folded text looks like the opening of a selection for physicians: its title names no later
    phase, it says that it opens one, the first 1,200 characters announce no later phase unless they clearly open one, and a
    medical role stands within 100 characters before and 140 behind of what vacancies have (pay, hours, places). Before all that, a category (folded, too) that never brings an opening rules it out."""
    both = F.concat_ws(" ", title, body)
    head = F.substring(body, 1, 1200)
    later = F.coalesce(head.rlike(LATER) & ~head.rlike(OPENING_STRONG), F.lit(False))
    clean = F.regexp_replace(both, NOT_A_ROLE, " ")
    near = clean.rlike(rf"(?s)(?:{ROLE}).{{0,140}}(?:{PAY})|(?:{PAY}).{{0,100}}(?:{ROLE})")
    out = F.coalesce(~title.rlike(CLOSED_TITLE), F.lit(True)) & both.rlike(OPENING) & ~later & near
    return out if category is None else ~F.coalesce(category.isin(*NO_OPENINGS), F.lit(False)) & out


def quota_error(message: Column, marks: tuple[str, ...] = ("usage limit", "rate limit", "quota", "too many requests", "429")) -> Column:
    """Whether an error says that a quota is used up, so that the next try has to wait."""
    return F.coalesce(F.lower(message).rlike("|".join(marks)), F.lit(False))


def opening_notice(folded: Column) -> Column:
    """Says 'edital' and names no later phase."""
    return folded.rlike("edital") & ~folded.rlike("retifica|resultado|convoca|homolog|gabarito")


def opportunity(folded: Column) -> Column:
    return first_rule([("processo_seletivo_temporario", folded.contains("seletivo")), ("credenciamento", folded.contains("credenciamento")), ("concurso_efetivo", folded.contains("concurso"))], "outro")


def blocked(body: Column, status: Column | None = None, short: int = 2000) -> Column:
    """A marker in the body, or a refusing status with a short body."""
    low = F.lower(F.coalesce(body, F.lit("")))
    hit = F.exists(F.array(*map(F.lit, BLOCK_MARKERS)), lambda m: low.contains(m))
    return hit if status is None else hit | (F.coalesce(status.isin(*REFUSING), F.lit(False)) & (F.length(F.trim(low)) < short))


def is_pdf(content: Column) -> Column:
    """Whether binary content begins as PDF files do."""
    return F.coalesce(F.substring(content, 1, 5) == F.lit(b"%PDF-"), F.lit(False))
