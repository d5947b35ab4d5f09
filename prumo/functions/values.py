"""Numbers, money and dates from text, and labels from dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Month names in Portuguese.
MONTHS = ("janeiro", "fevereiro", "março", "abril", "maio", "junho", "julho", "agosto", "setembro", "outubro", "novembro", "dezembro")


def brl(amount: Column) -> Column:
    """1234.5 -> R$ 1.234,50."""
    return F.concat(F.lit("R$ "), F.translate(F.format_number(amount, 2), ",.", ".,"))


#: An amount in Brazilian writing: digits in groups of three after points, or plain ones, then cents after a comma; it ends
#: where no more of a number follows.
_AMOUNT = r"(?<![\d.,])((?:[1-9]\d{0,2}(?:\.\d{3})+|\d+)(?:,\d{1,2})?)(?![\d]|[.,]\d)"


def parse_brl(text: Column) -> Column:
    """First amount such as 1.234,56, 1234,5 or 1234 as decimal(12,2); null if none. 12.5 is no such amount."""
    found = F.regexp_extract(text, _AMOUNT, 1)
    return F.when(found != "", F.translate(F.translate(found, ".", ""), ",", ".").try_cast("decimal(12,2)"))


def digits_brl(text: Column) -> Column:
    """An amount from all digits and the last comma or point with two digits behind it, whatever else stands there; null
    without digits."""
    bare = F.regexp_replace(text, r"[^\d.,]", "")
    cents = F.regexp_extract(bare, r"[.,](\d{2})$", 1)
    whole = F.regexp_replace(F.when(cents != "", F.regexp_replace(bare, r"[.,]\d{2}$", "")).otherwise(bare), r"\D", "")
    return F.when(whole != "", F.concat(whole, F.lit("."), F.when(cents != "", cents).otherwise("00")).try_cast("decimal(12,2)"))


def parse_count(text: Column) -> Column:
    """Leading digits as a count; the fraction of a number is cut off, true and false count as 1 and 0; null if there are no
    digits (a reserve list)."""
    digits = F.regexp_extract(text, r"^\s*(\d+)", 1)
    word = F.lower(F.trim(text))
    return F.when(digits != "", digits.try_cast("int")).when(word == "true", 1).when(word == "false", 0)


def hourly(salary: Column, weekly_hours: Column) -> Column:
    """Monthly salary over the month's hours (weekly hours * 52 / 12), two decimals; null without hours or salary."""
    return F.when((weekly_hours > 0) & (salary > 0), F.round((salary / (weekly_hours * 52 / 12)).cast("decimal(18,6)"), 2))


def weekly_hours(text: Column) -> Column:
    """Hours of a plain weekly load ('40h', '40 horas semanais'); null for shifts and other wordings ('30 h/semana' among them)."""
    hours = F.regexp_extract(F.lower(F.trim(text)), r"^(\d{1,3})\s*h(?:oras)?(?:\s*semana(?:l|i|is))?$", 1)
    return F.when(hours != "", hours.try_cast("int"))


def hourly_of(salary: Column, kind: Column, load: Column) -> Column:
    """hourly() for pay by the month and a plain weekly load; null otherwise."""
    return F.when(kind == "mensal", hourly(salary, weekly_hours(load)))


def hourly_shown(salary: Column, kind: Column, load: Column) -> Column:
    """The looser value for display: pay counts as monthly unless it says otherwise, hours are the first number of the load, with its decimals
    ('37,5h')."""
    hours = F.replace(F.regexp_extract(load, r"(\d+(?:[.,]\d+)?)", 1), F.lit(","), F.lit(".")).try_cast("decimal(8,2)")
    return F.when(F.coalesce(kind, F.lit("mensal")) == "mensal", hourly(salary, hours))


def date_br(text: Column) -> Column:
    return F.to_date(F.try_to_timestamp(text, F.lit("dd/MM/yyyy")))


def date_iso(text: Column) -> Column:
    return F.to_date(F.try_to_timestamp(F.substring(text, 1, 10), F.lit("yyyy-MM-dd")))


def date_words(text: Column) -> Column:
    """8 setembro 2026, 8 de setembro de 2026; null otherwise."""
    rx = r"(?iu)(\d{1,2})\s+(?:de\s+)?([a-zç]+)\s+(?:de\s+)?(\d{4})"
    month = F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(F.regexp_extract(text, rx, 2)))
    day, year = (F.regexp_extract(text, rx, k).try_cast("int") for k in (1, 3))
    return F.to_date(F.try_to_timestamp(F.format_string("%04d-%02d-%02d", year, month.cast("int"), day), F.lit("yyyy-MM-dd")))


def period(text: Column) -> tuple[Column, Column]:
    """Both ends of 'dd/mm[/yyyy] a dd/mm/yyyy'. A first date without year takes the second's, and the year before if it
    would come later than the second."""
    rx = r"(\d{2}/\d{2})(?:/(\d{4}))?\s+a\s+(\d{2}/\d{2}/\d{4})"
    first, year, last = (F.regexp_extract(text, rx, k) for k in (1, 2, 3))
    end = date_br(last)
    begin = date_br(F.concat_ws("/", first, F.when(year != "", year).otherwise(F.substring(last, 7, 4))))
    return F.when((year == "") & (begin > end), F.add_months(begin, -12)).otherwise(begin), end


def moment_pair(text: Column) -> tuple[Column, Column]:
    """Two date-times 'dd/mm/yy[yy] HH:MM' in a text; null where there is none or an impossible one."""
    rx = r"(\d{2}/\d{2}/)(\d{2,4})\D{1,6}?(\d{2}:\d{2})"
    days, years, times = (F.regexp_extract_all(text, F.lit(rx), F.lit(k)) for k in (1, 2, 3))

    def at(k: int) -> Column:
        year = F.get(years, F.lit(k))
        return F.try_to_timestamp(F.concat(F.get(days, F.lit(k)), F.when(F.length(year) == 2, F.concat(F.lit("20"), year)).otherwise(year), F.lit(" "), F.get(times, F.lit(k))), F.lit("dd/MM/yyyy HH:mm")).cast("timestamp_ntz")

    return at(0), at(1)


def period_any(text: Column) -> tuple[Column, Column]:
    """Both ends of a period in any of the usual writings: two dates with a dash, 'a', 'até' or 'e' between, in figures or words."""
    figures = F.regexp_extract_all(text, F.lit(r"(\d{2}/\d{2}/\d{4})"), F.lit(1))
    worded = F.regexp_extract_all(text, F.lit(r"(?iu)(\d{1,2}\s+(?:de\s+)?[a-zç]+\s+(?:de\s+)?\d{4})"), F.lit(1))
    both, short = F.size(figures) >= 2, period(text)
    return (
        F.when(both, date_br(figures[0])).when(F.size(worded) >= 2, date_words(worded[0])).otherwise(short[0]),
        F.when(both, date_br(figures[1])).when(F.size(worded) >= 2, date_words(worded[1])).otherwise(short[1]),
    )


def chronology(begin: Column, end: Column) -> Column:
    return F.when(begin.isNull() | end.isNull(), "incomplete").when(end < begin, "reversed").when(end == begin, "same day").otherwise("in order")


def review_payload(df: DataFrame, keep: list[str], begin: str, end: str, today: Column) -> DataFrame:
    """What a reviewer gets of a record: the fields to keep, the label of its dates, and the days left until the end (null if it is over)."""
    left = F.datediff(end, today)
    return df.select(*keep, chronology(F.col(begin), F.col(end)).alias("label"), F.when(left >= 0, left).alias("left_days"))


def lifecycle(begin: Column, end: Column, today: Column) -> Column:
    return F.when(end < today, "encerrada").when(begin > today, "futura").otherwise("aberta")


def badge(end: Column, today: Column) -> Column:
    left = F.datediff(end, today)
    return F.when(left < 0, "closed").when(left == 0, "last day").when(left == 1, "one day").when(left <= 3, "few days").otherwise("open")


def json_int(column: Column, path: str) -> Column:
    return F.get_json_object(column, path).try_cast("int")


def strict_brl(text: Column) -> Column:
    """First amount after R$ that has cents; null without one."""
    found = F.regexp_extract(text, r"R\$\s*(\d{1,3}(?:\.\d{3})*,\d{2})", 1)
    return F.when(found != "", F.translate(F.regexp_replace(found, r"\.", ""), ",", ".").try_cast("decimal(12,2)"))


def paid_by_shift(text: Column) -> Column:
    """The text itself if it pays by hour or shift, so that it isn't read as a monthly amount; else null."""
    return F.when(F.lower(text).rlike("hora|plant"), text)


def reserve_list(text: Column) -> Column:
    """Whether a count of openings names a reserve list (CR)."""
    return F.coalesce(F.upper(text).rlike(r"(^|[^A-Z])CR([^A-Z]|$)|CADASTRO"), F.lit(False))


def date_mixed(text: Column) -> Column:
    """A date in ISO or Brazilian form at the start of the text; null for impossible ones."""
    return F.coalesce(date_iso(text), date_br(F.substring(text, 1, 10)))


#: Number words from one to ten in Portuguese.
NUMBER_WORDS = ("um", "dois", "três", "quatro", "cinco", "seis", "sete", "oito", "nove", "dez")


def deadline_days(text: Column) -> Column:
    """Days of 'prazo de 5 (cinco) dias' or 'prazo de cinco dias'; null otherwise."""
    rx = r"(?iu)prazo de (\d+|[a-zê]+)(?: \([^)]*\))? dias"
    found = F.lower(F.regexp_extract(text, rx, 1))
    word = F.array_position(F.array(*map(F.lit, NUMBER_WORDS)), found).cast("int")
    return F.coalesce(found.try_cast("int"), F.when(word > 0, word))
