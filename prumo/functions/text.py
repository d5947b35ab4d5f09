"""Text functions as Column builders."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T



def _normal(form: str):
    @F.arrow_udf(T.StringType())
    def run(text: pa.Array) -> pa.Array:
        return pc.utf8_normalize(text, form=form)

    return run


def _decomposed(text: Column, form: str) -> Column:
    """text in a Unicode normal form. Only rows with a character beyond ASCII leave the JVM; the others are in it already."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(_normal(form)(F.when(text.rlike(r"[^\x00-\x7F]"), text)), text)


def fold_keep(text: Column) -> Column:
    """Lower case without combining marks, white space as single spaces; other characters stay (the gazette fold)."""
    bare = F.regexp_replace(_decomposed(text, "NFD"), r"\p{Mn}+", "")
    return F.trim(F.regexp_replace(F.lower(bare), r"(?U)\s+", " "))


def fold_ascii(text: Column) -> Column:
    """Lower case ASCII: compatibility forms are taken apart (ordinals, ligatures, fractions), what has no ASCII form vanishes,
    ends are trimmed (the record fold)."""
    return F.trim(F.lower(F.regexp_replace(_decomposed(text, "NFKD"), r"[^\x00-\x7F]", "")))


def dedup_key(text: Column) -> Column:
    """The record fold with no space around slashes, single spaces and one form of 'prefeitura'; empty for null."""
    one = F.trim(F.regexp_replace(F.regexp_replace(fold_ascii(text), r"\s*/\s*", "/"), r"\s+", " "))
    return F.coalesce(F.regexp_replace(one, r"\bprefeitura (?:do municipio|municipal) de\b", "prefeitura de"), F.lit(""))


def organ_key(text: Column) -> Column:
    """dedup_key of an organisation: without a ' - suffix', and a municipal health office counts as its city hall."""
    return F.regexp_replace(F.regexp_replace(dedup_key(text), r"\s+-\s+.*$", ""), r"^secretaria municipal de saude de\b", "prefeitura de")


def alnum_key(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(fold_ascii(text), r"[^a-z0-9]", " "), r" +", " "))


def slug(text: Column, most: int | None = None) -> Column:
    """Letters and digits joined by hyphens, cut at `most` characters."""
    out = F.regexp_replace(F.regexp_replace(fold_ascii(text), r"[^a-z0-9]+", "-"), r"^-+|-+$", "")
    return F.substring(out, 1, most) if most else out


def title_pt(text: Column) -> Column:
    """Portuguese title case: particles stay lower, except as first word."""
    small = ["da", "das", "de", "do", "dos", "e"]
    words = F.split(F.lower(text), " ")
    cased = F.transform(words, lambda w, i: F.when(w.isin(small) & (i > 0), w).otherwise(F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 20))))
    return F.array_join(cased, " ")


def suffixes(text: Column, most: int = 4) -> Column:
    """The last n words for n = most .. 1: candidates for a place name at the end of a title, longest first."""
    words = F.split(F.trim(text), r"\s+")
    return F.transform(F.sequence(F.least(F.lit(most), F.size(words)), F.lit(1), F.lit(-1)), lambda n: F.array_join(F.slice(words, F.size(words) - n + 1, n), " "))


def snippet(text: Column, hit: str, radius: int) -> Column:
    """Keyword in context: radius characters around the first hit; null without one."""
    at = F.locate(hit, text)
    begin = F.greatest(at - radius, F.lit(1))
    return F.when(at > 0, text.substr(begin, at + len(hit) + radius - begin))


def upper_share(text: Column) -> Column:
    """Share of capital letters among ASCII letters; 0 without letters."""
    letters = F.length(F.regexp_replace(text, "[^A-Za-z]", ""))
    return F.when(letters > 0, F.length(F.regexp_replace(text, "[^A-Z]", "")) / letters).otherwise(0.0)


def host(url: Column) -> Column:
    """Host in lower case without www; null for a malformed address."""
    return F.regexp_replace(F.lower(F.try_parse_url(url, F.lit("HOST"))), r"^www\.", "")


#: States.
STATES = "AC AL AM AP BA CE DF ES GO MA MG MS MT PA PB PE PI PR RJ RN RO RR RS SC SE SP TO".split()


def state_of_host(url: Column) -> Column:
    """The state that a host under .<state>.gov.br names; null otherwise."""
    found = F.upper(F.regexp_extract(host(url), r"\.([a-z]{2})\.gov\.br$", 1))
    return F.when(found.isin(STATES), found)


def excerpt(text: Column, hit: str, budget: int, before: int = 600, after: int = 1400) -> Column:
    """At most `budget` characters of a long text: its first third of the budget, then windows around hits behind it that do
    not overlap, as long as they fit; null for null. hit: a pattern without groups."""
    third = budget // 3
    behind = F.substring(text, third + 1, 1 << 30)
    gaps, found = F.split(behind, hit), F.regexp_extract_all(behind, F.lit(f"({hit})"), F.lit(1))
    spans = F.zip_with(F.slice(gaps, 1, F.greatest(F.size(gaps) - 1, F.lit(0))), found, lambda g, h: F.struct(F.length(g).alias("g"), F.length(h).alias("h")))
    zero = F.struct(F.lit(third).alias("at"), F.lit(third).alias("used"), F.lit(third).alias("end"), F.lit(False).alias("full"), F.array().cast("array<struct<a:int,b:int>>").alias("kept"))

    def step(s, x):
        start = s["at"] + x["g"]
        stop = start + x["h"]
        a, b = F.greatest(s["end"], start - before), F.least(F.length(text), stop + after)
        wanted = ~s["full"] & (start >= s["end"])
        fits = s["used"] + (b - a) <= budget
        take = wanted & fits
        return F.struct(
            stop.alias("at"),
            F.when(take, s["used"] + (b - a)).otherwise(s["used"]).alias("used"),
            F.when(take, b).otherwise(s["end"]).alias("end"),
            (s["full"] | (wanted & ~fits)).alias("full"),
            F.when(take, F.array_append(s["kept"], F.struct(a.alias("a"), b.alias("b")))).otherwise(s["kept"]).alias("kept"),
        )

    kept = F.aggregate(spans, zero, step)["kept"]
    pieces = F.transform(kept, lambda w: text.substr(w["a"] + 1, w["b"] - w["a"]))
    return F.when(text.isNull() | (F.length(text) <= budget), text).otherwise(F.concat_ws("\n[...]\n", F.substring(text, 1, third), pieces))


def slug_variants(text: Column) -> Column:
    """Slugs of a place name with and without hyphens, with and without prepositions; equal ones once, in that order."""
    whole = slug(text)
    short = F.regexp_replace(whole, r"-(?:da|das|de|do|dos|e)(?=-)", "")
    return F.array_distinct(F.array(whole, F.replace(whole, F.lit("-")), short, F.replace(short, F.lit("-"))))


def strip_prefix(text: Column, prefixes: list[str]) -> Column:
    """Text without the first of the prefixes that it starts with in any case, trimmed."""
    out = text
    for p in reversed(prefixes):
        out = F.when(F.upper(text).startswith(p.upper()), F.substring(text, len(p) + 1, 1 << 30)).otherwise(out)
    return F.trim(out)


def safe_url(url: Column) -> Column:
    """Whether a page of the public web: http or https, no user part, a dotted host name that isn't local or a bare address."""
    ok = url.rlike(r"^https?://[A-Za-z0-9.-]+\.[A-Za-z]{2,}(?::[0-9]+)?(?:[/?#]|$)") & ~url.rlike(r"(?i)^https?://(?:[^/]*\.)?(?:localhost|local|internal)(?:[:/?#]|$)")
    return F.coalesce(ok, F.lit(False))
