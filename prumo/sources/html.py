"""Rows from HTML columns with built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


#: An attribute's value: in double quotes, in single ones, or bare.
_VALUE = r"""\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""


def _attributes(html: Column, tag: str, name: str) -> Column:
    """Values of an attribute of all such tags, in order; names in any case."""
    found = F.regexp_extract_all(html, F.lit(rf"(?is)<{tag}\b[^>]*?(?<![-\w]){name}{_VALUE}"), F.lit(1))
    quoted = lambda v: F.substring(v, 1, 1).isin('"', "'")
    return F.filter(F.transform(found, lambda v: F.when(quoted(v), F.substring(v, F.lit(2), F.length(v) - 2)).otherwise(v)), lambda v: v != "")


def links(pages: DataFrame, key: str, html: str) -> DataFrame:
    """Distinct href targets of each page with their place, first occurrence wins."""
    return pages.select(key, F.posexplode(F.array_distinct(_attributes(F.col(html), "[a-z][a-z0-9]*", "href"))).alias("ordinal", "href"))


def title(html: Column) -> Column:
    return F.regexp_extract(html, r"(?is)<title\b[^>]*>(.*?)</title>", 1)


def plain(html: Column) -> Column:
    """Text of a fragment: tags as spaces, a few entities decoded, single spaces."""
    out = F.regexp_replace(html, r"<[^>]*>", " ")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&nbsp;", " "), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(out, r"\s+", " "))


def article_text(html: Column) -> Column:
    """Text without head, scripts, styles, navigation, header, footer, comments and tags; a few entities decoded."""
    body = F.regexp_replace(html, r"(?is)<(head|script|style|nav|header|footer)\b.*?</\1\s*>", " ")
    return plain(F.regexp_replace(body, r"(?s)<!--.*?-->", " "))


def table_cells(pages: DataFrame, key: str, html: str) -> DataFrame:
    """Cells of all table rows: row and cell ordinals, text without tags."""
    rows = pages.select(key, F.posexplode(F.regexp_extract_all(F.col(html), F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr\s*>"), F.lit(1))).alias("row", "_r"))
    cells = rows.select(key, "row", F.posexplode(F.regexp_extract_all("_r", F.lit(r"(?is)<t[dh]\b[^>]*>(.*?)</t[dh]\s*>"), F.lit(1))).alias("cell", "_c"))
    return cells.select(key, "row", "cell", plain(F.col("_c")).alias("value"))


def header_rows(pages: DataFrame, key: str, html: str, wanted: dict[str, list[str]]) -> DataFrame:
    """Rows of tables with a header, one column per entry of wanted: out -> header names, each tried as the whole header and
    then as its beginning, in any case; null where no header fits. The first row is the header; keeps the row's ordinal."""
    rows = table_cells(pages, key, html).groupBy(key, "row").agg(F.transform(F.array_sort(F.collect_list(F.struct("cell", "value"))), lambda c: c["value"]).alias("cells"))
    heads = rows.filter("row = 0").select(key, F.transform("cells", lambda c: F.lower(c)).alias("_h"))

    def begins(name: str) -> Column:
        return F.array_position(F.transform("_h", lambda c: c.startswith(name)), True)

    def place(names: list[str]) -> Column:
        low = [n.lower() for n in names]
        return F.coalesce(*(F.nullif(at, F.lit(0).cast("long")) for at in (*(F.array_position("_h", n) for n in low), *map(begins, low))))

    joined = rows.filter("row > 0").join(heads, key)
    return joined.select(key, "row", *(F.get("cells", (place(names) - 1).cast("int")).alias(out) for out, names in wanted.items()))


def groups(pages: DataFrame, key: str, html: str, names: list[str]) -> DataFrame:
    """Records of a page cut by position: labelled spans or divs (class = name) in document order; a record ends before the
    first name comes again. Columns in names; null where a record lacks one."""
    rx = F.lit(rf"""(?is)<(?:span|div)\b[^>]*\bclass\s*=\s*["']?({"|".join(names)})["']?[^>]*>(.*?)</(?:span|div)\s*>""")
    found = pages.select(key, F.posexplode(F.arrays_zip(F.regexp_extract_all(F.col(html), rx, F.lit(1)).alias("n"), F.regexp_extract_all(F.col(html), rx, F.lit(2)).alias("v"))).alias("_at", "_f"))
    opens = (F.col("_f.n") == names[0]).cast("int")
    numbered = found.withColumn("record", F.sum(opens).over(W.partitionBy(key).orderBy("_at")) - 1)
    first = [F.min_by(plain(F.col("_f.v")), F.when(F.col("_f.n") == n, F.col("_at"))).alias(n) for n in names]
    return numbered.filter("record >= 0").groupBy(key, "record").agg(*first)


def labelled_values(html: Column) -> Column:
    """Map from label to value of 'Label: value' in list items and paragraphs, tags inside ignored; the first of equal labels
    counts."""
    blocks = F.transform(F.regexp_extract_all(html, F.lit(r"(?is)<(?:li|p)\b[^>]*>(.*?)(?:</(?:li|p)\s*>|(?=<(?:li|p)\b))"), F.lit(1)), plain)
    pairs = F.filter(blocks, lambda b: b.rlike(r"^[^:]{2,40}:\s*\S"))
    entries = F.transform(pairs, lambda b: F.struct(F.lower(F.trim(F.substring_index(b, ":", 1))).alias("key"), F.trim(F.regexp_replace(b, r"^[^:]*:", "")).alias("value")))
    first = F.filter(entries, lambda e, i: F.array_position(F.transform(entries, lambda x: x["key"]), e["key"]) == i + 1)
    return F.map_from_entries(first)
