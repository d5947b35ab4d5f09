"""Rows from XML feeds and JSON texts; texts that don't parse give no rows instead of an error."""

from __future__ import annotations

import json
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RSS = "channel struct<item: array<struct<title: string, link: string, pubDate: string>>>"


ATOM = "entry array<struct<title: string, link: struct<_href: string>, updated: string>>"
SITEMAP = "url array<struct<loc: string>>"


def atom_entries(df: DataFrame, key: str, xml: str) -> DataFrame:
    """Entries of Atom feeds in their order."""
    items = F.from_xml(F.col(xml), ATOM, {"mode": "PERMISSIVE"})["entry"]
    return df.select(key, F.posexplode(items).alias("ordinal", "_i")).select(key, "ordinal", "_i.title", F.col("_i.link._href").alias("link"), F.col("_i.updated").alias("published"))


def published(text: Column) -> Column:
    """An RSS or Atom time as a UTC timestamp: RFC 822 with a zone name or offset (none counts as UTC), or ISO 8601; else null."""
    rfc = F.regexp_replace(F.regexp_replace(F.trim(text), r"^[A-Za-z]{3},\s*", ""), r"\s(?:GMT|UTC|UT|Z)$", " +0000")
    bare = F.when(rfc.rlike(r"[+-]\d{4}$"), rfc).otherwise(F.concat(rfc, F.lit(" +0000")))
    return F.coalesce(F.try_to_timestamp(bare, F.lit("d MMM yyyy HH:mm:ss Z")), F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}T"), F.try_to_timestamp(text)))


def sitemap_urls(df: DataFrame, key: str, xml: str, institutional: list[str]) -> DataFrame:
    """Addresses of sitemaps, each once a map, without a closing slash; those of institutional pages are left out."""
    found = F.transform(F.from_xml(F.col(xml), SITEMAP, {"mode": "PERMISSIVE"})["url"], lambda u: F.regexp_replace(F.trim(u["loc"]), "/+$", ""))
    return df.select(key, F.explode(F.array_distinct(found)).alias("url")).filter((F.col("url") != "") & ~F.col("url").isin(institutional))


def rss_items(df: DataFrame, key: str, xml: str) -> DataFrame:
    """Items of RSS feeds in their order."""
    items = F.from_xml(F.col(xml), RSS, {"mode": "PERMISSIVE"})["channel"]["item"]
    return df.select(key, F.posexplode(items).alias("ordinal", "_i")).select(key, "ordinal", "_i.title", "_i.link", F.col("_i.pubDate").alias("published"))


def json_rows(df: DataFrame, keys: list[str], text: Column, schema: str, required: str) -> DataFrame:
    """One row per object of a JSON array. Elements that aren't objects, and objects without `required`, are left out."""
    rows = df.select(*keys, F.explode(F.from_json(text, f"array<struct<{schema}>>")).alias("_r"))
    return rows.filter(F.col(f"_r.{required}").isNotNull()).select(*keys, "_r.*")


@F.arrow_udf(T.StringType())
def _array_at(text: pa.Array, name: pa.Array) -> pa.Array:
    """The text of the JSON array behind "name":, read as JSON, so that brackets inside it and in strings don't end it."""
    reader, out = json.JSONDecoder(), []
    for t, n in zip(text.to_pylist(), name.to_pylist(), strict=True):
        found = re.search(rf'"{re.escape(n)}"\s*:\s*(?=\[)', t) if t else None
        try:
            out.append(t[found.end() : reader.raw_decode(t, found.end())[1]] if found else "")
        except ValueError:
            out.append("")
    return pa.array(out, pa.string())


def embedded_array(html: Column, name: str) -> Column:
    """The JSON array that follows "name": in a page; empty text if there is none or it isn't JSON."""
    return _array_at(html, F.lit(name))


def data_table(df: DataFrame, key: str, names: Column, rows: Column) -> DataFrame:
    """Records of a table sent as column names and rows of values: one map per row; rows of another length are left out."""
    got = df.select(key, F.from_json(names, "array<string>").alias("_n"), F.posexplode(F.from_json(rows, "array<array<string>>")).alias("ordinal", "_v"))
    return got.filter(F.size("_n") == F.size("_v")).select(key, "ordinal", F.map_from_arrays("_n", "_v").alias("record"))


def repaired(text: Column) -> Column:
    """A JSON reply without its code fence, with backslashes that start no JSON escape doubled, also those of a \\u without four
    hexadecimal digits, and without escaped null characters, which no text column may hold."""
    bare = F.regexp_replace(F.regexp_replace(text, r"(?s)^\s*```(?:json)?\s*", ""), r"(?s)\s*```\s*$", "")
    fixed = F.regexp_replace(bare, r'(?<!\\)((?:\\\\)*)\\(?!["\\/bfnrt]|u[0-9a-fA-F]{4})', r"$1\\\\")
    return F.regexp_replace(fixed, r"(?<!\\)((?:\\\\)*)\\u0000", "$1")
