"""Queries on sitemaps, replies with two scopes, rotations and array tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from prumo.functions import extraction
from prumo.operators import lookup
from prumo.plans.common import table
from prumo.sources import feeds

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLE_SQL[f.__name__] = f, sql
        return f

    return add


@query("SELECT n_regionkey, 'http://s/' || n_nationkey AS url FROM nation WHERE n_nationkey % 5 <> 2")
def sitemap_clients(spark, sf):
    """Sitemaps of regions, each address twice and with a closing slash; those of institutional pages are left out."""
    n = table(spark, sf, "nation")
    loc = F.concat(F.lit("<url><loc>http://s/"), F.col("n_nationkey").cast("string"), F.lit("/</loc></url><url><loc>http://s/"), F.col("n_nationkey").cast("string"), F.lit("</loc></url>"))
    maps = n.groupBy("n_regionkey").agg(F.concat(F.lit("<urlset>"), F.array_join(F.collect_list(loc), ""), F.lit("</urlset>")).alias("xml"))
    known = [f"http://s/{k}" for k in range(2, 100, 5)]
    return feeds.sitemap_urls(maps, "n_regionkey", "xml", known)


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN o_totalprice::DECIMAL(12,2) ELSE (o_orderkey % 100)::DECIMAL(12,2) END AS taxa, CASE WHEN o_orderpriority = '1-URGENT' THEN 'known' WHEN o_orderkey % 2 = 0 THEN 'role ' || o_custkey END AS load FROM orders""")
def scoped_fill(spark, sf):
    """Nulls of a vacancy from a reply with fields of the notice and, in its list, of the role; known values stay."""
    reply = F.concat(F.lit('{"taxa": '), (F.col("o_orderkey") % 100).cast("string"), F.lit(', "vagas": [{"cargo": "Médico", "load": "role '), F.col("o_custkey").cast("string"), F.lit('"}]}'))
    o = table(spark, sf, "orders").withColumn("reply", reply)
    role = F.filter(extraction.as_list(F.col("reply"), "cargo string, load string"), lambda v: v["cargo"] == F.when(F.col("o_orderkey") % 2 == 0, "Médico").otherwise("ACS"))
    current = {"taxa": F.when(F.col("o_orderstatus") != "F", F.col("o_totalprice")).cast("decimal(12,2)"), "load": F.when(F.col("o_orderpriority") == "1-URGENT", "known")}
    got = extraction.filled(current, {"taxa": F.get_json_object("reply", "$.taxa").try_cast("decimal(12,2)")}, {"load": F.get(role, F.lit(0))["load"]})
    return o.select("o_orderkey", *(c.alias(n) for n, c in got.items()))


@query("SELECT p_partkey, ['SP','MG','BA','RJ','PR'][(p_size * 3 + i) % 5 + 1] AS uf, i AS place FROM part, range(3) r(i)")
def state_rotation(spark, sf):
    """Three states a day of a list of five; the start moves on every second day. Days are counted so that part sizes give them."""
    day = F.date_add(F.lit("0001-01-01").cast("date"), (F.col("p_size") * 2 - 1).cast("int"))
    names = lookup.rotation(["SP", "MG", "BA", "RJ", "PR"], day, 3, 2)
    return table(spark, sf, "part").select("p_partkey", F.posexplode(names).alias("place", "uf")).withColumn("place", F.col("place").cast("long"))


@query("SELECT o_custkey, bool_or(o_orderpriority IN ('1-URGENT', '2-HIGH')) AS urgent FROM orders GROUP BY ALL")
def array_intersection(spark, sf):
    kinds = table(spark, sf, "orders").groupBy("o_custkey").agg(F.collect_set("o_orderpriority").alias("p"))
    return kinds.select("o_custkey", lookup.in_any(F.col("p"), ["1-URGENT", "2-HIGH"]).alias("urgent"))
