"""Queries on HTML as a tree: selectors, paragraphs, nested tables, grids with spans, values by label."""

from __future__ import annotations

from pyspark.sql import functions as F

from prumo.plans.common import table
from prumo.shared import kept, spread
from prumo.sources import html_tree as tree
from prumo.sources.html_tree import element

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLE_SQL[f.__name__] = f, sql
        return f

    return add


_PLAIN = "replace(replace(replace({}, '&quot;', chr(34)), '&lt;', '<'), '&amp;', '&')"


@query(f"""WITH n AS (SELECT page_id, regexp_extract(html, '<nav>(.*?)</nav>', 1, 's') AS nav FROM pages),
a AS (SELECT page_id, regexp_extract_all(nav, '<a href="([^"]*)">', 1) AS hrefs, regexp_extract_all(nav, '<a href="[^"]*">([^<]*)</a>', 1) AS said FROM n)
SELECT page_id, i::INT AS place, {_PLAIN.format("hrefs[i]")} AS href, {_PLAIN.format("said[i]")} AS said FROM a, range(1, 1000) r(i) WHERE i <= len(hrefs)""")
def html_tree_nav(spark, sf):
    """Selector nav ul > li > a: the links of each page's navigation with their places, targets and texts."""
    t = tree.nodes(table(spark, sf, "pages"), "page_id", "html")
    items = tree.path(t, "page_id", [element("nav"), element("ul"), ">", element("li")])
    links = tree.children(t.filter(element("a", href=True)), "page_id", items)
    place = items.select(F.col("page_id").alias("_k"), F.col("pre").alias("_li"), F.col("place").alias("_place"))
    said = tree.texts(t, "page_id", links, "said")
    with_place = links.join(place, (F.col("page_id") == F.col("_k")) & (F.col("parent") == F.col("_li")))
    return with_place.join(said, ["page_id", "pre"]).select("page_id", F.col("_place").alias("place"), F.col("attributes")["href"].alias("href"), "said")


@query(f"""WITH a AS (SELECT page_id, string_split(regexp_extract(html, '<article>(.*?)</article>', 1, 's'), '<p>') AS parts FROM pages),
p AS (SELECT page_id, i AS nth, regexp_extract(parts[i + 1], '^(.*?)(</p>|$)', 1, 's') AS part FROM a, range(1, 100000) r(i) WHERE i < len(parts)),
t AS (SELECT page_id, nth, list_filter(list_transform(regexp_split_to_array(part, '<[^>]*>'), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> '') AS said FROM p)
SELECT page_id, nth, CASE WHEN len(said) > 0 THEN {_PLAIN.format("array_to_string(said, ' ')")} END AS said FROM t""")
def html_tree_paragraphs(spark, sf):
    """Paragraphs of articles, most without end tags and with elements left open inside."""
    t = kept(tree.nodes(table(spark, sf, "pages"), "page_id", "html").drop("attributes"), "nodes")
    paragraphs = tree.path(t, "page_id", [element("article"), ">", element("p")])
    said = tree.texts(t, "page_id", paragraphs, "said")
    nth = F.expr("row_number() over (partition by page_id order by pre)").cast("long").alias("nth")
    return said.select("page_id", nth, "said")


@query("""WITH e AS (SELECT page_id, html, len(regexp_extract_all(html, '<(p|b|br|li|a|ul|nav|article|div|h1|footer)[ >]')) AS n FROM pages)
SELECT page_id, n, len(regexp_extract_all(html, '<li[ >]')) AS items, len(regexp_extract_all(html, '<p[ >]')) AS paragraphs FROM e""")
def html_tree_descendants(spark, sf):
    """Elements inside the body, by their intervals."""
    t = tree.nodes(table(spark, sf, "pages"), "page_id", "html")
    inside = tree.descendants(t.filter(element()), "page_id", t.filter(element("body")))
    counts = (F.count_if(c).alias(n) for c, n in ((element(["p", "b", "br", "li", "a", "ul", "nav", "article", "div", "h1", "footer"]), "n"), (element("li"), "items"), (element("p"), "paragraphs")))
    return inside.groupBy("page_id").agg(*counts)


def _orders(spark, sf):
    """Each customer's orders as an array by order key."""
    o = F.struct("o_orderkey", F.col("o_orderkey").cast("string").alias("key"), "o_orderstatus")
    return spread(table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus"), "o_custkey").groupBy("o_custkey").agg(F.array_sort(F.collect_list(o)).alias("orders"))


@query("""SELECT o_custkey, o_custkey::VARCHAR AS client, NULL::VARCHAR AS pedido, NULL::VARCHAR AS status FROM orders GROUP BY ALL
UNION ALL SELECT o_custkey, NULL, o_orderkey::VARCHAR, o_orderstatus FROM orders""")
def html_tree_nested(spark, sf):
    """Tables inside cells: each table has its own header, and the inner rows are no rows of the outer table. The inner one
    leaves its end tags out."""
    rows = F.array_join(F.transform("orders", lambda o: F.concat(F.lit("<tr><td>"), o["o_orderstatus"], F.lit("<td><b> "), o["key"], F.lit("</b>"))), "")
    client = F.col("o_custkey").cast("string")
    page = F.concat(F.lit("<TABLE><thead><tr><th>Lista<th>Cliente</thead><tbody><tr><td>ver <table><tr><th>SITUA&Ccedil;&Atilde;O<th>Pedido n&ordm;"), rows, F.lit("</table> fim</td><td>"), client, F.lit("</td></tr></tbody></TABLE>"))
    cells = tree.grid(tree.nodes(_orders(spark, sf).withColumn("page", page), "o_custkey", "page"), "o_custkey")
    got = tree.records(cells, "o_custkey", {"client": ["cliente"], "pedido": ["pedido"], "status": ["status", "situação"]})
    return got.select("o_custkey", "client", "pedido", "status")


@query("SELECT o_custkey, o_orderstatus AS status, o_orderkey AS key FROM orders")
def html_tree_grid(spark, sf):
    """A status that spans the rows of its orders, under a title that spans both columns."""
    groups = spread(table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus"), "o_custkey").groupBy("o_custkey", "o_orderstatus").agg(F.sort_array(F.collect_list(F.col("o_orderkey").cast("string"))).alias("keys"))
    first = F.concat(F.lit("<td rowspan="), F.size("keys").cast("string"), F.lit(">"), "o_orderstatus", F.lit("</td>"))
    rows = F.array_join(F.transform("keys", lambda k, i: F.concat(F.lit("<tr>"), F.when(i == 0, first).otherwise(""), F.lit("<td>"), k, F.lit("</td></tr>"))), "")
    pages = groups.withColumn("rows", rows).groupBy("o_custkey").agg(F.array_join(F.array_sort(F.collect_list("rows")), "").alias("rows"))
    page = F.concat(F.lit("<table><tr><th colspan=2>Pedidos</th></tr>"), "rows", F.lit("</table>"))
    cells = tree.grid(tree.nodes(pages.withColumn("page", page), "o_custkey", "page"), "o_custkey").filter("row > 0")
    picked = (F.min(F.when(F.col("col") == c, F.col("value"))) for c in (0, 1))
    wide = cells.groupBy("o_custkey", "row").agg(*(p.alias(n) for p, n in zip(picked, ("status", "key"), strict=True)))
    return wide.select("o_custkey", "status", F.col("key").cast("long").alias("key"))


@query("SELECT c_custkey, c_name AS nome, c_mktsegment AS segmento, c_nationkey::VARCHAR AS pais FROM customer")
def html_tree_labels(spark, sf):
    """Values by label in three layouts: labels before values, lists of terms, rows of two cells."""
    name, segment, nation = F.col("c_name"), F.col("c_mktsegment"), F.col("c_nationkey").cast("string")
    a = F.concat(F.lit("<div><label>Nome: </label><p>"), name, F.lit("</p><label>Segmento</label> <span> "), segment, F.lit("</span><label><b>Pa&iacute;s</b>:</label><div><i>"), nation, F.lit("</i></div></div>"))
    b = F.concat(F.lit("<dl><dt>NOME<dd>"), name, F.lit("<dt>segmento:<dd>"), segment, F.lit("<dd>more<dt>none<dt>país<dd>"), nation, F.lit("<dt>nome<dd>other</dl>"))
    c = F.concat(F.lit("<table><tr><td>Nome:<td>"), name, F.lit("<tr><td>a<td>b<td>c<tr><td>Segmento<td>"), segment, F.lit("<tr><th>País<td>"), nation, F.lit("</table>"))
    kind = F.col("c_custkey") % 3
    customers = spread(table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey"), "c_custkey")
    pages = customers.withColumn("page", F.when(kind == 0, a).when(kind == 1, b).otherwise(c))
    said = tree.labelled(tree.nodes(pages, "c_custkey", "page"), "c_custkey")
    picked = (F.max(F.when(F.lower("label") == x, F.col("value"))).alias(n) for x, n in (("nome", "nome"), ("segmento", "segmento"), ("país", "pais")))
    return said.groupBy("c_custkey").agg(*picked)
