"""HTML as a tree: nodes numbered in document order, selectors as joins on their intervals, tables laid out as grids.

A page is parsed once, by the task that reads it, into one row a node. A node's descendants are the nodes whose number lies in
its interval (pre, last], so what a selector asks for is an equi join on the page with a condition on two numbers, and Spark
deals it out by page.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from prumo.shared import kept, spread

TEXT = "#text"

# Fixed values of the HTML standard: elements without content, with raw text, and with text but no elements inside.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style"}
TEXT_ONLY = {"title", "textarea"}
# Fixed values of the HTML standard: elements whose start ends an open paragraph.
BLOCKS = {"address", "article", "aside", "blockquote", "center", "details", "dialog", "dir", "div", "dl", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "ul"}
# Fixed values of the HTML standard: what a start tag ends, and what it doesn't look beyond.
_CELLS, _PARTS = {"td", "th"}, {"thead", "tbody", "tfoot"}
ENDS: dict[str, tuple[set[str], set[str]]] = {
    "li": ({"li"}, {"ul", "ol", "menu", "table"}),
    "dt": ({"dt", "dd"}, {"dl", "table"}),
    "dd": ({"dt", "dd"}, {"dl", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": (_CELLS, {"tr", "table"}),
    "th": (_CELLS, {"tr", "table"}),
    "tr": (_CELLS | {"tr", "caption"}, {"table"}),
    **{part: (_CELLS | _PARTS | {"tr", "caption", "colgroup"}, {"table"}) for part in _PARTS},
    **{block: ({"p"}, {"table", "caption", "button", *_CELLS}) for block in BLOCKS},
}
#: End tags of these close elements inside a cell; others don't reach out of it.
_STRUCTURE = {"table", "caption", "colgroup", "tr", "html", "body", *_PARTS, *_CELLS}

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")


class Nodes:
    """Nodes of one page, in document order; see `nodes` for the columns."""

    def __init__(self, html: str):
        self.parent: list[int | None] = []
        self.last: list[int] = []
        self.level: list[int] = []
        self.place: list[int | None] = []
        self.tag: list[str] = []
        self.attributes: list[dict[str, str] | None] = []
        self.text: list[str | None] = []
        self.table: list[int | None] = []
        self.row: list[int | None] = []
        self.cell: list[int | None] = []
        self._open: list[int] = []
        self._elements: list[int] = [0]  # child elements so far, of the page and of each open element
        self._read(html)
        self._close(0)

    def _add(self, tag: str, attributes: dict[str, str] | None, text: str | None) -> None:
        element = tag != TEXT
        if element:
            self._elements[-1] += 1
        parent = self._open[-1] if self._open else None
        self.parent.append(parent)
        for near, tags in ((self.table, {"table"}), (self.row, {"tr"}), (self.cell, _CELLS)):
            near.append(None if parent is None else parent if self.tag[parent] in tags else near[parent])
        self.last.append(len(self.tag))
        self.level.append(len(self._open))
        self.place.append(self._elements[-1] if element else None)
        self.tag.append(tag)
        self.attributes.append(attributes)
        self.text.append(text)

    def _close(self, depth: int) -> None:
        """Close elements until `depth` are open."""
        for node in self._open[depth:]:
            self.last[node] = len(self.tag) - 1
        del self._open[depth:], self._elements[depth + 1 :]

    def _outermost(self, tags: set[str], barrier: set[str]) -> int | None:
        """How many elements stay open if the outermost of `tags` this side of the barrier is closed."""
        found = None
        for depth in range(len(self._open) - 1, -1, -1):
            tag = self.tag[self._open[depth]]
            if tag in tags:
                found = depth
            elif tag in barrier:
                break
        return found

    def _end(self, tag: str) -> None:
        for depth in range(len(self._open) - 1, -1, -1):
            here = self.tag[self._open[depth]]
            if here == tag:
                return self._close(depth)
            if here == "table" or here in _CELLS and tag not in _STRUCTURE:
                return None
        return None

    def _read(self, html: str) -> None:
        at = 0
        while (token := _TOKEN.search(html, at)) is not None:
            self._say(html[at : token.start()])
            at = token.end()
            closing, tag, rest = token.groups()
            if tag is None:
                continue  # a comment or declaration
            tag = tag.lower()
            if closing:
                self._end(tag)
                continue
            if tag in ENDS and (depth := self._outermost(*ENDS[tag])) is not None:
                self._close(depth)
            attributes: dict[str, str] = {}
            for name, *values in _ATTRIBUTE.findall(rest):
                attributes.setdefault(name.lower(), unescape("".join(values)))
            self._add(tag, attributes, None)
            if tag in VOID:
                continue
            self._open.append(len(self.tag) - 1)
            self._elements.append(0)
            if tag in RAW or tag in TEXT_ONLY:
                end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
                stop = end.start() if end else len(html)
                if tag in TEXT_ONLY:
                    self._say(html[at:stop])
                at = stop
        self._say(html[at:])

    def _say(self, text: str) -> None:
        if text:
            self._add(TEXT, None, unescape(text))


#: Rows of one batch that goes back to the JVM at least (so that rows don't go one table at a time, nor all in one), and pages that
#: are Python objects at once.
_ROWS, _PAGES = 1 << 13, 16


def _batches(batches: Iterator[pa.RecordBatch], row_type: pa.DataType, rows: int = _ROWS) -> Iterator[pa.RecordBatch]:
    """A batch for each few pages, so that many nodes never stand in one."""
    kinds = {"pre": pa.int32(), "last": pa.int32(), "parent": pa.int32(), "level": pa.int32(), "place": pa.int32(), "tag": pa.string(), "attributes": pa.map_(pa.string(), pa.string()), "text": pa.string(), "table": pa.int32(), "row": pa.int32(), "cell": pa.int32()}

    def flush() -> pa.RecordBatch:
        arrays = [pa.array(key, row_type), *(pa.array(columns[c], kind) for c, kind in kinds.items())]
        return pa.RecordBatch.from_arrays(arrays, ["key", *kinds])

    key, columns = [], {c: [] for c in kinds}
    for some in (batch.slice(n, _PAGES) for batch in batches for n in range(0, batch.num_rows, _PAGES)):
        for own, html in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True):
            tree = Nodes(html or "")
            n = len(tree.tag)
            key += [own] * n
            for c in kinds:
                columns[c] += range(n) if c == "pre" else [a and list(a.items()) if a is not None else None for a in tree.attributes] if c == "attributes" else getattr(tree, c)
            if len(key) >= rows:
                yield flush()
                key, columns = [], {c: [] for c in kinds}
    if key:
        yield flush()


def nodes(pages: DataFrame, key: str, html: str) -> DataFrame:
    """One row a node of each page: key, pre (its number in document order, from 0), last (the largest number inside it), parent,
    level (of the root 0), place (1, 2, ... among its parent's elements), tag (lower case, or #text), attributes (names in lower case,
    the first of equal ones; null of texts), text (of text nodes, entities resolved), and the numbers of the innermost table, row and cell
    around it.

    End tags that the HTML standard lets out are put in (of p, li, dt, dd, option and parts of tables, each within its own
    list or table); an end tag without its start is passed over; comments, declarations and the contents of script and style have
    no nodes. A page without markup is one text, a null or empty one has no nodes. key must tell pages apart.
    """
    kind = pages.schema[key].dataType
    schema = f"`{key}` {kind.simpleString()}, pre int, last int, parent int, level int, place int, tag string, attributes map<string,string>, text string, table int, row int, cell int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = iter(batches)
        first = next(held, None)
        if first is not None:
            for out in _batches((b for g in ((first,), held) for b in g), first.schema.field(0).type):
                yield out.rename_columns([key, *out.schema.names[1:]])

    return pages.select(key, F.col(html).cast("string").alias("_html")).mapInArrow(run, schema)


def element(tag: str | list[str] | None = None, id: str | None = None, cls: str | None = None, **attributes: str | bool) -> Column:
    """Condition on a node: its tag (or one of several), id, a class among its classes, and attributes of a value or, where True is given,
    of any."""
    tags = [tag] if isinstance(tag, str) else tag
    out = F.col("tag").isin(*tags) if tags else F.col("tag") != TEXT
    if id is not None:
        out &= F.col("attributes")["id"] == id
    if cls is not None:
        out &= F.array_contains(F.split(F.trim(F.col("attributes")["class"]), r"\s+"), cls)
    for name, value in attributes.items():
        own = F.col("attributes")[name.replace("_", "-")]
        out &= own.isNotNull() if value is True else own == value
    return F.coalesce(out, F.lit(False))


def _ends(of: DataFrame, key: str) -> DataFrame:
    return of.select(F.col(key).alias("_key"), F.col("pre").alias("_pre"), F.col("last").alias("_last"))


def _inside(key: str) -> Column:
    return (F.col(key) == F.col("_key")) & (F.col("pre") > F.col("_pre")) & (F.col("pre") <= F.col("_last"))


def descendants(tree: DataFrame, key: str, of: DataFrame) -> DataFrame:
    """Nodes of tree inside any node of `of`, each once."""
    return tree.join(_ends(of, key), _inside(key), "left_semi")


def children(tree: DataFrame, key: str, of: DataFrame) -> DataFrame:
    """Nodes of tree whose parent is in `of`."""
    return tree.join(_ends(of, key), (F.col(key) == F.col("_key")) & (F.col("parent") == F.col("_pre")), "left_semi")


def nearest(tree: DataFrame, key: str, of: DataFrame, out: str) -> DataFrame:
    """tree with the number of the innermost node of `of` that holds each node; nodes that none holds are left out."""
    held = tree.join(_ends(of, key), _inside(key)).groupBy(key, "pre").agg(F.max("_pre").alias(out))
    return tree.join(held, [key, "pre"])


def next_element(tree: DataFrame, key: str, of: DataFrame, out: str) -> DataFrame:
    """The elements that follow nodes of `of` under the same parent, with the number of the node that each follows as out."""
    before = of.select(F.col(key).alias("_key"), F.col("pre").alias(out), F.coalesce("parent", F.lit(-1)).alias("_parent"), (F.col("place") + 1).alias("_place"))
    same = (F.col(key) == F.col("_key")) & (F.coalesce("parent", F.lit(-1)) == F.col("_parent")) & (F.col("place") == F.col("_place"))
    return tree.join(before, same).drop("_key", "_parent", "_place")


def path(tree: DataFrame, key: str, steps: list[Column | str]) -> DataFrame:
    """Nodes that a selector finds: conditions from the outermost to the wanted one, each anywhere inside the one before it, or
    a child of it where ">" stands between."""
    found, child = None, False
    for step in steps:
        if isinstance(step, str):
            child = True
            continue
        own = tree.filter(step)
        found = own if found is None else (children if child else descendants)(own, key, found)
        child = False
    return found


def texts(tree: DataFrame, key: str, of: DataFrame, out: str, separator: str = " ", without: DataFrame | None = None) -> DataFrame:
    """key, pre and the text of each node of `of`: its texts without white space at their ends, the empty ones left out, joined; null if there is
    none. without: nodes whose texts don't count (nested tables, say)."""
    said = tree.filter(F.col("tag") == TEXT).select(key, "pre", F.regexp_replace("text", r"^\s+|\s+$", "").alias("text")).filter("text <> ''")
    ends = of.select(F.col(key).alias("_key"), F.col("pre").alias("_pre"), F.col("last").alias("_last"))
    held = said.join(ends, _inside(key))
    if without is not None:
        inner = without.select(F.col(key).alias("_k"), F.col("pre").alias("_a"), F.col("last").alias("_z"))
        gone = (F.col(key) == F.col("_k")) & (F.col("pre") > F.col("_a")) & (F.col("pre") <= F.col("_z")) & (F.col("_a") > F.col("_pre"))
        held = held.join(inner, gone, "left_anti")
    joined = held.groupBy(F.col("_key"), "_pre").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pre", "text"))), lambda t: t["text"]), separator).alias(out))
    return of.select(key, "pre").join(joined, (F.col(key) == F.col("_key")) & (F.col("pre") == F.col("_pre")), "left").select(key, "pre", out)


def _span(name: str, most: int) -> Column:
    """A span attribute as the standard reads it: digits at its beginning, 1 where there are none, up to `most`."""
    n = F.regexp_extract(F.coalesce(F.col("attributes")[name], F.lit("")), r"^\s*(\d{1,9})", 1).try_cast("int")
    return F.least(F.greatest(F.coalesce(n, F.lit(1)), F.lit(1)), F.lit(most))


def grid(tree: DataFrame, key: str) -> DataFrame:
    """Tables as grids: key, table (its number), row, col, origin (whether the cell begins here), header, value (the cell's text without
    those of tables inside it) for each place that a cell takes, with its rowspan and colspan.

    Rows and cells belong to the innermost table around them. A cell begins at its row's first column that no cell of an earlier row or
    of its own takes; spans end with the table's last row. What a table has comes together by (page, table) and is laid out in one go.
    """
    kind = tree.schema[key].dataType.simpleString()
    own = tree.filter(element(["tr", "td", "th"]) | (F.col("tag") == TEXT)).filter("`table` is not null")
    cell = F.col("tag").isin(*_CELLS)
    items = own.select(key, "table", "pre", "tag", "row", "cell", "text", F.when(cell, _span("rowspan", 65534)).alias("rowspan"), F.when(cell, _span("colspan", 1000)).alias("colspan"))
    tables = spread(items, key, "table").sortWithinPartitions(key, "table", "pre")
    return tables.mapInArrow(_laid_out, f"`{key}` {kind}, table int, row int, col int, origin boolean, header boolean, value string")


def _lay_out(items: list[dict], table: int) -> Iterator[tuple[int, int, bool, bool, str]]:
    """Places of one table: row, col, origin, header, value."""
    rows = {x["pre"]: n for n, x in enumerate(x for x in items if x["tag"] == "tr")}
    said: dict[int, list[str]] = {}
    for x in items:
        if x["tag"] == TEXT and x["cell"] is not None and x["cell"] > table and (text := x["text"].strip()):
            said.setdefault(x["cell"], []).append(text)
    taken: dict[int, int] = {}  # column -> last row that a cell takes there
    row, col = -1, 0
    for x in items:
        if x["tag"] not in _CELLS or x["row"] not in rows:
            continue
        if rows[x["row"]] != row:
            row, col = rows[x["row"]], 0
        while taken.get(col, -1) >= row:
            col += 1
        bottom, value = min(row + x["rowspan"], len(rows)) - 1, " ".join(said.get(x["pre"], ()))
        for c in range(col, col + x["colspan"]):
            taken[c] = max(taken.get(c, -1), bottom)
            for r in range(row, bottom + 1):
                yield r, c, (r, c) == (row, col), x["tag"] == "th", value
        col += x["colspan"]


def _laid_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of tables; nodes come in order, those of one table together."""
    kinds = {"table": pa.int32(), "row": pa.int32(), "col": pa.int32(), "origin": pa.bool_(), "header": pa.bool_(), "value": pa.string()}
    schema: pa.Schema | None = None
    places: list[tuple] = []

    def items() -> Iterator[tuple]:
        nonlocal schema
        for batch in batches:
            schema = batch.schema
            for some in (batch.slice(n, _ROWS) for n in range(0, batch.num_rows, _ROWS)):
                yield from zip(*(c.to_pylist() for c in some.columns), strict=True)

    def flush() -> pa.RecordBatch:
        columns = zip(zip(*places, strict=True), [schema.field(0).type, *kinds.values()], strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in columns], [schema.names[0], *kinds])

    for (own, table), nodes_ in groupby(items(), key=lambda x: x[:2]):
        for place in _lay_out([dict(zip(schema.names[2:], x[2:], strict=True)) for x in nodes_], table):
            places.append((own, table, *place))
            if len(places) >= _ROWS:
                yield flush()
                places = []
    if places:
        yield flush()


def records(cells: DataFrame, key: str, wanted: dict[str, list[str]]) -> DataFrame:
    """Rows of grids below their first one, a column for each entry of wanted: out -> header names, each tried as the whole
    header and then as its beginning, in any case; null where no header fits. Each table has headers of its own; tables with none of the
    headers are left out. Keeps table and row. cells: see grid."""
    low, whole = F.lower(F.trim("value")), W.partitionBy(key, "table")
    picks = {}
    for n, names in enumerate(wanted.values()):
        fits = [low == x.lower() for x in names] + [F.startswith(low, F.lit(x.lower())) for x in names]
        rank = F.coalesce(*(F.when(f, i) for i, f in enumerate(fits)))
        picks[f"_pick{n}"] = F.min(F.when((F.col("row") == 0) & rank.isNotNull(), F.struct(rank.alias("rank"), "col"))).over(whole)["col"]
    body = cells.withColumns(picks).filter("row > 0").filter(F.coalesce(*picks).isNotNull())
    return body.groupBy(key, "table", "row").agg(*(F.min(F.when(F.col("col") == F.col(pick), F.col("value"))).alias(out) for pick, out in zip(picks, wanted, strict=True)))


def labelled(tree: DataFrame, key: str) -> DataFrame:
    """key, at, label, value of what a page says by label: a <label> and the element after it, a <dt> and its <dd>, and table rows
    of two cells. Colons at a label's end are dropped; empty labels are left out; the first of equal labels counts."""
    tree = kept(tree.select(key, "pre", "last", "parent", "tag", "text", "row"), "nodes")  # pages are parsed once, not by each join
    elements = tree.filter(element())
    after = F.lead(F.struct("tag", "pre")).over(W.partitionBy(key, "parent").orderBy("pre"))
    in_row = W.partitionBy(key, "row", F.col("tag").isin(*_CELLS))
    seen = elements.withColumns({"_next": after, "_cells": F.count("*").over(in_row), "_first": F.min("pre").over(in_row), "_last": F.max("pre").over(in_row)})
    two = element(["td", "th"]) & F.col("row").isNotNull() & (F.col("_cells") == 2) & (F.col("pre") == F.col("_first"))
    pair = F.when(two, F.col("_last")).when(element("label") | element("dt") & (F.col("_next.tag") == "dd"), F.col("_next.pre"))
    pairs = seen.withColumn("_value", pair).filter("_value is not null").select(key, F.col("pre").alias("_label"), "_value")
    picked = tree.join(pairs.select(key, F.explode(F.array("_label", "_value")).alias("pre")).distinct(), [key, "pre"], "left_semi")
    said = texts(tree, key, picked, "said").select(F.col(key).alias("_k"), F.col("pre").alias("_p"), "said")
    both = pairs.join(said.withColumnRenamed("said", "label"), (F.col(key) == F.col("_k")) & (F.col("_label") == F.col("_p"))).drop("_k", "_p")
    both = both.join(said.withColumnRenamed("said", "value"), (F.col(key) == F.col("_k")) & (F.col("_value") == F.col("_p")), "left")
    named = both.select(key, F.col("_label").alias("at"), F.trim(F.regexp_replace("label", r"[:\s]+$", "")).alias("label"), "value").filter("label <> ''")
    return named.withColumn("_n", F.row_number().over(W.partitionBy(key, F.lower("label")).orderBy("at"))).filter("_n = 1").drop("_n")
