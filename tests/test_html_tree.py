"""Trees of HTML against trees that were written out as HTML, and grids against painting them."""

import random
from html import escape
from html.parser import HTMLParser

import pytest

from prumo.sources import html_tree as tree
from prumo.sources.html_tree import TEXT, Nodes, element


class Plain(HTMLParser):
    """Nodes of a page that leaves out no end tag, as (level, tag, attributes, text) in order."""

    def __init__(self, html):
        super().__init__()
        self.level, self.nodes = 0, []
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        own = {}
        for k, v in attrs:
            own.setdefault(k, v or "")
        self.nodes.append((self.level, tag, own, None))
        self.level += tag not in tree.VOID

    def handle_endtag(self, tag):
        self.level -= tag not in tree.VOID

    def handle_data(self, data):
        if self.nodes and self.nodes[-1][:2] == (self.level, TEXT):
            data = self.nodes.pop()[3] + data
        self.nodes.append((self.level, TEXT, None, data))


def written(rng, depth=0):
    """A random piece of HTML with all its end tags."""
    out = []
    for _ in range(rng.randint(0, 4)):
        kind = rng.random()
        if kind < 0.35 or depth > 5:
            out.append(escape("".join(rng.choice("ab é&<>\"'\n ;") for _ in range(rng.randint(1, 8)))))
        elif kind < 0.45:
            out.append(rng.choice(["<br>", "<IMG src=x/y>", "<hr class='a b'>", "<!-- <p> -->", "<input disabled>", '<a href="?a&amp;b>c">', "</i>"]).replace('<a href="?a&amp;b>c">', '<a href="?a&amp;b>c"></a>').replace("</i>", "<i></i>"))
        else:
            tag = rng.choice(["div", "SPAN", "b", "section", "ul", "em"])
            attributes = rng.choice(["", " id=x1", ' class="k  l"', " data-v='a \"q\" b' title=z", ' TITLE="&eacute;" title=second'])
            out.append(f"<{tag}{attributes}>{written(rng, depth + 1)}</{tag.lower()}>")
    return "".join(out)


def listed(html):
    t = Nodes(html)
    return [(lv, tag, a, x) for lv, tag, a, x in zip(t.level, t.tag, t.attributes, t.text, strict=True)]


def joined(nodes):
    """Neighbouring texts (a comment may stand between) as one."""
    out = []
    for n in nodes:
        if out and n[1] == TEXT and out[-1][:2] == n[:2]:
            out[-1] = (*n[:3], out[-1][3] + n[3])
        else:
            out.append(n)
    return out


def test_equals_a_plain_parser():
    rng = random.Random(2)
    for _ in range(600):
        html = written(rng)
        assert joined(listed(html)) == joined(Plain(html).nodes), html


def test_intervals_parents_and_places():
    rng = random.Random(4)
    for _ in range(200):
        t = Nodes(written(rng))
        n = len(t.tag)
        for i in range(n):
            inside = []
            for j in range(n):
                up = t.parent[j]
                while up is not None and up != i:
                    up = t.parent[up]
                if up == i:
                    inside.append(j)
            assert inside == list(range(i + 1, t.last[i] + 1))
        for p in {None, *range(n)}:
            own = [i for i in range(n) if t.parent[i] == p and t.tag[i] != TEXT]
            assert [t.place[i] for i in own] == list(range(1, len(own) + 1))


def shape(html):
    """Nested lists of tags and texts."""
    t = Nodes(html)
    made = {None: []}
    for i, tag in enumerate(t.tag):
        own = t.text[i] if tag == TEXT else [tag]
        made[t.parent[i]].append(own)
        made[i] = own
    return made[None]


@pytest.mark.parametrize("html,want", [
    ("<p>a<p>b<div>c</div>", [["p", "a"], ["p", "b"], ["div", "c"]]),
    ("<p><b>a<p>b", [["p", ["b", "a"]], ["p", "b"]]),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e", [["ul", ["li", "a"], ["li", "b", ["ul", ["li", "c"]]], ["li", "d"]], "e"]),
    ("<dl><dt>a<dd>b<dt>c</dl>", [["dl", ["dt", "a"], ["dd", "b"], ["dt", "c"]]]),
    ("<table><thead><tr><th>a<tbody><tr><td>b<td>c<tr><td>d</table>", [["table", ["thead", ["tr", ["th", "a"]]], ["tbody", ["tr", ["td", "b"], ["td", "c"]], ["tr", ["td", "d"]]]]]),
    ("<table><tr><td>a<table><tr><td>b</table>c<td>d</table>", [["table", ["tr", ["td", "a", ["table", ["tr", ["td", "b"]]], "c"], ["td", "d"]]]]),
    ("<table><tr><td><p>a</div></span>b</td></tr></table>", [["table", ["tr", ["td", ["p", "ab"]]]]]),
    ("<div>a</p></span>b</div>c", [["div", "ab"], "c"]),
    ("<script>if (a < b) '</p>'</SCRIPT >x<style><b></style>", [["script"], "x", ["style"]]),
    ("<title>a <b> &amp; c</title>", [["title", "a <b> & c"]]),
    ("<script>never ends <p>", [["script"]]),
    ("a < b <3 &lt; &ccedil;&#233;&#xe9;", ["a < b <3 < çéé"]),
    ("<!-- open", []), ("", []), ("<", ["<"]), ("<a", ["<a"]), ("<a href='x>y", ["<a href='x>y"]),
])
def test_shapes(html, want):
    def join(nodes):
        out = []
        for n in nodes:
            n = [n[0], *join(n[1:])] if isinstance(n, list) else n
            if out and isinstance(n, str) and isinstance(out[-1], str):
                out[-1] += n
            else:
                out.append(n)
        return out

    assert join(shape(html)) == want


def painted(rows):
    """Grid of rows of (text, rowspan, colspan), painted place by place."""
    out = {}
    for r, cells in enumerate(rows):
        c = 0
        for text, down, wide in cells:
            while any(k[:2] == (r, c) for k in out):
                c += 1
            for rr in range(r, min(r + down, len(rows))):
                for cc in range(c, c + wide):
                    out.setdefault((rr, cc, text), (rr, cc) == (r, c))
            c += wide
    return sorted((r, c, t, first) for (r, c, t), first in out.items())


def test_grids_are_as_painted(spark):
    rng = random.Random(8)
    pages, want = [], []
    for p in range(120):
        rows, n = [], 0
        for _ in range(rng.randint(0, 5)):
            row = []
            for _ in range(rng.randint(0, 4)):
                n += 1
                row.append((f"{p}.{n}", rng.choice([1, 1, 1, 2, 3, 9]), rng.choice([1, 1, 2, 3])))
            rows.append(row)
        body = "".join("<tr>" + "".join(f'<td rowspan="{d}" colspan={w}> {t} </td>' for t, d, w in row) + "</tr>" for row in rows)
        pages.append((p, f"<div><table>{body}</table></div>"))
        want += [(p, *x) for x in painted(rows)]
    docs = spark.createDataFrame(pages, "id int, page string")
    got = tree.grid(tree.nodes(docs, "id", "page"), "id").select("id", "row", "col", "value", "origin").collect()
    assert sorted(map(tuple, got)) == sorted(want)


HTML = """<div class="a  badge b" id=main><p>one<ul><li>x<li>y<ul><li>z</ul></ul></div><div class=badgeless><ul><li>q</ul></div>
<table><tr><th>Papel<th>Valor base<th>Valor<tr><td>m<td>9<td>8<tr><td>n</table><table><tr><td>no header<tr><td>1</table>"""


def test_selectors(spark):
    pages = spark.createDataFrame([(1, HTML), (2, HTML), (3, None), (4, "")], "id long, h string")
    t = tree.nodes(pages, "id", "h")
    assert {r.id for r in t.select("id").distinct().collect()} == {1, 2}

    def said(steps):
        found = tree.path(t, "id", steps)
        return [(r.id, r.said) for r in tree.texts(t, "id", found, "said").orderBy("id", "pre").collect()]

    badge = element(cls="badge")
    assert said([badge, element("li")]) == [(i, s) for i in (1, 2) for s in ("x", "y z", "z")]
    assert said([badge, element("ul"), ">", element("li"), ">", element("ul")]) == [(1, "z"), (2, "z")]
    assert said([badge, ">", element("li")]) == []
    assert said([element(id="main"), element(["p", "b"])]) == [(1, "one"), (2, "one")]
    nearest = tree.nearest(t.filter(element("li")), "id", t.filter(element("ul")), "list")
    assert nearest.filter("id = 1").select("list").distinct().count() == 3
    follows = tree.next_element(t, "id", t.filter(element("p")), "after")
    assert [r.tag for r in follows.filter("id = 1").collect()] == ["ul"]
    got = tree.records(tree.grid(t, "id"), "id", {"role": ["cargo", "papel"], "pay": ["valor"], "other": ["none"]}).orderBy("id", "row").collect()
    assert [(r.id, r.row, r.role, r.pay, r.other) for r in got] == [(i, n, a, b, None) for i in (1, 2) for n, a, b in ((1, "m", "8"), (2, "n", None))]


def test_no_pages(spark):
    none = spark.createDataFrame([], "id string, h string")
    t = tree.nodes(none, "id", "h")
    assert t.count() == tree.grid(t, "id").count() == tree.labelled(t, "id").count() == 0


def test_deep_and_long():
    deep = Nodes("<div>" * 3000 + "x")
    assert deep.level[-1] == 3000 and deep.last[0] == 3000
    flat = Nodes("<p>x" * 50_000)
    assert len(flat.tag) == 100_000 and max(flat.level) == 1


def test_tables_over_many_batches(spark):
    """Tables larger and smaller than a batch; places go back in few batches."""
    pages = [(k, "<table>" + "".join(f"<tr><td>{k}<td colspan=2>{i}" for i in range(n)) + "</table>") for k, n in enumerate([1, 6000, 2, 0, 3, 9000])]
    got = tree.grid(tree.nodes(spark.createDataFrame(pages, "k int, html string"), "k", "html"), "k").collect()
    want = [(k, r, c, str(k) if c == 0 else str(r)) for k, n in enumerate([1, 6000, 2, 0, 3, 9000]) for r in range(n) for c in range(3)]
    assert sorted((x.k, x.row, x.col, x.value) for x in got) == want


def test_batches_stay_small():
    import pyarrow as pa

    one = pa.RecordBatch.from_arrays([pa.array(range(4000)), pa.array(["<p>a<p>b<p>c"] * 4000)], ["k", "h"])
    assert max(b.num_rows for b in tree._batches(iter([one]), pa.int64())) <= 8200
    cells = pa.RecordBatch.from_pylist([{"k": k // 3, "table": 0, "pre": 1 + k % 3, "tag": ["tr", "td", TEXT][k % 3], "row": [None, 1, 1][k % 3], "cell": [None, None, 2][k % 3], "text": [None, None, "x"][k % 3], "rowspan": 1, "colspan": 1} for k in range(3000)])
    out = list(tree._laid_out(iter([cells.slice(0, 1000), cells.slice(1000)])))
    assert [b.num_rows for b in out] == [1000] and set(out[0].column("value").to_pylist()) == {"x"}
