"""Operators on small inputs with nulls, ties and repeats."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from prumo.functions import rules, text, values
from prumo.operators import canonical, consensus, lookup, resolve
from prumo.sources import html
from prumo.streaming import control


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_divergent_needs_three_and_one_mode(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "x", 2), ("a", "y", 3), ("b", "x", 4), ("b", "y", 5), ("c", "x", 6), ("c", "y", 7), ("c", "x", 8), ("c", "y", 9)], "k string, d string, id int")
    out = consensus.divergent(df, ["k"], "d").select("id", "mode", "histogram")
    assert rows(out) == [(3, "x", "2 x, 1 y")]


def test_fold_known_is_a_sequence_of_coalesces(spark):
    df = spark.createDataFrame([(1, 1, None, "p"), (1, 2, 5, None), (1, 3, 6, "q"), (2, 1, None, None)], "k int, o int, a int, b string")
    assert rows(canonical.fold_known(df, ["k"], [F.col("o")], ["a", "b"])) == [(1, 5, "p", 3), (2, None, None, 1)]


def test_upsert_dimension(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, name string, extra string")
    new = spark.createDataFrame([(2, None, None), (3, "c", "z")], "k int, name string, extra string")
    assert rows(canonical.upsert_dimension(old, new, ["k"], ["name"], ["extra"])) == [(1, "a", "x"), (2, None, "y"), (3, "c", "z")]


def test_first_seen(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 1)], "k string, o int")
    seen = spark.createDataFrame([("b",)], "k string")
    assert rows(lookup.first_seen(df, seen, ["k"], [F.col("o")], ["o"])) == [("a", 1)]


def test_folds_differ(spark):
    df = spark.createDataFrame([("  1º  São–Paulo ß ",)], "t string")
    assert df.select(text.fold_keep("t"), text.fold_ascii(F.col("t")), text.slug(F.col("t"))).first() == ("1º sao–paulo ß", "1o  saopaulo", "1o-saopaulo")


@pytest.mark.parametrize("raw,want", [("R$ 1.234,56", Decimal("1234.56")), ("1234,56", Decimal("1234.56")), ("até 900", Decimal("900.00")), ("a combinar", None), (None, None)])
def test_parse_brl(spark, raw, want):
    assert spark.createDataFrame([(raw,)], "t string").select(values.parse_brl(F.col("t"))).first()[0] == want


def test_dates(spark):
    df = spark.createDataFrame([("20/12 a 10/01/2026", "8 setembro 2026"), ("05/03/2025 a 10/03/2025", "31 de fevereiro de 2026"), ("x", None)], "p string, w string")
    got = [tuple(r) for r in df.select(*values.period(F.col("p")), values.date_words(F.col("w"))).collect()]
    assert got == [(dt.date(2025, 12, 20), dt.date(2026, 1, 10), dt.date(2026, 9, 8)), (dt.date(2025, 3, 5), dt.date(2025, 3, 10), None), (None, None, None)]


def test_rules(spark):
    df = spark.createDataFrame([("medico veterinario",), ("medica pediatra",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(rules.physician(F.col("t"))).collect()] == [False, True, False, False]


def test_code_hit_with_null_value_wins(spark):
    right = spark.createDataFrame([(1, "a", None), (2, "b", 7)], "code int, label string, v int")
    left = spark.createDataFrame([(1, "b"), (9, "b"), (9, "z")], "code int, label string")
    assert rows(resolve.code_then_name(left, right, "code", "label", "v")) == [(1, "b", None), (9, "b", 7), (9, "z", None)]


def test_longest_name(spark):
    texts = spark.createDataFrame([(1, "in belo horizonte and belo"), (2, "none"), (3, None)], "id int, t string")
    names = spark.createDataFrame([("belo",), ("belo horizonte",)], "name string")
    assert rows(resolve.longest_name(texts, "id", F.col("t"), names, "name", [1, 2])) == [(1, "belo horizonte", 2)]


def test_terms_are_found_in_one_pass_without_all_runs_of_a_text(spark):
    """Every run of words went to the join, from each place of each text; white space is ASCII only, as in Spark's expressions."""
    filler = " ".join(f"w{i} v{i % 7}" for i in range(2000))
    texts = spark.createDataFrame([(1, f"{filler} a\x0bb\n c {filler} a b c"), (2, "a\u00a0b c a\x1cb"), (3, None), (4, ""), (5, "b c"), (5, "x b c"), (None, "a b")], "id int, t string")
    terms = spark.createDataFrame([("a b",), ("a b c",), ("b c",), ("b c",), (None,), ("",), (" a",), ("v3",)], "term string")
    hits = resolve.known_grams(texts, ["id"], F.col("t"), terms, [2, 3])
    assert hits.count() <= 20
    at = {(r.id, r.gram): r.place for r in hits.filter("id <> 5").collect()}
    assert at[1, "a b"] == at[1, "a b c"] == 4001 and at[1, "b c"] == 4002
    assert (2, "a b") not in at and (2, "a b c") not in at
    assert rows(resolve.longest_name(texts, "id", F.col("t"), terms, "term", [2, 3])) == sorted([(1, "a b c", 4001), (5, "b c", 1), (None, "a b", 1)], key=repr)


def test_terms_against_all_runs(spark):
    """Terms of each length, against plain Python."""
    import random

    rng = random.Random(5)
    said = [" ".join(rng.choice("ab cd ef gé h".split()) for _ in range(rng.randint(0, 30))) for _ in range(60)]
    known = [" ".join(rng.choice("ab cd ef gé h".split()) for _ in range(rng.randint(1, 4))) for _ in range(25)]
    texts, terms = spark.createDataFrame(list(enumerate(said)), "id int, t string"), spark.createDataFrame([(t,) for t in known], "term string")
    want = []
    for i, text in enumerate(said):
        words = text.split()
        runs = [(-len(run), at + 1, run) for n in (1, 2, 3) for at in range(len(words) - n + 1) if (run := " ".join(words[at : at + n])) in known]
        if runs:
            size, at, run = min(runs)
            want.append((i, run, at))
    assert sorted(map(tuple, resolve.longest_name(texts, "id", F.col("t"), terms, "term", [1, 2, 3]).collect())) == want


def test_first_words_that_are_forgotten(monkeypatch):
    monkeypatch.setattr(resolve, "_REMEMBERED", 2)
    begins = resolve._Begins({"a", "a b", "d", "d e"}.__contains__)
    assert resolve._terms_in("x a b y z d e a b", begins, [2]) == {"a b": 2, "d e": 6}
    assert len(begins) <= 2


def test_html(spark):
    page = '<html><head><title> A b </title><script>x="<p>"</script></head><body><nav><a href="/n">n</a></nav><p>Cargo: Médico</p><p>cargo: Outro</p><table><tr><th>k</th></tr><tr><td>v <b>w</b></td></tr></table><a href="/n">n</a>&amp;</body></html>'
    df = spark.createDataFrame([(1, page), (2, None), (3, "")], "id int, h string")
    assert rows(html.links(df, "id", "h")) == [(1, 0, "/n")]
    assert rows(html.table_cells(df, "id", "h")) == [(1, 0, 0, "k"), (1, 1, 0, "v w")]
    first = df.select(html.title(F.col("h")), html.article_text(F.col("h")), html.labelled_values(F.col("h"))).first()
    assert tuple(first) == (" A b ", "Cargo: Médico cargo: Outro k v w n &", {"cargo": "Médico"})


def test_reread_margin(spark):
    df = spark.range(0, 20).withColumnRenamed("id", "n")
    seen = spark.createDataFrame([(10,), (8,)], "n long")
    assert [r[0] for r in control.reread(df, "n", seen, 3).orderBy("n").collect()] == [7, 9, *range(11, 20)]


def test_one_verdict_for_a_group(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 9), ("b", 3, 1), (None, 4, 7), (None, 5, 8)], "k string, id int, v int")
    got = consensus.verdict_for_all(df, ["k"], [F.col("id")], F.col("v") > 4, "fine")
    assert sorted((r.id, r.fine) for r in got.collect()) == [(1, True), (2, True), (4, True), (5, True)]
    assert consensus.verdict_for_all(df, ["k"], [F.col("id")], F.col("v") > 4, "fine", least=1).count() == 5


def test_anti_join_of_several_ways(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "c")], "id int, s string")
    other = spark.createDataFrame([(1, "z"), (9, "B"), (None, None)], "i int, t string")
    assert sorted(r.id for r in lookup.without_any(df, other, [[("id", F.col("i"))], [("s", F.lower("t"))]]).collect()) == [3, 4]


def test_windows_over_slices_equal_whole_ones(spark):
    import datetime as dt
    import random

    from prumo.streaming import control

    rng, at, rows = random.Random(2), dt.datetime(2024, 1, 1), []
    for i in range(600):
        at += dt.timedelta(seconds=rng.choice([0, 30, 900, 4000, 90_000 if i % 97 == 0 else 5]))
        rows.append((i, rng.choice("ab"), at, rng.choice([None, 1.0, 2.0, 7.0]), rng.random() < 0.6))
    df = spark.createDataFrame(rows, "id int, k string, ts timestamp, v double, bad boolean")
    for hours in (1, 3, 24):
        got = {r.id: r.s for r in control.rolling_sum(df, "k", "ts", "v", "'90' minute", "s", hours).collect()}
        for i, k, t, _, _ in rows:
            own = [v for _, j, u, v, _ in rows if j == k and t - dt.timedelta(minutes=90) <= u <= t and v is not None]
            assert got[i] == (sum(own) if own else None)
        islands, n, want = {}, {}, {}
        for i, k, t, _, bad in rows:
            if bad:
                want.setdefault((k, n.get(k, 0)), []).append(t)
            else:
                n[k] = n.get(k, 0) + 1
        islands = sorted((k, ts[0], ts[-1], len(ts)) for (k, _), ts in want.items() if len(ts) >= 2)
        assert sorted((r.k, r.started, r.ended, r.run_length) for r in control.runs(df, "k", ["ts", "id"], F.col("bad"), 2, "ts", hours).collect()) == islands
        price = {r.id: r.estimate for r in control.estimates(df, "k", ["ts", "id"], "v", 1.5, 3, hours=hours, rows=10).collect()}
        for i, k, *_ in rows:
            before = [v for j, h, _, v, _ in rows if h == k and j < i][-3:]
            assert price[i] == max([1.5, *(v for v in before if v is not None)])
