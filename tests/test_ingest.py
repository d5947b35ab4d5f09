"""Sources, sinks and guards on small inputs with nulls, broken texts and repeats."""

import pytest
from pyspark.sql import functions as F

from prumo.functions import text, values
from prumo.operators import coverage, writes
from prumo.sources import feeds


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_columns_that_may_not_be_set(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, s string")
    with pytest.raises(ValueError, match="id"):
        writes.set_columns(df, F.lit(True), {"id": F.lit(3)}, {"s"})
    assert writes.set_columns(df, F.lit(True), {}, {"s"}) is df
    assert rows(writes.set_columns(df, F.lit(True), {"s": F.lit("b")}, {"s"}, only_null=True)) == [(1, "a"), (2, "b")]


def test_get_or_create_keeps_known_ids_and_null_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 2)], "name string, n int")
    known = spark.createDataFrame([("a", 1, "old")], "name string, n int, id string")
    got = {r.name: (r.id, r.created) for r in writes.get_or_create(df, known, ["name", "n"], "id").collect()}
    assert got["a"] == ("old", False) and got[None][1] and len(got[None][0]) == 16


def test_only_the_first_claim_owns(spark):
    df = spark.createDataFrame([(1, "k", 5), (2, "k", 4), (3, "j", 9)], "id int, k string, at int")
    assert rows(writes.claim(df, ["k"], [F.col("at"), F.col("id")], "id")) == [(1, False), (2, True), (3, True)]


def test_better_kinds_are_inserted_first(spark):
    df = spark.createDataFrame([(1, "topic", 1), (1, "name", 2), (1, "other", 0), (2, "other", 3)], "k int, kind string, at int")
    assert rows(writes.priority_insert(df, ["k"], "kind", ["name", "topic"], [F.col("at")], ["kind"])) == [(1, "name"), (2, "other")]


def test_fill_null_keeps_known_values(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, None)], "k int, v string")
    new = spark.createDataFrame([(1, "b"), (2, "c")], "k int, v string")
    assert rows(writes.fill_null(df, new, ["k"], "v").select("k", "v")) == [(1, "a"), (2, "c"), (3, None)]


def test_uncovered_only_where_something_is_covered(spark):
    df = spark.createDataFrame([("x", "MG"), ("y", "MG"), ("z", "SP")], "city string, uf string")
    seen = spark.createDataFrame([("x",), ("x",)], "city string")
    assert rows(coverage.uncovered(df, seen, ["city"], "uf").select("city")) == [("y",)]
    assert coverage.uncovered(df, seen.limit(0), ["city"], "uf").count() == 0


def test_broken_texts_give_no_rows(spark):
    df = spark.createDataFrame([(1, "<rss><channel><item><title>a</title></item></channel></rss>"), (2, "<rss><chan"), (3, None), (4, "")], "k int, x string")
    assert rows(feeds.rss_items(df, "k", "x").select("k", "title", "link")) == [(1, "a", None)]
    js = spark.createDataFrame([(1, '[{"a": 1}, {"a": null}, {"b": 2}]'), (2, '[["x"]]'), (3, "{"), (4, None), (5, "[]")], "k int, j string")
    assert rows(feeds.json_rows(js, ["k"], F.col("j"), "a int", "a")) == [(1, 1)]


@pytest.mark.parametrize("raw, want", [('```json\n{"a": "x\\d"}\n```', "x\\d"), ('{"a": "x\\n"}', "x\n"), ('{"a": "x\\\\d"}', "x\\d"), ("nothing", None)])
def test_repaired(spark, raw, want):
    got = spark.createDataFrame([(raw,)], "t string").select(F.get_json_object(feeds.repaired(F.col("t")), "$.a")).first()[0]
    assert got == want


@pytest.mark.parametrize("url, want", [("https://a.example.org/x", True), ("http://10.0.0.1/", False), ("http://u@a.example.org/", False), ("http://localhost/", False), ("http://x.internal", False), ("ftp://a.example.org", False), (None, False)])
def test_safe_url(spark, url, want):
    assert spark.createDataFrame([(url,)], "u string").select(text.safe_url(F.col("u"))).first()[0] is want


def test_values(spark):
    one = lambda c, s: spark.createDataFrame([(s,)], "t string").select(c(F.col("t"))).first()[0]
    assert str(one(values.strict_brl, "de R$ 1.234,50")) == "1234.50" and one(values.strict_brl, "R$ 50") is None
    assert one(values.deadline_days, "Prazo de três dias") == 3 and one(values.deadline_days, "prazo de muitos dias") is None
    assert str(one(values.date_mixed, "02/01/2024")) == "2024-01-02" and one(values.date_mixed, "31/02/2024") is None
    assert one(values.reserve_list, None) is False and one(values.reserve_list, "3 + cr") is True
    assert one(text.slug_variants, "São João do Sul") == ["sao-joao-do-sul", "saojoaodosul", "sao-joao-sul", "saojoaosul"]
