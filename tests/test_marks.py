"""Marks and what stands near them, against plain searches; both ways in which names meet texts; phrases against plain containment."""

import random

import pytest
from pyspark.sql import functions as F

from prumo.operators import marks, monitor, phrases


def plain_names(text, terms, whole):
    low = marks.fold(marks.flat(text or ""))
    out = []
    for id_, term in terms:
        term = marks.fold(marks.flat(term))
        at = low.find(term)
        while at >= 0:
            until = at + len(term)
            edge = lambda c: c.isascii() and c.isalnum()
            if not whole or not (at and edge(low[at - 1]) or until < len(low) and edge(low[until])):
                out.append((id_, at, until))
            at = low.find(term, at + 1)
    return sorted(out)


TEXTS = ["Maria da Silva, MARIA  DA\tSILVA e Ana Mariada Silva", None, "", "São João del Rei; sao joao", "İx maria da silva", "silva maria da silva maria da silva", "x" * 5000 + " maria da silva", "- " * 4000 + "maria da silva"]
TERMS = [(1, "Maria da Silva"), (2, "São João"), (3, "são joão del rei"), (4, "silva"), (5, "da"), (6, "Maria da Silva")]


@pytest.mark.parametrize("whole", [True, False])
@pytest.mark.parametrize("most", [0, 8 << 20])
def test_names(spark, monkeypatch, whole, most):
    monkeypatch.setattr(marks, "MOST_BYTES", most)
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "id int, at string")
    names = spark.createDataFrame([(i, "n", t) for i, t in TERMS] + [(7, "n", None), (8, "n", "  ")], "id int, kind string, term string")
    got = marks.marks(docs, "id", "at", {"rest": "joao"}, names, whole).collect()
    for k, text in enumerate(TEXTS):
        want = plain_names(text, TERMS, whole)
        assert sorted((r.id, r.at, r.until) for r in got if r.key == k and r.kind == "n") == want
        assert sum(r.key == k and r.kind == "rest" for r in got) == (marks.fold(text or "").count("joao") if want else 0)


def test_stems_and_what_is_near(spark):
    rng = random.Random(6)
    texts = ["".join(rng.choice(["ab", "cd", "x", " ", "Á", "zz "]) for _ in range(rng.randint(0, 400))) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "key int, text string")
    found = marks.marks(docs, "key", "text", {"anchor": "x+"}, stems={"s": ["ab", "bab"], "t": ["cd"]})
    rows = found.collect()
    for k, text in enumerate(texts):
        low = marks.fold(marks.flat(text))
        want = sorted((kind, i, i + len(s)) for kind, s in (("s", "ab"), ("s", "bab"), ("t", "cd")) for i in range(len(low)) if low.startswith(s, i))
        assert sorted((r.kind, r.at, r.until) for r in rows if r.key == k and r.kind != "anchor") == want
    at, until = F.col("at"), F.col("until")
    near = marks.beside(found.filter("kind = 'anchor'").select("key", "at", "until"), found, 20, {"s": marks.any_mark("s", at - 20, until + 15), "n": F.count_if((F.col("m_kind") == "t") & (F.col("m_at") >= at - 11) & (F.col("m_at") <= until + 20))})
    for r in near.collect():
        own = [m for m in rows if m.key == r.key]
        assert r.s == any(m.kind == "s" and m.at >= r.at - 20 and m.until <= r.until + 15 for m in own)
        assert r.n == sum(m.kind == "t" and r.at - 11 <= m.at <= r.until + 20 for m in own)


def test_intervals_become_one(spark):
    rng = random.Random(3)
    rows = [(k, a, a + rng.randint(0, 9)) for k in range(20) for a in (rng.randint(0, 80) for _ in range(rng.randint(1, 12)))]
    got = marks.coalesced(spark.createDataFrame(rows, "k int, lo int, hi int"), ["k"], "lo", "hi", "n").collect()
    for k in range(20):
        merged = []
        for _, lo, hi in sorted(r for r in rows if r[0] == k):
            if merged and lo <= merged[-1][1]:
                merged[-1] = [merged[-1][0], max(hi, merged[-1][1]), merged[-1][2] + 1]
            else:
                merged.append([lo, hi, 1])
        assert sorted([r.lo, r.hi, r.n] for r in got if r.k == k) == merged


def test_a_thousand_places_are_one_window(spark):
    text = "Convoca a candidata Maria da Silva, aprovada. " * 1000
    pubs = spark.createDataFrame([(1, "Ato", text), (2, None, "Maria da Silva")], "key int, title string, text string")
    watch = spark.createDataFrame([(5, "Maria da Silva", 3)], "watch int, name string, rank int")
    got = {r.key: (r.lo, r.places, r.place) for r in monitor.name_windows(pubs, watch).collect()}
    assert got == {1: (0, 1000, 20), 2: (0, 1, None)}


def test_statewide_gazettes(spark):
    texts = ["Convoca a candidata Maria da Silva para posse", "Convoca a servidora Maria da Silva", "Convoca a candidata Maria da Silva. Licença de João"]
    pubs = spark.createDataFrame([(i, "Ato", t, s) for i, t in enumerate(texts) for s in [i != 9]], "key int, title string, text string, statewide boolean")
    watch = spark.createDataFrame([(5, "Maria da Silva", None)], "watch int, name string, rank int")
    assert [r.key for r in monitor.watched_names(pubs, watch).collect()] == [0]
    assert sorted(r.key for r in monitor.watched_names(pubs.drop("statewide"), watch).collect()) == [0, 1, 2]


def test_phrases(spark):
    rng = random.Random(7)
    texts = [[rng.choice("abcd") for _ in range(rng.randint(0, 30))] for _ in range(40)]
    asked = [[rng.choice("abcde") for _ in range(rng.randint(0, 4))] for _ in range(60)]
    docs = spark.createDataFrame([(i, " ".join(t).upper()) for i, t in enumerate(texts)] + [(99, None)], "doc int, text string")
    wanted = spark.createDataFrame([(i, " ".join(p)) for i, p in enumerate(asked)], "p int, said string").withColumn("words", phrases.plain_words(F.col("said")))
    index = phrases.postings(docs, "doc", phrases.plain_words(F.col("text")))
    got = {tuple(r) for r in phrases.occurrences(index, "doc", wanted, "p", F.col("words")).collect()}
    want = {(i, d, s) for i, p in enumerate(asked) if p for d, t in enumerate(texts) for s in range(len(t)) if t[s : s + len(p)] == p}
    assert got == want
    by_phrase = {r.p: (r.doc, r.texts) for r in phrases.unique_text(index, "doc", wanted, "p", F.col("words")).collect()}
    for i in range(60):
        own = {d for j, d, _ in want if j == i}
        assert by_phrase[i] == (next(iter(own)) if len(own) == 1 else None, len(own))


@pytest.mark.parametrize("most", [0, 2, 5])
def test_sharing(spark, monkeypatch, most):
    monkeypatch.setattr(phrases, "MOST_SUBSETS", most)
    rng = random.Random(8)
    sets = {k: set(rng.sample("abcdefgh", rng.randint(1, 4))) for k in range(60)}
    own = spark.createDataFrame([(k, p) for k, s in sets.items() for p in s], "k int, p string")
    assert {tuple(r) for r in phrases.sharing(own, "k", "p", "n").collect()} == {(k, sum(bool(s & t) for t in sets.values())) for k, s in sets.items()}


def test_sharing_makes_no_pairs(spark):
    own = spark.range(20000).select(F.col("id").alias("k"), F.lit("a b").alias("p"))
    out = phrases.sharing(own, "k", "p", "n")
    assert out.filter("n = 20000").count() == 20000


def test_small_rows_are_dealt_out(spark, tmp_path):
    from prumo.plans import monitor as plans

    spark.range(4000).withColumnRenamed("id", "c_custkey").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    assert plans.people_of_customers(spark, str(tmp_path)).select(F.spark_partition_id()).distinct().count() == 4


def test_fold_is_character_by_character():
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x20000)]))
    assert marks.fold(every) == every.translate(marks._FOLDS)
    assert marks.fold("ΟΔΟΣ İx ÇÃO") == "οδοσ ix cao"


def test_ranks():
    import re

    slow = re.compile(r"(?<!\d)\d{1,5}\s*[ºo°ª](?!\w)|(?:classificacao|colocacao|lugar)\D{0,12}\d{1,5}")
    rng = random.Random(9)
    for _ in range(4000):
        text = "".join(rng.choice(["1", "23", "º", "o", "ª", " ", "classificacao", "colocacao", "lugar", "c", "l", "x", ": "]) for _ in range(rng.randint(0, 25)))
        assert [m.span() for m in re.finditer(monitor.NAME_MARKS["rank"], text)] == [m.span() for m in slow.finditer(text)]


def test_many_names_deal_out_no_texts(spark, monkeypatch):
    """Names beyond MOST_BYTES: only places meet names, so texts without any don't leave their scan; equal keys are texts of their own."""
    monkeypatch.setattr(marks, "MOST_BYTES", 0)
    docs = spark.createDataFrame([(1, "x " * 3000 + "(Ana) D'Ávila, 3º"), (1, "4º lugar"), (2, "ana 5º"), (3, None)], "id int, at string")
    names = spark.createDataFrame([(7, "n", " ana) d'avila"), (8, "n", "ana d'avila"), (9, "n", "avila")], "id int, kind string, term string")
    out = marks.marks(docs, "id", "at", {"rank": r"\d"}, names)
    got = sorted((r.key, r.kind, r.id or 0, r.at, r.before) for r in out.collect())
    assert got == [(1, "n", 7, 6001, None), (1, "n", 9, 6008, None), (1, "rank", 0, 6015, None)]
    assert "Generate" not in out._jdf.queryExecution().toString()


def test_few_phrases_deal_out_their_words_only(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc"), F.concat_ws(" ", F.lit("a b"), *(F.concat(F.lit(f"w{i}x"), "id") for i in range(20))).alias("text"))
    asked = spark.createDataFrame([(1, ["a", "b"]), (2, ["b", "a"])], "p int, words array<string>")
    index = phrases.postings(docs, "doc", phrases.plain_words(F.col("text")))
    out = phrases.occurrences(index, "doc", asked, "p", F.col("words"))
    assert {r.p: r["count"] for r in out.groupBy("p").count().collect()} == {1: 2000}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [word" not in plan and "BroadcastHashJoin [word" in plan


def test_excerpts_stay_out_of_joins_of_marks(spark):
    docs = spark.createDataFrame([(1, "Nomeia aprovado no concurso: médico. " * 2), (2, "Convoca os aprovados: pediatra."), (3, "Convoca.")], "key long, text string")
    out = monitor.physician_calls(docs)
    assert sorted((r.key, r.kind, r.excerpt[:16]) for r in out.collect()) == [(1, "nomeacao", "Nomeia aprovado "), (2, "convocacao", "Convoca os aprov")]
    plan = out.drop("excerpt")._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Aggregate [key" in line and "said" in line.split("],")[0]]
