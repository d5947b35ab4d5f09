"""Counts of every prefix against the library that encodes each prefix."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from prumo.llm import queries, token_counts
from tests.llm.test_sql_queries import SMALL, odd_texts

pytest.importorskip("sentencepiece")
pytest.importorskip("public_tokenizers")
TEXTS = ["", None, " ", "  ", "a", " a", "a  b ", "\n", "\n\n a", "é", "ﬁ Å", "\x00a", "<s>", "</s> x", "▁a", "a▁▁b", "a　b", "a\tb", "​", "<0x0A>", "<unk>", " " * 40 + "x", "x" + " " * 37, "日本語のテキスト 한국어 \U0001f600\U0001f600", "a" * 22, "the unhappiness", "        def f(x):\n            return  x", "=====---------****"]


def random_texts(n):
    rng = random.Random(n)
    parts = ["a", "e", "t", "h", " ", "  ", "▁", "\n", "1", "é", "日", "ж", "о", ".", ",", "\U0001f600", "the", " of", "ing", "=", "-", "ß", "x\t"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(n)] + ["".join(chr(rng.choice([rng.randint(32, 126), rng.randint(160, 1200), rng.randint(1, 0xD7FF)])) for _ in range(12)) for _ in range(n // 2)]


@pytest.fixture(scope="module")
def counter():
    return token_counts.PrefixCounter(token_counts.model_path())


def prefixes(counter, text):
    return [len(counter.library.encode((text or "")[:k])) for k in range(len(text or "") + 1)]


def test_every_prefix_equals_the_library(counter):
    texts = TEXTS + random_texts(400)
    for _ in range(2):  # the second time from what is kept
        values, offsets = counter.counts(pa.array(texts))
        for k, t in enumerate(texts):
            assert values[offsets[k] : offsets[k + 1]].tolist() == prefixes(counter, t), t


def test_units_are_solved_by_the_recurrence(counter):
    """The library only confirms: no unit of the given texts or of random ones is left to it."""
    own = token_counts.PrefixCounter(token_counts.model_path())
    for unit in {w for t in random_texts(300) for w in t.replace(" ", token_counts.BLANK).split("\n") if w}:
        last, count = [-1], [0]
        assert own._solve(unit, last, count)
        assert count[-1] == len(own.library.encode(f"\n{unit}")) - 2


def test_what_cannot_be_solved_is_left_to_the_library(monkeypatch):
    own = token_counts.PrefixCounter(token_counts.model_path())
    monkeypatch.setattr(own, "_solve", lambda *a: False)
    own.MOST = 3  # and nothing is kept for long
    for texts in (TEXTS, TEXTS[::-1]):
        values, offsets = own.counts(pa.array(texts))
        assert [values[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)] == [prefixes(own, t) for t in texts]


def test_units_of_one_hash(monkeypatch, counter):
    own = token_counts.PrefixCounter(token_counts.model_path())
    spans = token_counts.hash_spans

    def few(buf, starts, ends):
        out = spans(buf, starts, ends)
        return out._replace(hashes=out.hashes % 5)

    monkeypatch.setattr(token_counts, "hash_spans", few)
    texts = ["the unhappiness of the many", "another extraordinary text", None, "abcdefghijkl abcdefghijkm"]
    values, offsets = own.counts(pa.array(texts))
    assert [values[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)] == [prefixes(counter, t) for t in texts]


def test_query_equals_the_library(spark, counter, tmp_path):
    texts = [*odd_texts(), *TEXTS]
    rows = [(None if k == 3 else k // 2, t, t) for k, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, n_bytes string").write.parquet(f"{tmp_path}/documents.parquet")
    small = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    for folder, want in ((str(tmp_path), rows), (SMALL, small)):
        n = [(d, len((t or "").encode()), len(counter.library.encode(t or ""))) for d, t, *_ in want]
        got = queries.op11_token_counts(spark, folder).select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()
        assert sorted(map(repr, map(tuple, got))) == sorted(repr((*x, x[2] > 4096)) for x in n)


def test_budgets(spark, counter):
    docs = spark.createDataFrame([(1, "the unhappiness of many", 3), (2, None, 4), (3, "", 5), (4, "é" * 9, 6), (None, "x", 7)], "doc_id long, text string, n_tokens int")
    for budget in (0, 1, 2, 3, 100):
        got = {r.doc_id: (r.text, r.n_tokens) for r in token_counts.truncate(docs, budget).collect()}
        for d, t, _ in docs.filter("doc_id is not null").collect():
            all_ = prefixes(counter, t)
            k = max(k for k, c in enumerate(all_) if c <= budget)
            assert got[d] == (None if t is None else t[:k], all_[k])
    counts = token_counts.prefix_counts(docs)
    assert counts.filter("doc_id = 1").select(token_counts.tokens_of(F.col("counts"), F.lit(5))).first()[0] == prefixes(counter, "the unhappiness of many")[5]
    assert token_counts.prefix_counts(docs.limit(0)).count() == 0
