"""Periodic runs against trying every start and period."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from prumo.llm import periodic_runs as pr
from prumo.llm import queries
from tests.llm.test_sql_queries import SMALL, odd_texts


def brute(seq) -> list[tuple[int, int, int]]:
    """(start, length, period) of all maximal runs of two periods at least."""
    out = []
    for q in range(1, len(seq) // 2 + 1):
        i = 0
        while i + q < len(seq):
            j = i
            while j + q < len(seq) and seq[j] == seq[j + q]:
                j += 1
            length, part = j + q - i, seq[i : j + q]
            if length >= 2 * q and not any(part[d:] == part[:-d] for d in range(1, q)):
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def some_sequences(rng):
    for _ in range(rng.randint(0, 4)):
        k, n, kind = rng.choice([1, 2, 2, 3, 4]), rng.randint(0, 60), rng.random()
        if kind < 0.5:
            yield [rng.randrange(k) for _ in range(n)]
        elif kind < 0.8:
            part = [rng.randrange(k) for _ in range(rng.randint(1, 9))]
            one = [rng.randrange(k) for _ in range(rng.randint(0, 9))] + (part * 9)[:n] + [rng.randrange(k) for _ in range(rng.randint(0, 9))]
            yield one * rng.choice([1, 1, 2])
        else:
            a, b = [0], [0, 1]
            while len(b) < n:
                a, b = b, b + a
            yield b


def test_runs_equal_brute_force():
    rng = random.Random(5)
    for _ in range(700):
        seqs = list(some_sequences(rng))
        offsets = np.cumsum([0, *map(len, seqs)])
        got = pr.runs(np.array([x for s in seqs for x in s], np.uint64), offsets)
        want = [(s + o, n, q) for seq, o in zip(seqs, offsets.tolist(), strict=False) for s, n, q in brute(seq)]
        assert list(zip(*(x.tolist() for x in got), strict=True)) == want


def test_blocks_begin_earlier():
    rng = random.Random(9)
    for _ in range(200):
        seq = [rng.randrange(rng.choice([1, 2, 3])) for _ in range(rng.randint(1, 50))]
        starts = pr.lz_blocks(pr.SuffixOrder(np.array(seq, np.uint64), np.array([0, len(seq)]))).tolist()
        at, want = 0, []
        while at < len(seq):
            want.append(at)
            longest = max((next((k for k in range(len(seq) - at) if seq[i + k] != seq[at + k]), len(seq) - at) for i in range(at)), default=0)
            at += max(1, longest)
        assert starts == want


@pytest.mark.parametrize("seq,want", [([0] * 20000, (0, 20000, 1)), (list(range(3000)) * 7, (0, 21000, 3000)), ([0, 1] * 9999 + [0], (0, 19999, 2))])
def test_long(seq, want):
    assert list(zip(*(x.tolist() for x in pr.runs(np.array(seq, np.uint64), np.array([0, len(seq)]))), strict=True)) == [want]


def plain(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = [r for r in brute(words) if r[1] >= max(6, 4 * r[2])]
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None,) * 3)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    milli = 1000 * best[1] // best[2] if runs else None
    return (doc_id, len(runs), *best, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


COLUMNS = "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()


def test_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(3)
    texts = [t for t in odd_texts() if t is None or len(t) < 20000] + [" ".join(str(x) for s in some_sequences(rng) for x in s) for _ in range(150)]
    rows = [(None if k % 40 == 7 else k // 2 * 7, t, "x") for k, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, runs string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op12_periodic_runs(spark, str(tmp_path)).select(*COLUMNS).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr(plain(d, t)) for d, t, _ in rows)


def test_query_on_given_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").filter("length(text) < 6000").collect()
    got = {r.doc_id: tuple(r) for r in queries.op12_periodic_runs(spark, SMALL).select(*COLUMNS).collect()}
    assert all(got[d] == plain(d, t) for d, t in docs)
    assert any(r[1] for r in got.values())


def test_operator(spark):
    docs = spark.createDataFrame([(1, "a b a b a c c c", 5), (2, None, 6), (None, "x", 7)], "doc_id long, text string, n_words int")
    got = {r.doc_id: (r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in pr.periodic_runs(docs, 3, 2).collect()}
    assert got == {1: (8, [(0, 5, 2), (5, 3, 1)], "a b c"), 2: (0, [], ""), None: (1, [], "x")}
    assert pr.periodic_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        pr.periodic_runs(docs, least_exponent=1)
