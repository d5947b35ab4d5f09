import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pytest

from prumo.llm import hmm_lm as H


def small_model(seed=0, k=3, v=5):
    rng = np.random.default_rng(seed)
    norm = lambda x: x / x.sum(axis=-1, keepdims=True)
    return norm(rng.random((k, v))).T, H.Chain(norm(rng.random(k)), norm(rng.random((k, k))))


def test_likelihood_is_the_sum_over_all_paths():
    emit, chain = small_model()
    texts = [[0], [1, 2], [4, 4, 0, 1], [2, 3, 1, 0, 2, 2]]
    codes, offsets = np.concatenate(texts), np.cumsum([0, *map(len, texts)])
    want = []
    for t in texts:
        total = 0.0
        for path in itertools.product(range(3), repeat=len(t)):
            p = chain.start[path[0]] * emit[t[0], path[0]]
            for a, b, w in zip(path, path[1:], t[1:]):
                p *= chain.step[a, b] * emit[w, b]
            total += p
        want.append(math.log10(total))
    assert np.allclose(H.log10_likelihood(codes, offsets, emit, chain), want)


def test_long_texts_are_exact(monkeypatch):
    emit, chain = small_model(1)
    codes = np.random.default_rng(2).integers(0, 5, 3000)
    offsets = np.array([0, 1500, 3000])
    long = H.log10_likelihood(codes, offsets, emit, chain)
    monkeypatch.setattr(H, "_LONG", 10_000)
    assert np.allclose(long, H.log10_likelihood(codes, offsets, emit, chain))


def test_baum_welch_raises_the_likelihood():
    emit, chain = small_model(3)
    codes = np.random.default_rng(4).integers(0, 5, 600)
    codes[::3] = 1
    offsets = np.arange(0, 601, 60)
    before = -math.inf
    for _ in range(6):
        now = H.log10_likelihood(codes, offsets, emit, chain).sum()
        assert now >= before - 1e-9
        before = now
        per, moves, starts = H.expect(codes, offsets, emit, chain)
        assert np.isclose(per.sum(), 600) and np.isclose(moves.sum(), 590) and np.isclose(starts.sum(), 10)
        emit, chain = (per / per.sum(axis=0)), H.Chain(starts / starts.sum(), moves / moves.sum(axis=1, keepdims=True))


def test_emissions_sum_to_one():
    share = np.random.default_rng(1).dirichlet(np.ones(4), 30)
    count = np.arange(1.0, 31.0)
    per = (share * count[:, None]).sum(axis=0)
    known = H.emissions(share, count, per, count.sum(), 30.0).sum(axis=0)
    unknown = H.emissions(share[:1], np.zeros(1), per, count.sum(), 30.0)[0]
    assert np.allclose(known + unknown, 1)


def base(rows):
    words = lambda t: [w.decode() for w in (t or "").encode().lower().split()] + [None]
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 5 == 1
    count = Counter(w for d, t in rows if not held(d) for w in words(t))
    total, kinds = sum(count.values()), len(count)
    return [(d, held(d), len(words(t)), sum(count[w] > 0 for w in words(t)), total, sum(math.log10((count[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in words(t))) for d, t in rows]


@pytest.mark.parametrize("rows", [[(1, "a b a"), (2, "B c"), (3, None), (4, ""), (None, "a d"), (5, "É x"), (5, "É x"), (7, "x " * 3000)], [(k, f"w{k % 7} the w{k % 3}") for k in range(80)]])
def test_base_columns_equal_brute_force(spark, rows):
    got = sorted((tuple(r) for r in H.score(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()), key=str)
    want = sorted(base(rows), key=str)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want])
    assert all(g[6] < 0 for g in got)


def test_states_help_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = H.score(docs).filter("held_out").selectExpr("sum(score) s", "sum(base_score) b").first()
    assert got.s > got.b


def test_empty(spark):
    assert H.score(spark.createDataFrame([], "doc_id long, text string, score string")).collect() == []


def held_out_score(docs, **how):
    return H.score(docs, **how).filter("held_out").selectExpr("sum(score) s").first().s


def test_rounds_raise_the_likelihood(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model, history = H.train(docs.selectExpr("cast(doc_id as long) doc_id", "text"), rounds=4)
    assert len(history) > 1 and all(b >= a for a, b in zip(history, history[1:]))
    assert np.allclose(model.chain.step.sum(axis=1), 1) and np.isclose(model.chain.start.sum(), 1)
    scores = [held_out_score(docs, rounds=r) for r in (0, 1, 3)]
    assert scores[0] <= scores[1] <= scores[2]


def test_counts_beyond_32_bits():
    n, k, words = 3, 2, np.array([1, 2, 3], np.uint64)
    counts, share = np.array([6_000_000_000, 1, 0], np.int64), np.array([[0.25, 0.75], [1, 0], [0, 0]])
    blob = words.tobytes() + H._zip(counts.tobytes() + H._planes(share))
    import pyarrow as pa

    table = pa.table({"chunk": pa.array([1, 2]), "bucket": pa.array([0, 0], pa.int32()), "n": pa.array([n, n], pa.int32()), "blob": pa.array([blob, blob], pa.binary()), "moves": pa.array([[1.0] * 6, None], pa.list_(pa.float64()))})
    got = H._answers(k)(table).to_pylist()
    assert got[-1]["sums"][:2] == [12_000_000_002, 2] and np.allclose(got[-1]["sums"][2:4], [3_000_000_002, 9_000_000_000]) and got[-1]["sums"][4:] == [1.0] * 6
    raw = H._unzip(got[0]["blob"])
    assert np.frombuffer(raw, np.int64, n).tolist() == [12_000_000_000, 2, 0]
    assert np.allclose(H._shares(raw[8 * n :], n, k), share)


def test_small_shares_do_not_vanish():
    share = np.array([[1e-6, 1 - 1e-6]])
    assert np.allclose(H._shares(H._planes(share), 1, 2).astype(float), share, rtol=0.1)


@pytest.mark.parametrize("chunk", [1, 200, 1 << 24])
def test_score_equals_a_plain_model(spark, monkeypatch, chunk):
    """The last round and the scores against a plain computation from the same tied model, in one piece and in many."""
    import pyarrow as pa

    rng = np.random.default_rng(5)
    rows = [(i, " ".join(rng.choice(["a", "b", "c", "D", "e", "f"], rng.integers(0, 9)))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    model, _ = H.train(docs, states=3, rounds=2)
    learn = [t for d, t in rows if not H.is_held_out(d)]
    hashes, offsets = H.tokens(pa.record_batch({"text": learn}))
    words, codes = np.unique(hashes, return_inverse=True)
    per, moves, starts = H.expect(codes, offsets, H.tied_emissions(model)[H.word_class(words)].astype(float), model.chain)
    counts = np.bincount(codes).astype(float)
    emit = H.emissions(per / counts[:, None], counts, per.sum(axis=0), counts.sum(), float(len(words)))
    emit = np.concatenate([emit, np.full((1, 3), 0.5 / (counts.sum() + 0.5 * (len(words) + 1)))])
    chain = H.Chain(H._normal(starts, 0.5), H._normal(moves, 0.5))
    want = {}
    for d, t in rows:
        own, _ = H.tokens(pa.record_batch({"text": [t]}))
        at = np.minimum(np.searchsorted(words, own), len(words) - 1)
        a, total = chain.start, 0.0
        for k, w in enumerate(np.where(words[at] == own, at, len(words))):
            a = (a @ chain.step if k else a) * emit[w]
            total += math.log10(a.sum())
            a = a / a.sum()
        want[d] = total
    monkeypatch.setattr(H, "CHUNK", chunk)
    got = {r.doc_id: r.score for r in H.score(docs, states=3, rounds=2).collect()}
    assert set(got) == set(want) and all(abs(got[d] - want[d]) < 5e-3 * abs(want[d]) for d in want)
