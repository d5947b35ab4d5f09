"""Words that collide under polynomial hashes modulo 2**64, whatever the base, are told apart by every operator."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest

from prumo.llm import common as C
from prumo.llm import hmm_lm, ngram_join, substring_dedup, token_store


def thue_morse(n: int) -> tuple[str, str]:
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


WORDS = [w for n in (1024, 2048, 4096) for w in thue_morse(n)]


def test_hashes_differ():
    for seed in (0, 1):
        assert len(set(C.hash_words(pa.array(WORDS), lower=True, seed=seed).hashes.tolist())) == len(WORDS)
    assert not set(C.hash_words(pa.array(WORDS), True, 0).hashes.tolist()) & set(C.hash_words(pa.array(WORDS), True, 1).hashes.tolist())


def test_equal_spans_have_equal_hashes_wherever_they_stand():
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcé"), rng.integers(1, 30))) for _ in range(500)]
    text = " \n".join(words) + "\t" + " ".join(reversed(words))
    hashes = C.hash_words(pa.array(["x", text, None, text]), lower=False)
    got = dict(zip([w for _ in range(2) for w in [*words, *reversed(words)]], hashes.hashes[1:].tolist(), strict=True))
    assert len(set(got.values())) == len(set(words))
    assert hashes.hashes[1 : 1 + 1000].tolist() == hashes.hashes[1001:].tolist() == [got[w] for w in [*words, *reversed(words)]]


def test_windows_are_bounded():
    with pytest.raises(ValueError):
        C.windows(np.zeros(2000, np.uint64), 513)


def test_sets_differ():
    a, b = ngram_join.shingle_sets(pa.record_batch({"text": [WORDS[0], WORDS[1]]}), 4)
    assert a.tolist() != b.tolist()


def test_encoder_keeps_them_apart():
    enc = token_store.Encoder(pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json"))
    ids, sizes = enc.encode(pa.array(WORDS))
    for text, own in zip(WORDS, np.split(ids, np.cumsum(sizes)[:-1]), strict=True):
        assert own.tolist() == [*enc.tokenizer.encode(text, add_special_tokens=False).ids, 2]


def test_encoder_compares_bytes(monkeypatch):
    """With all hashes of a size equal, pieces are still told apart."""
    enc = token_store.Encoder(pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json"))
    real = C.hash_spans

    def poor(buf, starts, ends, seed=0):
        out = real(buf, starts, ends, seed)
        long = (ends - starts) > 8
        return out._replace(hashes=np.where(long, C.U64(7), out.hashes))

    monkeypatch.setattr(token_store, "hash_spans", poor)
    texts = ["one considerable difference", "incomprehensible considerable things", "considerable", None, "a considerable"]
    ids, sizes = enc.encode(pa.array(texts))
    for text, own in zip(texts, np.split(ids, np.cumsum(sizes)[:-1]), strict=True):
        assert own.tolist() == [*enc.tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def test_counts_differ(spark):
    rows = [(1, WORDS[0]), (2, WORDS[0]), (3, WORDS[1])]
    got = {r.doc_id: r.base_score for r in hmm_lm.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == pytest.approx(got[2]) and got[1] > got[3]


def test_windows_with_them_do_not_repeat(spark):
    around = [f"w{i}" for i in range(34)]
    rows = [(1, " ".join([*around, WORDS[0]])), (2, " ".join([*around, WORDS[1]]))]
    got = {r.doc_id: r for r in substring_dedup.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for doc, text in rows:
        assert got[doc].n_removed == 0 and got[doc].kept_sha256 == hashlib.sha256(text.encode()).hexdigest()
