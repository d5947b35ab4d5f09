import zlib

import numpy as np
import pyarrow as pa
import pytest

from prumo.llm import token_store
from prumo.llm.wavelet import WaveletMatrix, read_shard, write_shard

public_tokenizers = pytest.importorskip("public_tokenizers")
TEXTS = ["Hello world", None, "", " ", "a  b   c ", "x\n  y\n\n z\n", "it's  we'll", "<|endoftext|> a <|endoftext|>", "café 　 naïve x", "tab\t end   z", "end \x1c z", " lead", "trail ", "a", "\n", "\U0001f600 \U0001f600", "12 345 6!! ??", "a.b,c\n\nd\ne \nf", "\nx\n", "\n\ny", "don't we'll's x'sy (é) é, ×, ÷. ß—,", "a,", ",", "é", "x\n", "9.5%\t", "..a..1.. .b"]


def _tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def _ids(text):
    return [*_tokenizer().encode(text or "", add_special_tokens=False).ids, 2]


def test_encoder_equals_the_tokenizer():
    enc = token_store.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    for _ in range(2):  # the second time from what is kept
        ids, sizes = enc.encode(pa.array(TEXTS))
        assert [p.tolist() for p in np.split(ids, np.cumsum(sizes)[:-1])] == [_ids(t) for t in TEXTS]


@pytest.mark.parametrize("n,top", [(0, 5), (1, 1), (1000, 1), (5000, 700), (513, 70000)])
def test_wavelet_matrix(n, top):
    ids = np.random.default_rng(n).integers(0, top, n)
    lengths = np.array([n // 2, n - n // 2])
    docs, m = read_shard(write_shard([None, 7], lengths, ids))
    assert docs["null"].tolist() == [1, 0] and docs["length"].tolist() == lengths.tolist()
    assert m.decode().tolist() == ids.tolist()
    for i in range(0, n, max(1, n // 40)):
        assert m.access(i) == ids[i]
        assert m.rank(int(ids[i]), i) == (ids[:i] == ids[i]).sum()
        assert m.select(int(ids[i]), m.rank(int(ids[i]), i)) == i
    if n:
        assert m.occurrences(int(ids[0])) == np.flatnonzero(ids == ids[0]).tolist()
    assert m.count(99999) == 0


def test_encoder_on_random_texts():
    rng = np.random.default_rng(1)
    enc = token_store.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    letters = list("ab1 \n\n  ..,'sé×\t-|<\u00a0")
    texts = ["".join(rng.choice(letters, rng.integers(0, 30))) for _ in range(3000)]
    ids, sizes = enc.encode(pa.array(texts))
    for t, p in zip(texts, np.split(ids, np.cumsum(sizes)[:-1])):
        assert p.tolist() == [*enc.tokenizer.encode(t, add_special_tokens=False).ids, 2], repr(t)


def test_round_trip(spark):
    rows = [(k if k != 3 else None, t) for k, t in enumerate(TEXTS)] + [(100 - k, f"text number {k} " * k) for k in range(60)] + [(5, "again"), (5, "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = [tuple(r) for r in token_store.tokens(docs).collect()]
    want, start = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = _ids(text)
        want.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(got, key=lambda r: r[1]) == want


def test_empty(spark):
    assert token_store.tokens(spark.createDataFrame([], "doc_id long, text string")).collect() == []
