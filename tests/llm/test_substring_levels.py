"""More levels of doubling, smaller chunks and brute force give the same rows."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from prumo.llm import substring_dedup as S


def brute(rows, length):
    texts = [(d, (t or "").encode().split()) for d, t in rows]
    seen = Counter(tuple(ws[i : i + length]) for _, ws in texts for i in range(len(ws) - length + 1))
    out = []
    for d, ws in texts:
        gone = set()
        for i in range(len(ws) - length + 1):
            if seen[tuple(ws[i : i + length])] > 1:
                gone.update(range(i, i + length))
        kept = b" ".join(w for i, w in enumerate(ws) if i not in gone)
        out.append((d, len(ws), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def rows():
    rng = np.random.default_rng(8)
    word = lambda n: [f"w{x}" for x in rng.integers(0, 400, n)]
    passages = [word(n) for n in (6, 12, 13, 20, 40)]
    out = [(i, " ".join([*word(rng.integers(0, 25)), *passages[i % 5], *word(rng.integers(0, 25))])) for i in range(60)]
    return [*out, (100, None), (101, ""), (None, out[3][1]), (102, "w1 " * 50), (103, out[5][1]), (103, out[5][1]), (104, " ".join(word(5000)))]


@pytest.mark.parametrize("length,levels,chunk", [(12, 1, 1 << 20), (12, 2, 300), (12, 3, 300), (12, 5, 1), (35, 4, 500), (1, 1, 500), (1, 3, 500)])
def test_equals_brute_force(spark, length, levels, chunk):
    data = rows()
    got = S.dedup_substrings(spark.createDataFrame(data, "doc_id long, text string").repartition(3), length, chunk, levels).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in got), key=str) == brute(data, length)


def test_chunks_do_not_move_again(spark):
    """Bodies are dealt out once: every join on the chunk reads them without an exchange, and the catalog keeps no table."""
    docs = spark.createDataFrame(rows(), "doc_id long, text string")
    plan = S.dedup_substrings(docs, 12)._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("prumo_")]
