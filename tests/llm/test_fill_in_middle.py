"""Cuts at units against a plain version, at chunk sizes that put cuts on and beside chunk borders."""

import random

import numpy as np
import pyarrow as pa
import pytest

from prumo.llm import fill_in_middle as fim
from prumo.llm.common import text_buffer

TEXTS = ["", "a", "é", "\n", "\n\n", " lead", "two words", "日本語 テキスト\n한국어 \U0001f600\U0001f600 x", "a\r\nb\nc", "tail \n", "x" * 3000, "ñ" * 1500, "w é " * 700, "l\n" * 1000]


def opens(text: str, unit: str) -> list[int]:
    """Places (in code points) where units start."""
    space = " \t\n\x0b\x0c\r"
    test = {"char": lambda b, c: True, "word": lambda b, c: b in space and c not in space, "line": lambda b, c: b == "\n"}[unit]
    return [i for i in range(len(text)) if i == 0 or test(text[i - 1], text[i])]


@pytest.mark.parametrize("unit", sorted(fim.STARTS))
@pytest.mark.parametrize("chunk", [1, 2, 3, 7, 64, 1 << 14])
def test_cut_places(unit, chunk):
    rng = random.Random(chunk)
    texts = [t for t in TEXTS if len(t) < 100 or chunk > 3]
    buf, bounds = text_buffer(pa.array(texts))
    for _ in range(12):
        draws = np.array([[rng.randrange(1 << 32), rng.choice([0, rng.randrange(1 << 32)])] for _ in texts])
        n, ranks, places = fim.cut_places(buf, bounds, draws, unit, chunk)
        for t, a, k, draw, rank, place in zip(texts, bounds.tolist(), n.tolist(), draws.tolist(), ranks.tolist(), places.tolist(), strict=False):
            at = [*opens(t, unit), len(t)]
            assert k == len(at) - 1
            want = sorted(d % (k + 1) for d in draw)
            assert rank == want
            assert [p - a for p in place] == [len(t[: at[r]].encode()) if r else 0 for r in want]


def test_forms_marks_and_round_trip(spark):
    texts = [*TEXTS, None, "has <P> in it", "<M>", "ends with <", "<S", "S>", "P><S", *["plain words, again " * 3] * 60]
    ids = [None, *range(1, len(texts))]
    docs = spark.createDataFrame(list(zip(ids, texts, ids, ["x"] * len(ids), strict=True)), "doc_id long, text string, n long, form string")
    for unit in sorted(fim.STARTS):
        out = fim.fill_in_middle(docs, unit=unit, chunk=5)
        rows = out.withColumn("back", fim.restore(out.output, out.form)).collect()
        assert sorted(r.back for r in rows) == sorted(t or "" for t in texts)
        by_id = {r.doc_id: r for r in rows}
        for i, t in zip(ids, texts, strict=True):
            r = by_id[i]
            if not t or any(m in t for m in ("<P>", "<S>", "<M>")):
                assert (r.form, r.output, r.prefix_units, r.middle_units) == ("plain", t or "", None, None)
        assert {r.form for r in rows} == {"plain", "psm", "spm"}
    assert fim.fill_in_middle(docs.limit(0)).count() == 0
    assert [r.form for r in fim.fill_in_middle(docs, plain_percent=100).collect()] == ["plain"] * len(texts)
    assert "psm" not in {r.form for r in fim.fill_in_middle(docs, spm_percent=100).collect()}
