"""The stages of the corpus pipeline, each against a plain version over its own input."""

import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from prumo.llm import decontaminate, mixing, quality
from tests.llm.test_ngram_join import brute

SF = "/root/testdata/sf0.001"
pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """What each stage got and returned, written and read again between them."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, docs, SF).write.parquet(path)
        out[name] = docs, (docs := spark.read.parquet(path))
    return out


def ids(df):
    return Counter(r.doc_id for r in df.select("doc_id").collect())


def test_stages(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "mixing", "token_ids"]
    assert all(steps[n][1].columns == steps["quality"][0].columns for n in list(steps)[:-1])


def test_quality(spark, steps):
    before, after = steps["quality"]
    scored = quality.classify(before, spark.read.parquet(f"{SF}/labels.parquet"))
    assert ids(after) == ids(scored.filter("predicted = 1")) and 0 < after.count() < before.count()


def test_near_duplicates(steps):
    before, after = steps["near_duplicates"]
    assert ids(after) == Counter(d for d, _, root in brute([(r.doc_id, r.text) for r in before.collect()], 5, 4, 5) if d == root)


def test_decontamination(spark, steps):
    before, after = steps["decontamination"]
    assert ids(after) == ids(decontaminate.decontaminate(before, spark.read.parquet(f"{SF}/benchmark.parquet")).filter("not contaminated"))


def test_mixing(steps):
    """Against the SQL of the sampling over what the stage got."""
    duckdb = pytest.importorskip("duckdb")
    before, after = steps["mixing"]
    con = duckdb.connect()
    con.register("documents", before.toArrow())
    times = {doc: taken // size for doc, size, taken in con.sql(f"SELECT doc_id, size, taken FROM ({mixing.SQL})").fetchall() if taken}
    assert ids(after) == Counter(times)


def test_token_ids(steps):
    import public_tokenizers
    from tokenizers import Tokenizer

    before, after = steps["token_ids"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    start, want = 0, []
    for r in sorted(before.collect(), key=lambda r: r.doc_id):
        own = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2]
        want.append((r.doc_id, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
        start += len(own)
    assert sorted((tuple(r) for r in after.select("doc_id", "start", "n_tokens", "ids_crc32").collect()), key=lambda r: r[1]) == want


def test_run(spark, steps):
    assert sorted(map(repr, corpus_pipeline.run(spark, SF).collect())) == sorted(map(repr, steps["token_ids"][1].collect()))


def test_odd_rows(spark, tmp_path):
    """Null, empty, long and repeated rows, and columns with names that operators might use, through every stage."""
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(None, None), (None, "a null id with some words in it"), (1, ""), (2, None), (3, "the same words stand here and here again, all of them"), (3, "the same words stand here and here again, all of them"), (4, "the same words stand here and here again, all of them"), (5, long)]
    names = ["_score", "_stays", "_found", "n", "root", "size", "component_id", "shift"]
    docs = spark.createDataFrame([(d, t, "en", None if d == 1 else "s", 7, *range(len(names))) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} int" for n in names))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), SF).collect() == []
        assert stage(spark, docs, SF).columns == docs.columns, name
    assert ids(corpus_pipeline.keep_first(spark, docs, SF)) == {None: 2, 1: 1, 2: 1, 3: 2, 5: 1}
    assert ids(corpus_pipeline.keep_clean(spark, docs, SF)) == ids(docs)
    assert set(ids(corpus_pipeline.keep_good(spark, docs, SF))) <= {None, 1, 2, 3, 4, 5}
    assert sum(ids(corpus_pipeline.encode(spark, docs, SF)).values()) == len(rows) and corpus_pipeline.encode(spark, docs.limit(0), SF).collect() == []
