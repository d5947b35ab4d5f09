"""Queries that SQL can express, against it: on the smallest tables and on a table of odd cases."""

import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from prumo.llm import queries

duckdb = pytest.importorskip("duckdb")
SMALL = "/root/testdata/sf0.001"


def odd_texts():
    rng = random.Random(7)
    line = "This line of rather more than forty characters is in many documents, é."
    passage = " ".join(f"p{i}" for i in range(80))
    vocabulary = [f"w{i}" for i in range(5000)]
    texts = [None, None, "", "", " ", "\n", "\n\n", "\t\v\f\r\n", "a", "A", " a ", "a b", "ab", "a\nb", "x   y", "x　y", "\U0001f600 \U0001f600"]
    texts += [f"{k}\n{line}\nend {k}" for k in range(4)] + [f"  {line.upper()}\t", f"{line}\r\n{line}", line, "é" * 39, "é" * 40, *["ß" * 40] * 6, *["x" * 39] * 6]
    texts += [passage, f"before {passage} after", " ".join(passage.split()[10:50]), passage.replace(" ", "\n"), passage.replace("p40", "q"), "w " * 100, "u v " * 30, "w " * 36, "w " * 35]
    own = [rng.choice(vocabulary) for _ in range(6000)]
    texts += [" ".join(own), " ".join([*own[:5990], "z"]), " ".join(own[3000:]), "long" * 50_000]
    return texts


@pytest.fixture(scope="module")
def odd(tmp_path_factory):
    folder = tmp_path_factory.mktemp("odd")
    texts = odd_texts()
    n = len(texts)
    ids = list(range(n))
    random.Random(1).shuffle(ids)
    table = pa.table(
        {
            "doc_id": pa.array(ids, pa.int64()),
            "text": pa.array(texts, pa.string()),
            "lang": pa.array([None] * n, pa.string()),
            "source": pa.array([["b", None, "a", "é", "B", "", "c"][k % 7] for k in range(n)], pa.string()),
            "n_chars": pa.array([len(t) if t and k % 3 else None for k, t in enumerate(texts)], pa.int64()),
        }
    )
    pq.write_table(table, folder / "documents.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def none(tmp_path_factory):
    folder = tmp_path_factory.mktemp("none")
    pq.write_table(pq.read_table(f"{SMALL}/documents.parquet").slice(0, 0), folder / "documents.parquet")
    return str(folder)


def plain(row):
    return tuple(round(v, 4) if isinstance(v, float) else v for v in row)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
@pytest.mark.parametrize("which", ["small", "odd", "none"])
def test_equals_sql(spark, odd, none, name, which):
    sf = {"small": SMALL, "odd": odd, "none": none}[which]
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    want = con.sql(queries.ORACLE_SQL[name])
    got = queries.QUERIES[name](spark, sf)
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    rows = want.select(", ".join(columns)).fetchall()
    assert sorted(map(repr, map(plain, got.select(*columns).collect()))) == sorted(map(repr, map(plain, rows)))
    assert bool(rows) == (which != "none")
