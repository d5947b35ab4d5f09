"""Boundary cases against results written out by hand."""

import pytest

from tests import cases
from tests.test_queries import plain

duckdb = pytest.importorskip("duckdb")


@pytest.mark.parametrize("name", sorted(cases.QUERIES))
def test_case(spark, name):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    got, want = cases.QUERIES[name](spark, ""), con.sql(cases.ORACLE_SQL[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    rows = want.select(", ".join(f'"{c}"' for c in columns)).fetchall()
    assert sorted(repr(plain(tuple(r))) for r in got.select(*columns).collect()) == sorted(repr(plain(r)) for r in rows)
