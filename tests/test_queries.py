"""Every query outside the training-data subpackage against its SQL."""

import os

import pytest

from prumo import catalog

SF = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in os.listdir(SF):
        c.execute(f"create view {t.removesuffix('.parquet')} as select * from '{SF}/{t}'")
    return c


def plain(v):
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return round(float(v), 5) if isinstance(v, float) or type(v).__name__ == "Decimal" else v


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_equals_sql(spark, con, name):
    got = catalog.QUERIES[name](spark, SF)
    want = con.sql(catalog.ORACLE_SQL[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    rows = want.select(", ".join(f'"{c}"' for c in columns)).fetchall()
    assert sorted(repr(plain(tuple(r))) for r in got.select(*columns).collect()) == sorted(repr(plain(r)) for r in rows)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
