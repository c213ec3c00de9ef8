"""Every registered query of the library against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

from chartsift.plans import catalogue

SF = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9) + 0.0)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return str(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(spark, con, name):
    df = catalogue.queries()[name](spark, SF)
    cols = sorted(df.columns)
    rows = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    if name not in catalogue.oracle_sql():
        assert rows
        return
    found = con.execute(catalogue.oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == cols
    assert sorted(tuple(plain(r[names.index(c)]) for c in cols) for r in found.fetchall()) == rows
