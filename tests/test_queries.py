"""Every query with SQL gives the rows that DuckDB gives."""

import datetime
import math

import duckdb
import pytest

import __spark_entry__ as entry
from lectern.plans import MODULES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
OWN = {k: v for m in MODULES for k, v in m.QUERIES.items()}
SQL = {k: v for m in MODULES for k, v in m.SQL.items()}


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


@pytest.mark.parametrize("name", sorted(OWN))
def test_query(spark, duck, name):
    df = OWN[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(map(plain, r)) for r in df.select(*cols).collect())
    if name not in SQL:
        assert got
        return
    r = duck.execute(SQL[name])
    names = [d[0] for d in r.description]
    at = [names.index(c) for c in cols]
    assert len(names) == len(cols)
    assert got == sorted(tuple(plain(row[i]) for i in at) for row in r.fetchall())


def test_contract(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
