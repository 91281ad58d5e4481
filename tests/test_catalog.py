"""Each catalog query against its SQL, on the smallest tables."""

import math

import duckdb
import pytest

import wayforge.plans.catalog as catalog
from tests.conftest import SMALL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


def plain(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return "null"
    if isinstance(x, float):
        return repr(round(x, 9) + 0.0)
    return str(x)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, SMALL)
    got = df.collect()
    if name not in catalog.ORACLE_SQL:
        assert got
        return
    r = duck.execute(catalog.ORACLE_SQL[name])
    columns = [c[0] for c in r.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows(df.columns, got) == rows(columns, r.fetchall())
