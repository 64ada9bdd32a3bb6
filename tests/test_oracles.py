"""Every registered query runs over the smallest tables; those with an oracle agree with it."""

import decimal

import duckdb
import pytest

from pagelattice.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return float(v)
    return v


@pytest.fixture(scope="module")
def duck(tiny):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{tiny}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, tiny, duck, name):
    df = registry.queries()[name](spark, tiny)
    cols = sorted(df.columns)
    rows = [tuple(plain(r[c]) for c in cols) for r in df.collect()]
    sql = registry.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    cur = duck.execute(sql)
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    other = [tuple(plain(r[names.index(c)]) for c in cols) for r in cur.fetchall()]
    key = lambda r: tuple(map(str, r))
    assert sorted(rows, key=key) == sorted(other, key=key)
