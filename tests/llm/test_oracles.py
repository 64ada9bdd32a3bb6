"""The training-data queries that SQL can express agree with it."""

import duckdb
import pytest

from pagelattice.llm import queries


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_oracle(spark, tiny, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels"):
        con.execute(f"create view {t} as select * from '{tiny}/{t}.parquet'")
    df = queries.queries()[name](spark, tiny)
    cols = sorted(df.columns)
    cur = con.execute(queries.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    key = lambda r: tuple(map(str, r))
    rows = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=key)
    assert rows == sorted((tuple(r[names.index(c)] for c in cols) for r in cur.fetchall()), key=key) and rows
