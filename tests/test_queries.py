"""Every query with SQL against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

from talkmill.plans import registry

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(columns, records):
    plain = lambda x: "null" if x is None or x != x else f"{x:.6g}" if isinstance(x, float) else str(x)
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in records)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return con


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no tables")
@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    df = registry.queries()[name](spark, DIR)
    got = df.collect()
    if name in registry.oracle_sql():
        cur = duck.execute(registry.oracle_sql()[name])
        columns = [c[0] for c in cur.description]
        assert sorted(columns) == sorted(df.columns)
        assert rows(df.columns, got) == rows(columns, cur.fetchall())
