import os

import duckdb
import pytest

from talkmill.llm import queries

DIR = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no tables")
@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    df = queries.queries()[name](spark, DIR)
    cur = con.execute(queries.oracle_sql()[name])
    columns = [c[0] for c in cur.description]
    assert sorted(columns) == sorted(df.columns)
    got = sorted((tuple(str(r[c]) for c in sorted(columns)) for r in df.collect()))
    assert got == sorted(tuple(str(r[columns.index(c)]) for c in sorted(columns)) for r in cur.fetchall())
