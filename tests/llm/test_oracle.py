import os

import pytest

from tidemark.llm.queries import QUERIES, SQL

duckdb = pytest.importorskip("duckdb")
WHERE = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(WHERE), reason="benchmark tables not present")
@pytest.mark.parametrize("name", SQL)
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{WHERE}/{table}.parquet'")
    got, want = QUERIES[name](spark, WHERE), con.sql(SQL[name])
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


def test_every_number_has_a_query():
    assert [n for n in range(1, 14) if any(q.startswith(f"op{n}_") for q in QUERIES)] == list(range(1, 14))
