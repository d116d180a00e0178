"""Every registered query against its SQL on another engine, all rows compared."""

import os
import re

import pytest
from conftest import DATA

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as entry  # noqa: E402
from scripts.compare import differences, duck  # noqa: E402
from tidemark.workload import QUERIES  # noqa: E402

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="benchmark tables not present")
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(DATA)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, con, name):
    df = QUERIES[name](spark, DATA)
    result = con.sql(SQL[name])
    assert result.columns == df.columns
    only_spark, only_sql = differences([tuple(r) for r in df.collect()], result.fetchall())
    assert not only_spark and not only_sql, (only_spark[:3], only_sql[:3])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython|ArrowEvalPython", plan)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(SQL)


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
