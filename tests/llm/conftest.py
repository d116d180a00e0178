import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def given(spark):
    """A given table as rows of its first columns, or None where the tables are not present."""
    def read(name, *columns):
        path = f"{DATA}/{name}.parquet"
        if not os.path.exists(path):
            pytest.skip("benchmark tables not present")
        return [tuple(r) for r in spark.read.parquet(path).select(*columns).collect()]
    return read


@pytest.fixture(scope="session")
def documents(spark):
    def make(rows):
        return spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], SCHEMA)
    return make
