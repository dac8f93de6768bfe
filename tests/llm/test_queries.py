"""The dealt operators' queries against their SQL counterparts on the small test tables."""

import os

import duckdb
import pytest

from clearfold.llm.oracle import ORACLE
from clearfold.llm.queries import QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in ("documents", "labels", "conversations", "embeddings"):
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, duck, name):
    found, expected = QUERIES[name](spark, SF), duck.sql(ORACLE[name])
    columns = sorted(found.columns)
    assert columns == sorted(expected.columns)
    places = [expected.columns.index(c) for c in columns]
    rows = [tuple(r[c] for c in columns) for r in found.collect()]
    assert sorted(map(str, rows)) == sorted(str(tuple(r[i] for i in places)) for r in expected.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs_over_every_document(spark, name):
    found = QUERIES[name](spark, SF)
    assert found.select("doc_id").distinct().count() == spark.read.parquet(f"{SF}/documents.parquet").count()
