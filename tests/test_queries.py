"""Every query against its SQL counterpart on the small test tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from workload.artefacts import ARTEFACTS
from workload.oracle import ORACLE
from workload.queries import QUERIES as OPERATORS

QUERIES = OPERATORS | ARTEFACTS

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def _ordered(rows):
    return sorted(rows, key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    found = QUERIES[name](spark, SF)
    expected = duck.sql(ORACLE[name])
    columns = sorted(found.columns)
    assert columns == sorted(expected.columns)
    places = [expected.columns.index(c) for c in columns]
    rows = [tuple(r[c] for c in columns) for r in found.collect()]
    assert _ordered(rows) == _ordered([tuple(r[i] for i in places) for r in expected.fetchall()])


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).first()["raw"] == 200
