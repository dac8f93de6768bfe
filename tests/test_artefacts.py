"""Queries over artefacts where Spark deals rows out as it does at larger sizes."""

from __future__ import annotations

import os

import pytest

from workload import artefacts

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture
def small_parts(spark):
    """Partitions of a few kilobytes, so that large and small parts of a plan are not merged alike."""
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name in settings:
        spark.conf.unset(name)


def test_each_issue_array_is_one_file(spark, small_parts, monkeypatch):
    monkeypatch.setattr(artefacts, "SHARD", 10)
    expected = artefacts.source_records(spark, SF).where("source_type = 'jira'").select("doc_id", "content")
    read = artefacts.issue_arrays(spark, SF).select("doc_id", "content")
    assert sorted(map(tuple, read.collect())) == sorted(map(tuple, expected.collect()))
