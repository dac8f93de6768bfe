"""What crosses a shuffle or is written, by plans and files."""

from __future__ import annotations

from pathlib import Path

from clearfold.operators import retrieval
from clearfold.sources import tables


def _store(spark, texts):
    schema = "ingest_seq bigint, doc_id string, version string, effective_date string, source_uri string, content string"
    return retrieval.build_store(spark.createDataFrame([(i, "d", "v1", None, "u", t) for i, t in texts], schema))


def test_the_index_moves_vectors_and_not_their_terms_one_by_one(spark):
    index = retrieval.postings(_store(spark, [(0, "a b a"), (3, ""), (5, "b"), (1024, "b a"), (4096, None)]))
    plan = index._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "collect_list" not in plan
    rows = sorted((r.term, r.run, list(r.places), list(r.tfs), list(r.norms), r.most) for r in index.collect())
    assert rows == [
        ("a", 0, [0], [2], [5**0.5], 2 / 5**0.5),
        ("a", 1, [0], [1], [2**0.5], 1 / 2**0.5),
        ("b", 0, [0, 5], [1, 1], [5**0.5, 1.0], 1.0),
        ("b", 1, [0], [1], [2**0.5], 1 / 2**0.5),
    ]


def test_tables_are_written_with_zstd(spark, tmp_path):
    tables.write(spark.range(5), str(tmp_path), "t", "r", "a")
    tables.materialised(spark.range(5), f"{tmp_path}/m")
    written = [p.name for p in Path(tmp_path).rglob("*.parquet")]
    assert written and all(name.endswith(".zstd.parquet") for name in written)
