import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from clearfold.schema import CANONICAL_COLUMNS
from clearfold.sources import canonical, readers, tables
from tests.corpus import DOCUMENTS, ISSUES, TICKETS, write_sources


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    return write_sources(tmp_path_factory.mktemp("sources"))


def test_tickets(spark, folder):
    rows = readers.read_tickets(spark, f"{folder}/tickets.csv").orderBy("ingest_seq").collect()
    assert [r.doc_id for r in rows] == [t[0] for t in TICKETS]
    assert [r.content for r in rows] == [t[6] for t in TICKETS]
    assert {(r.source_type, r.version, r.ocr_confidence) for r in rows} == {("postgres", None, 1.0)}
    assert rows[-1].effective_date is None  # an empty cell counts as missing


@pytest.mark.parametrize(("name", "lines"), [("issues.json", False), ("issues.jsonl", True)])
def test_issues(spark, folder, name, lines):
    rows = readers.read_issues(spark, f"{folder}/{name}", lines).orderBy("ingest_seq").collect()
    assert [(r.doc_id, r.source_uri, r.title, r.effective_date, r.content) for r in rows] == [
        (i[0], f"jira/{i[0]}", i[1], i[2], i[5]) for i in ISSUES
    ]


def test_documents(spark, folder):
    rows = readers.read_documents(spark, f"{folder}/documents.csv").orderBy("ingest_seq").collect()
    assert [(r.doc_id, r.title or "", r.version or "") for r in rows] == [(d[0], d[2], d[4]) for d in DOCUMENTS]
    assert [r.content for r in rows] == [d[6] for d in DOCUMENTS]
    assert rows[8].ocr_confidence == 0.4


def test_quoted_cells(spark, tmp_path):
    rows = [("1", "u", 'a "b", c', "2026-01-01", "", "", "two\nlines, \"quoted\"")]
    write_sources(tmp_path, documents=rows)
    got = readers.read_documents(spark, f"{tmp_path}/documents.csv").collect()
    assert [(r.title, r.content, r.ocr_confidence) for r in got] == [(rows[0][2], rows[0][6], 1.0)]


def test_missing_columns_and_bad_numbers_are_errors(spark, tmp_path):
    (tmp_path / "t.csv").write_text("ticket_id,source_uri,subject\n1,u,s\n")
    with pytest.raises(AnalysisException):
        readers.read_tickets(spark, f"{tmp_path}/t.csv")
    (tmp_path / "i.json").write_text('[{"key": "a", "summary": "s"}]')
    with pytest.raises(Exception, match="issue lacks updated, description"):
        readers.read_issues(spark, f"{tmp_path}/i.json").collect()
    (tmp_path / "o.json").write_text('{"key": "a"}')
    with pytest.raises(Exception, match="not a JSON array"):
        readers.read_issues(spark, f"{tmp_path}/o.json").collect()
    (tmp_path / "i.jsonl").write_text('{"key": "a", "summary": "s", "updated": "u"}\n')
    with pytest.raises(Exception, match="issue lacks description"):
        readers.read_issues(spark, f"{tmp_path}/i.jsonl", lines=True).collect()
    write_sources(tmp_path, documents=[("1", "u", "t", "d", "v", "high", "c")])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        readers.read_documents(spark, f"{tmp_path}/documents.csv").collect()


def test_coercions(spark):
    rows = spark.createDataFrame([(" a　", "", None, None), ("b", "v1", "0.5", " c ")], "d string, v string, o string, c string")
    plain = {c: F.lit("x") for c in ("source_type", "source_uri", "title", "effective_date")}
    mapping = plain | {"doc_id": "d", "version": "v", "ocr_confidence": "o", "content": "c"}
    got = canonical.canonicalise(rows, mapping).collect()
    assert [(r.doc_id, r.version, r.ocr_confidence, r.content) for r in got] == [("a", None, 1.0, ""), ("b", "v1", 0.5, " c ")]


def test_sources_are_numbered_in_contract_order(spark, folder):
    by_source = {
        "file": readers.read_documents(spark, f"{folder}/documents.csv"),
        "postgres": readers.read_tickets(spark, f"{folder}/tickets.csv"),
        "jira": readers.read_issues(spark, f"{folder}/issues.json"),
    }
    rows = canonical.union_sources(by_source).orderBy("ingest_seq").collect()
    assert [r.doc_id for r in rows] == [x[0] for x in (*TICKETS, *ISSUES, *DOCUMENTS)]
    assert len({r.ingest_seq for r in rows}) == len(rows)
    only = canonical.union_sources({"jira": by_source["jira"]})
    counts = {r.source_type: r.n_rows for r in canonical.source_counts(only).collect()}
    assert counts == {"postgres": 0, "jira": 6, "file": 0}


def test_one_element_without_a_key_is_an_error(spark, tmp_path):
    whole = {"key": "a", "summary": "s", "updated": "u", "description": "d"}
    (tmp_path / "i.json").write_text(json.dumps([whole, {k: v for k, v in whole.items() if k != "updated"}]))
    with pytest.raises(Exception, match="issue lacks updated"):
        readers.read_issues(spark, f"{tmp_path}/i.json").collect()


def test_files_with_other_headers_are_an_error(spark, tmp_path):
    head = "ticket_id,source_uri,subject,updated_at,priority,status,body"
    (tmp_path / "a.csv").write_text(f"{head}\n1,u,s,2026-01-01,p,o,text\n")
    (tmp_path / "b.csv").write_text("source_uri,ticket_id" + head[20:] + "\nu,2,s,2026-01-01,p,o,text\n")
    with pytest.raises(Exception, match="header"):
        readers.read_tickets(spark, [f"{tmp_path}/a.csv", f"{tmp_path}/b.csv"]).collect()


@pytest.mark.parametrize("multi_line", [True, False])
def test_input_order_is_file_order(spark, tmp_path, multi_line):
    head = "ticket_id,source_uri,subject,updated_at,priority,status,body\n"
    sizes = {"a_small": 2, "b_big": 3000, "c_middle": 40}
    for name, n in sizes.items():
        rows = (f"{name}{i:05d},u,s,2026-01-01,p,o,{'text ' * 20}" for i in range(n))
        (tmp_path / f"{name}.csv").write_text(head + "\n".join(rows) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        found = readers.read_tickets(spark, str(tmp_path), multi_line).orderBy("ingest_seq").select("doc_id").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r.doc_id for r in found] == [f"{name}{i:05d}" for name, n in sizes.items() for i in range(n)]


def test_undeclared_sources_are_not_lost(spark):
    records = spark.createDataFrame([(1, "d", "wiki")], "ingest_seq bigint, doc_id string, source_type string")
    with pytest.raises(ValueError, match="wiki"):
        canonical.union_sources({"wiki": records})
    assert canonical.union_sources({"wiki": records}, ["wiki"]).count() == 1
    counts = {r.source_type: r.n_rows for r in canonical.source_counts(records).collect()}
    assert counts == {"postgres": 0, "jira": 0, "file": 0, "wiki": 1}


def test_a_missing_key_is_the_empty_key(spark):
    mapping = {c: F.lit(None).cast("string") for c in CANONICAL_COLUMNS} | {"content": F.lit("text")}
    row = canonical.canonicalise(spark.range(1), mapping).first()
    assert (row.doc_id, row.content, row.ocr_confidence) == ("", "text", 1.0)


def test_intermediate_tables_need_a_shared_folder(spark):
    class Cluster:
        conf = type("Conf", (), {"get": staticmethod(lambda *_: None)})
        sparkContext = type("Context", (), {"master": "spark://host:7077"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        tables.shared_folder(Cluster())
