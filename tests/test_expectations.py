import pytest
from pyspark.sql import functions as F

from clearfold.operators import expectations as E

ROWS = [
    (1, "a", "2026-01-01", "text"),
    (2, "a", "2026-13-45", "text"),
    (3, "b", None, " 　"),
    (4, "b", "2026-1-2", None),
    (5, "b", "2026-01-01\n", ""),
    (6, None, "", "x"),
    (7, None, "2026-02-30", "x"),
    (8, "c", "x2026-01-01", "x"),
]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, "ingest_seq bigint, doc_id string, effective_date string, content string")


def test_suite_counts(rows):
    got = [(r.name, r.column, r.success, r.unexpected) for r in E.run_suite(rows).orderBy("ordinal").collect()]
    assert got == [
        ("not_null", "content", False, 3),
        ("unique", "doc_id", False, 3),  # a, b and null: repeated values, not rows
        ("not_null", "effective_date", False, 2),
        ("match_regex", "effective_date", False, 4),  # null, 2026-1-2, "", x2026
        ("valid_date", "effective_date", False, 6),
    ]


def test_samples_are_the_first_three(rows):
    samples = E.failure_samples(rows).orderBy("ordinal", "position").collect()
    by_check = {}
    for s in samples:
        by_check.setdefault(s.ordinal, []).append(s.value)
    assert by_check[0] == [" 　", None, ""]
    assert by_check[1] == ["a", "b", None]
    assert by_check[4] == ["2026-13-45", None, "2026-01-01\n"]
    detailed = E.with_samples(E.run_suite(rows), E.failure_samples(rows)).orderBy("ordinal").collect()
    assert detailed[1].detail == "e.g. a, b, null"


def test_gate(rows, spark):
    with pytest.raises(E.PipelineHalt) as halt:
        E.validate_or_halt(E.run_suite(rows))
    assert str(halt.value) == (
        "bad data before agent -> not_null(content)=3; unique(doc_id)=3; "
        "not_null(effective_date)=2; match_regex(effective_date)=4; valid_date(effective_date)=6"
    )
    good = rows.where("ingest_seq = 1")
    assert len(E.validate_or_halt(E.run_suite(good))) == 5
    assert E.failure_samples(good).count() == 0
    assert all(r.success for r in E.run_suite(rows.limit(0)).collect())


def test_any_condition_can_be_expected(rows):
    short = E.Expectation("short", "content", F.length("content") < 3)
    result = E.run_suite(rows, [short]).first()
    assert (result["name"], result["unexpected"]) == ("short", 3)
