import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clearfold.operators import cleaning
from clearfold.sources.tables import materialised
from tests.corpus import model, records


def outcome(spark, rows, **kw):
    narrow = cleaning.narrow(cleaning.stage(records(spark, rows)))
    return {r.ingest_seq: (r.action, r.reason) for r in cleaning.outcomes(narrow, **kw).collect()}


CASES = [
    # the earlier of two equal latest dates wins
    (1, "tie", "file", "2026-01-02", "a", 1.0, "one"),
    (2, "tie", "jira", "02/01/2026", "b", 1.0, "two"),
    # nothing dated: the first stays, and is flagged
    (3, "none", "file", None, None, 1.0, "one"),
    (4, "none", "file", "  ", None, 1.0, "two"),
    (5, "none", "file", "nonsense", None, 1.0, "three"),
    # an undated and an unreadable row beside a dated one are superseded, by date without version
    (6, "beside", "file", None, "", 1.0, "one"),
    (7, "beside", "file", "2026-13-45", "", 1.0, "two"),
    (8, "beside", "file", "2026-01-01", "", 1.0, "three"),
    # an unreadable date alone reaches the gate
    (9, "bad", "file", "2026-13-45", None, 1.0, "one"),
    # a later copy with a newer date is still a duplicate; another source's copy is not
    (10, "copy", "file", "2026-01-01", "v1", 1.0, "same  text"),
    (11, "copy", "file", "2026-05-01", "v2", 1.0, " same text "),
    (12, "copy", "jira", "2025-05-01", "v2", 1.0, "same text"),
    # blank in every way
    (13, "blank", "file", "2026-01-01", None, 0.1, " 　\x1c\n"),
    (14, "blank", "file", "2026-01-01", None, 0.1, ""),
    # the threshold is strict; the replacement character flags good OCR too; no date comes first
    (15, "ocr1", "file", "2026-01-01", None, 0.6, "x"),
    (16, "ocr2", "file", "2026-01-01", None, 0.59, "x"),
    (17, "ocr3", "file", "2026-01-01", None, 1.0, "x�"),
    (18, "ocr4", "file", None, None, 0.1, "x"),
    # decomposed and composed text are copies of each other
    (19, "nfc", "file", "2026-01-01", None, 1.0, "ga\u0300"),
    (20, "nfc", "file", "2026-01-01", None, 1.0, "g\u00e0"),
]


def test_each_case(spark):
    got = outcome(spark, CASES)
    assert got == model(CASES)
    assert got[2] == ("reject", "superseded_by_a")
    assert got[3] == ("flag", "review_missing_date") and got[4] == ("reject", "superseded_no_date")
    assert got[6] == got[7] == ("reject", "superseded_by_2026-01-01")
    assert got[9] == (None, None)
    assert got[11] == ("reject", "duplicate_content_hash") and got[20] == got[11]
    assert got[13] == got[14] == ("reject", "empty_content")


def test_input_partitioning_does_not_matter(spark):
    shuffled = CASES[:]
    random.Random(5).shuffle(shuffled)
    frame = records(spark, shuffled).repartition(7)
    rows = cleaning.outcomes(cleaning.narrow(cleaning.stage(frame))).collect()
    assert {r.ingest_seq: (r.action, r.reason) for r in rows} == model(CASES)


row = st.tuples(
    st.sampled_from("abc"),
    st.sampled_from(["file", "jira"]),
    st.sampled_from(["2026-01-01", "02/01/26", "2026/01/03", "2026-02-31", "", None]),
    st.sampled_from(["v1", "v2", "", None]),
    st.sampled_from([0.5, 0.6, 1.0]),
    st.sampled_from(["x", " x", "y", "z", "", "x �"]),
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(row, max_size=40))
def test_random_records_against_the_model(spark, drawn):
    rows = [(i, *r) for i, r in enumerate(drawn)]
    assert outcome(spark, rows, salts=3) == model(rows)


def test_one_key_holding_most_rows(spark):
    rows = [(i, "hot", "file", f"2026-01-{i % 28 + 1:02d}", f"v{i}", 1.0, f"text {i % 700}") for i in range(2000)]
    rows += [(2000 + i, f"d{i}", "file", "2026-01-01", None, 1.0, "text") for i in range(500)]
    assert outcome(spark, rows) == model(rows)


def test_hot_key_is_spread_over_tasks(spark):
    """Records look up their group's survivor on (doc_id, salt), never on doc_id alone; other joins
    are on the unique position."""
    frame = records(spark, CASES)
    rows = materialised(cleaning.narrow(cleaning.stage(frame)))
    plan = cleaning.decide(rows)._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert joins and all("salt" in line or "survivor_seq" in line for line in joins)
    # Minima and maxima of one number need no sorted aggregate, and no text is hashed again.
    assert "SortAggregate" not in plan and "sha2" not in plan
    assert "Window" not in plan


def test_classified_rows_are_whole(spark):
    classified = cleaning.classify(records(spark, CASES))
    assert classified.count() == len(CASES)
    long = records(spark, [(1, "l", "file", "2026-01-01", "v1", 1.0, "word " * 5000)])
    kept = cleaning.cleaned_rows(cleaning.classify(long)).first()
    assert kept.content == ("word " * 5000).strip() and kept.effective_date_status == "ok"


def test_cleaned_texts_equal_cleaned_rows(spark):
    frame = records(spark, CASES)
    routed = cleaning.outcomes(cleaning.narrow(cleaning.stage(frame)))
    narrow = cleaning.cleaned_texts(frame, routed)
    whole = cleaning.cleaned_rows(cleaning.classify(frame))
    assert sorted(narrow.collect()) == sorted(whole.select(*narrow.columns).collect())


def test_survivor_takes_its_groups_place(spark):
    rows = [
        (1, "a", "file", "2026-01-01", "v1", 1.0, "one"),
        (2, "b", "file", "2026-01-01", "v1", 1.0, "one"),
        (3, "a", "file", "2026-01-05", "v2", 1.0, "two"),
    ]
    kept = cleaning.cleaned_rows(cleaning.classify(records(spark, rows))).orderBy("ingest_seq")
    assert [(r.ingest_seq, r.doc_id, r.version) for r in kept.collect()] == [(1, "a", "v2"), (2, "b", "v1")]


def test_quarantine_preview_and_funnel(spark):
    rows = [(1, "a", "file", None, "v1", 1.0, "é" * 300), (2, "b", "file", "2026-13-01", None, 1.0, "x")]
    routed = cleaning.outcomes(cleaning.narrow(cleaning.stage(records(spark, rows))))
    quarantined = cleaning.quarantine_rows(routed, "r").collect()
    assert [(q.run_id, q.reason, q.content) for q in quarantined] == [("r", "review_missing_date", "é" * 120)]
    counts = cleaning.funnel(routed).first().asDict()
    assert counts["raw"] == 2 and counts["invalid_date"] == 1 and counts["cleaned"] == 1


def test_empty_input(spark):
    routed = cleaning.outcomes(cleaning.narrow(cleaning.stage(records(spark, []))))
    assert set(cleaning.funnel(routed).first().asDict().values()) == {0}


def test_knowledge_rows_are_files_with_content(spark):
    rows = [
        (1, "a", "file", None, None, 1.0, "x"),
        (2, "b", "jira", None, None, 1.0, "x"),
        (3, "c", "file", None, None, 1.0, " 　"),
    ]
    kept = cleaning.knowledge_rows(records(spark, rows)).select(F.collect_list("doc_id")).first()[0]
    assert kept == ["a"]


def test_a_record_without_a_key_keeps_its_text(spark):
    frame = records(spark, [(1, None, "file", "2026-01-01", "v1", 1.0, "text"), (2, None, "file", None, "v1", 1.0, "")])
    found = {r.ingest_seq: r for r in cleaning.outcomes(cleaning.narrow(cleaning.stage(frame))).collect()}
    assert (found[1].doc_id, found[1].action, found[1].content_preview) == ("", None, "text")
    assert found[1].content_hash is not None
    assert (found[2].action, found[2].reason) == ("reject", "empty_content")


def test_source_filter_lies_below_the_text_join(spark):
    frame = records(spark, CASES)
    routed = cleaning.outcomes(cleaning.narrow(cleaning.stage(frame)))
    files = cleaning.cleaned_texts(frame, routed, "file")
    assert {r.source_type for r in files.collect()} <= {"file"}
    every = cleaning.cleaned_texts(frame, routed).where("source_type = 'file'")
    assert sorted(map(str, files.collect())) == sorted(map(str, every.collect()))
    plan = files._jdf.queryExecution().optimizedPlan().toString().splitlines()
    join = next(i for i, line in enumerate(plan) if "Join" in line)
    assert any("Filter" in line and "source_type" in line for line in plan[join:])
    assert not any("Filter" in line and "source_type" in line for line in plan[:join])
