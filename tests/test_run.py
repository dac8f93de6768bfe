import re
from datetime import timedelta

import pytest

from clearfold.plans import run as plan
from clearfold.settings import SOURCES, parse_now
from clearfold.sources import readers, tables
from tests.corpus import DOCUMENTS, FAULTY_DOCUMENTS, QUESTION_SCHEMA, QUESTIONS, TICKETS, write_sources

NOW = parse_now("2026-02-10T14:35:00+00:00")
RUN = "2026-02-10T14:35"


def start(spark, folder, root, now=NOW, loaded_at=None):
    by_source = {
        "postgres": readers.read_tickets(spark, f"{folder}/tickets.csv"),
        "jira": readers.read_issues(spark, f"{folder}/issues.json"),
        "file": readers.read_documents(spark, f"{folder}/documents.csv"),
    }
    questions = spark.createDataFrame(QUESTIONS, QUESTION_SCHEMA)
    return plan.run(spark, by_source, str(root), now, loaded_at, questions)


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    return tmp_path_factory.mktemp("tables")


@pytest.fixture(scope="module")
def good(tmp_path_factory):
    return write_sources(tmp_path_factory.mktemp("good"))


@pytest.fixture(scope="module")
def faulty(tmp_path_factory):
    """Five tickets lost, a day that does not exist, a noisy scan."""
    return write_sources(
        tmp_path_factory.mktemp("faulty"), [*DOCUMENTS, *FAULTY_DOCUMENTS], TICKETS[: len(TICKETS) - 5]
    )


@pytest.fixture(scope="module")
def published(spark, good, root):
    return start(spark, good, root)


def test_funnel_of_a_published_run(published):
    assert (published.run_id, published.status, published.exit_code) == (RUN, "PUBLISHED", 0)
    assert published.funnel == {
        "raw": 35,
        "dropped_empty": 1,
        "dropped_duplicates": 2,
        "dropped_superseded": 1,
        "flagged_missing_date": 2,
        "flagged_low_ocr": 0,
        "flagged_encoding": 0,
        "invalid_date": 0,
        "cleaned": 29,
        "quarantined": 6,
    }
    assert published.embedded == 7 and published.worst == "PASS"
    assert len(published.suite) == 5 and all(r["success"] for r in published.suite)


def test_tables_of_a_published_run(spark, published, root):
    def table(name):
        return tables.read(spark, str(root), name, RUN, published.attempt)

    cleaned = table("cleaned")
    assert cleaned.count() == 29 and not [c for c in cleaned.columns if c.startswith("_")]
    refund = cleaned.where("doc_id = '12'").first()
    assert (refund.version, refund.effective_date) == ("v4", "2026-02-07")
    assert refund.content == "Refunds: money back within 7 days."
    assert table("cleaned").where("doc_id = '58'").first().effective_date == "2026-02-10"
    reasons = sorted(r.reason for r in table("quarantine").collect())
    assert reasons == sorted(
        ["empty_content", "superseded_by_v4"] + ["duplicate_content_hash", "review_missing_date"] * 2
    )
    assert table("store").count() == 7
    edges = {(e.from_node, e.to_node): e.n_rows for e in table("lineage").collect()}
    assert edges == {
        ("source:postgres", "raw"): 18,
        ("source:jira", "raw"): 6,
        ("source:file", "raw"): 11,
        ("raw", "cleaned"): 29,
        ("cleaned", "vector_store"): 7,
    }
    report = {(r.section, r.item): r for r in table("quality_report").collect()}
    assert report["funnel", "cleaned"].value == 29
    assert report["suite", "valid_date(effective_date)"].status == "PASS"
    assert report["checks", "cardinality[doc_id]"].value == 29


def test_cleaning_corrects_an_answer(spark, published, root):
    rows = {r.question_id: r for r in tables.read(spark, str(root), "evaluation", RUN, published.attempt).collect()}
    assert [(rows[q].before_correct, rows[q].after_correct) for q in ("q1", "q2", "q3")] == [
        (False, True),
        (True, True),
        (True, True),
    ]
    assert (rows["q1"].after_doc, rows["q1"].after_version) == ("12", "v4")
    assert (rows["q2"].after_doc, rows["q3"].after_doc) == ("58", "44")


def test_repeating_a_run_changes_nothing(spark, good, root, published):
    names = ["raw", "cleaned", "quarantine", "store", "baseline", "checks", "quality_report", "evaluation"]

    def contents():
        return {n: sorted(map(str, tables.read_published(spark, str(root), n).collect())) for n in names}

    before = contents()
    assert start(spark, good, root).attempt != published.attempt
    after = contents()
    # the first run had no baseline to compare volumes with
    for n in ("checks", "quality_report"):
        before[n] = [r.replace("no baseline yet", "") for r in before[n]]
        after[n] = [re.sub(r"baseline=\d+ change=0.0%", "", r) for r in after[n]]
    assert before == after


def test_halted_run_publishes_nothing(spark, faulty, root, published):
    later = NOW + timedelta(days=1)
    loaded_at = {s: later for s in SOURCES} | {"postgres": later - timedelta(hours=17)}
    halted = start(spark, faulty, root, later, loaded_at)
    assert (halted.status, halted.exit_code, halted.embedded) == ("HALTED", 1, 0)
    assert halted.halt_reason == "bad data before agent -> valid_date(effective_date)=1"
    assert halted.worst == "PAGE"
    assert (halted.funnel["raw"], halted.funnel["cleaned"]) == (32, 27)
    assert [halted.funnel[c] for c in ("flagged_missing_date", "flagged_low_ocr", "invalid_date")] == [1, 1, 1]
    checks = {c["name"]: c for c in tables.read(spark, str(root), "checks", halted.run_id, halted.attempt).collect()}
    assert (checks["freshness[postgres]"]["status"], checks["freshness[postgres]"]["value"]) == ("PAGE", 17.0)
    volume = checks["volume[postgres]"]
    assert (volume["status"], volume["value"], volume["detail"]) == ("WARN", 13, "baseline=18 change=-27.8%")
    suite = {r["name"]: r for r in tables.read(spark, str(root), "suite", halted.run_id, halted.attempt).collect()}
    assert suite["valid_date"]["detail"] == "e.g. 2026-13-45" and suite["match_regex"]["success"]
    assert tables.read(spark, str(root), "quality_report", halted.run_id, halted.attempt).count() > 0
    for name in ("store", "baseline", "evaluation"):
        with pytest.raises(Exception, match="PATH_NOT_FOUND"):
            tables.read(spark, str(root), name, halted.run_id, halted.attempt)
    state = tables.state(spark, str(root))
    assert (state["run_id"], state["status"], state["last_success_run"]) == (halted.run_id, "HALTED", RUN)
    assert tables.read_published(spark, str(root), "store").count() == 7
    report = tables.read(spark, str(root), "quality_report", halted.run_id, halted.attempt)
    of_run = {r["item"]: r for r in report.where("section = 'run'").collect()}
    assert (of_run["run_status"].status, of_run["run_status"].detail) == ("HALTED", halted.halt_reason)
    assert of_run["embedded_records"].value == 0


def test_a_halted_repetition_changes_nothing_that_readers_see(spark, good, faulty, tmp_path):
    first = start(spark, good, tmp_path)
    names = ["raw", "cleaned", "quarantine", "store", "baseline", "quality_report"]

    def seen():
        return {n: sorted(map(str, tables.read_published(spark, str(tmp_path), n).collect())) for n in names}

    before = seen()
    again = start(spark, faulty, tmp_path)
    assert (again.run_id, again.status) == (first.run_id, "HALTED")
    assert seen() == before


def test_run_without_any_record(spark, tmp_path):
    empty = write_sources(tmp_path / "empty", [], [], [])
    by_source = {
        "postgres": readers.read_tickets(spark, f"{empty}/tickets.csv"),
        "file": readers.read_documents(spark, f"{empty}/documents.csv"),
    }
    result = plan.run(spark, by_source, str(tmp_path / "root"), NOW)
    assert (result.status, result.worst, result.embedded) == ("PUBLISHED", "WARN", 0)
    assert set(result.funnel.values()) == {0}
    assert tables.read(spark, str(tmp_path / "root"), "quarantine", RUN, result.attempt).count() == 0


def test_slas_and_low_ocr_are_optional_checks(spark, good, tmp_path):
    by_source = {"file": readers.read_documents(spark, f"{good}/documents.csv")}
    slas = spark.createDataFrame([("file", 1.0)], "source_type string, sla_hours double")
    loaded_at = {"file": NOW - timedelta(hours=1)}
    plan.run(spark, by_source, str(tmp_path), NOW, loaded_at, slas=slas, warn_low_ocr=True)
    checks = {c["name"]: c["status"] for c in tables.read_published(spark, str(tmp_path), "checks").collect()}
    assert checks["freshness[file]"] == "PAGE" and checks["low_ocr"] == "PASS"


def test_roll_back(spark, good, tmp_path):
    root = str(tmp_path)
    with pytest.raises(ValueError):
        tables.roll_back(spark, root)

    def publish(run, attempt, n):
        tables.write(spark.createDataFrame([(n,)], "n int"), root, "store", run, attempt)
        tables.append_log(spark, root, run, attempt, tables.PUBLISHED)

    def seen():
        return tables.read_published(spark, root, "store").first()["n"]

    for n, run in enumerate("ABC"):
        publish(run, f"{run}1", n)
    publish("C", "C2", 3)
    tables.append_log(spark, root, "D", "D1", tables.HALTED)
    assert seen() == 3
    assert (tables.roll_back(spark, root), seen()) == ("B", 1)
    assert (tables.roll_back(spark, root), seen()) == ("A", 0)
    with pytest.raises(ValueError):
        tables.roll_back(spark, root)
    publish("E", "E1", 5)
    assert (seen(), tables.roll_back(spark, root), seen()) == (5, "A", 0)


def test_first_run_has_no_baseline_and_no_state(spark, tmp_path):
    assert tables.load_baseline(spark, str(tmp_path)).count() == 0
    assert tables.state(spark, str(tmp_path)) is None
    assert tables.read_published(spark, str(tmp_path), "store") is None


def test_csv_export(spark, tmp_path, published, root):
    rows = tables.read(spark, str(root), "evaluation", RUN, published.attempt)
    tables.export_csv(rows.coalesce(1), f"{tmp_path}/csv")
    back = spark.read.options(header=True, escape='"').csv(f"{tmp_path}/csv")
    assert back.columns == rows.columns and back.count() == 3


def test_command_line(spark, good, tmp_path, capsys, monkeypatch):
    args = ["--tickets", f"{good}/tickets.csv", "--issues", f"{good}/issues.jsonl", "--issue-lines"]
    args += ["--documents", f"{good}/documents.csv", "--root", str(tmp_path)]
    monkeypatch.setenv("LAB_NOW", "2026-02-11T08:00:00")
    assert plan.main(args) == 0
    out = capsys.readouterr().out
    assert "run_id=2026-02-11T08:00 status=PUBLISHED" in out and "cleaned=29" in out
