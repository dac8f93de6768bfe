"""The run log under runs that end at the same time, and what may be cleared."""

import os

import pytest

from clearfold.schema import RUN_LOG
from clearfold.sources import tables


def end(spark, root, run_id, status=tables.PUBLISHED):
    attempt = tables.new_attempt()
    for name in ("store", "raw"):
        tables.write(spark.createDataFrame([(run_id,)], "doc_id string"), root, name, run_id, attempt)
    tables.append_log(spark, root, run_id, attempt, status)
    return attempt


def log_row(spark, root, entry, follows, seq, run_id):
    row = (entry, follows, seq, run_id, f"attempt-{run_id}", tables.PUBLISHED, run_id, f"attempt-{run_id}")
    spark.createDataFrame([row], RUN_LOG).write.mode("append").parquet(f"{root}/run_log")


def folders(root):
    found = set()
    for at, _, files in os.walk(root):
        if any(f.endswith(".parquet") for f in files) and "attempt=" in at:
            found.add(at.split("attempt=")[1])
    return found


@pytest.mark.parametrize("order", [("b", "c"), ("c", "b")])
def test_two_rows_after_one(spark, tmp_path, order):
    """Whichever was written last, and however often it is read, readers see the same run."""
    root = str(tmp_path)
    log_row(spark, root, "a", None, 0, "first")
    for entry in order:
        log_row(spark, root, entry, "a", 1, f"run-{entry}")
    assert {tables.last_success(spark, root)[0] for _ in range(4)} == {"run-b"}
    assert [r["entry"] for r in tables.history(spark, root)] == ["a", "b"]


def test_the_later_of_two_appends_again(spark, tmp_path, monkeypatch):
    """Another run's row appears between reading the head and writing after it."""
    root = str(tmp_path)
    first = end(spark, root, "r0")
    true_history, calls = tables.history, []

    def history(spark, root):
        found = true_history(spark, root)
        calls.append(len(found))
        if len(calls) == 1:
            log_row(spark, root, "0" * 20, found[-1]["entry"], found[-1]["seq"] + 1, "other")
        return found

    monkeypatch.setattr(tables, "history", history)
    tables.append_log(spark, root, "mine", "attempt-mine", tables.HALTED)
    monkeypatch.undo()
    counting = tables.history(spark, root)
    assert [r["run_id"] for r in counting] == ["r0", "other", "mine"]
    assert tables.run_log(spark, root).count() == 4
    # The halted run carries forward what the other one published meanwhile.
    assert tables.last_success(spark, root) == ("other", "attempt-other") and first != "attempt-other"


def test_clearing_leaves_what_can_be_reached(spark, tmp_path):
    root = str(tmp_path)
    a, b = end(spark, root, "r1"), end(spark, root, "r2")
    halted = end(spark, root, "r3", tables.HALTED)
    c, d = end(spark, root, "r4"), end(spark, root, "r5")
    running = tables.new_attempt()
    tables.write(spark.createDataFrame([("x",)], "doc_id string"), root, "raw", "r6", running)
    assert tables.roll_back(spark, root) == "r4"
    # The head is the roll-back of r5, whose tables stay as those of the last run.
    gone = tables.clear(spark, root)
    assert folders(root) == {a, b, c, d, running}
    assert {g.split("attempt=")[1] for g in gone} == {halted} and len(gone) == 2
    e = end(spark, root, "r7")
    tables.clear(spark, root, steps=1, abandoned=[running])
    assert folders(root) == {c, e}
    assert tables.roll_back(spark, root) == "r4"
    assert tables.read_published(spark, root, "store").first()["doc_id"] == "r4"


def test_empty_log(spark, tmp_path):
    root = str(tmp_path)
    assert tables.history(spark, root) == [] and tables.last_success(spark, root) is None
    assert tables.clear(spark, root) == []
    with pytest.raises(ValueError):
        tables.roll_back(spark, root)
