"""Tables a run writes, all Parquet, one directory per table, run and attempt.

Every attempt at a run writes directories of its own and touches no other. What readers see is
decided by the run log alone: an attempt is published by the one row appended last, so neither a
repeated run that halts nor one that is still writing changes anything they see. The log also says
which attempts nobody can return to, so that their tables may go.
"""

from __future__ import annotations

import tempfile
import time
import uuid
from collections.abc import Callable, Collection

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from clearfold.schema import BASELINE, RUN_LOG

# A raw table of 108 MB in Spark's default, Snappy, takes 69 MB.
CODEC = "zstd"
PUBLISHED, HALTED, ROLLED_BACK = "PUBLISHED", "HALTED", "ROLLED_BACK"


def new_attempt() -> str:
    return uuid.uuid4().hex


def partition_path(root: str, table: str, run_id: str, attempt: str) -> str:
    """The colon of a run id is no path character; it is escaped as Spark escapes it."""
    return f"{root}/{table}/run_id={run_id.replace(':', '%3A')}/attempt={attempt}"


def write(rows: DataFrame, root: str, table: str, run_id: str, attempt: str) -> DataFrame:
    """Write an attempt's part of a table and return it as read back, cut off from its lineage."""
    path = partition_path(root, table, run_id, attempt)
    rows.drop("run_id").write.mode("overwrite").parquet(path, compression=CODEC)
    return read(rows.sparkSession, root, table, run_id, attempt)


def read(spark: SparkSession, root: str, table: str, run_id: str, attempt: str) -> DataFrame:
    rows = spark.read.parquet(partition_path(root, table, run_id, attempt))
    return rows.withColumn("run_id", F.lit(run_id))


def export_csv(rows: DataFrame, path: str) -> None:
    """CSV files with a header and doubled quotes, one per partition of `rows`."""
    spaces = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    rows.write.mode("overwrite").options(header=True, quote='"', escape='"', **spaces).csv(path)


def shared_folder(spark: SparkSession) -> str:
    """The folder the session names in spark.checkpoint.dir.

    Where none is named, local mode gets a temporary one; on a cluster, whose machines could not
    all see that, it is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        named = tempfile.mkdtemp(prefix="checkpoint-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named


def materialised(rows: DataFrame, folder: str | None = None) -> DataFrame:
    """Rows that several parts of a plan read, written once to a folder that all machines share.

    Unlike a checkpointed DataFrame the table is columnar: each reader gets only its columns.
    """
    spark = rows.sparkSession
    path = f"{folder or shared_folder(spark)}/{uuid.uuid4()}"
    rows.write.parquet(path, compression=CODEC)
    return spark.read.schema(rows.schema).parquet(path)


def run_log(spark: SparkSession, root: str) -> DataFrame:
    """(entry, follows, seq, run_id, attempt, status, last_success_run, last_success_attempt), one row
    per ended run or roll-back; empty at first. `follows` names the entry that was the head before."""
    try:
        return spark.read.schema(RUN_LOG).parquet(f"{root}/run_log")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], RUN_LOG)
        raise


def history(spark: SparkSession, root: str) -> list[Row]:
    """The log's rows that count, first to last; a row per run, small enough for the driver.

    Two runs that end at once may follow the same entry. Whoever reads the log takes the same one of
    them as its head: the row farthest from the start, of equally far ones the earliest entry. What
    that row follows counts with it, and no other row does.
    """
    rows = {r["entry"]: r for r in run_log(spark, root).collect()}
    head = min(rows.values(), key=lambda r: (-r["seq"], r["entry"]), default=None)
    counting = []
    while head is not None:
        counting.append(head)
        head = rows.get(head["follows"])
    return counting[::-1]


def state(spark: SparkSession, root: str) -> Row | None:
    """The log's head."""
    return next(reversed(history(spark, root)), None)


def _seen(head: Row | None) -> tuple[str, str] | None:
    if head is None or head["last_success_run"] is None:
        return None
    return head["last_success_run"], head["last_success_attempt"]


def last_success(spark: SparkSession, root: str) -> tuple[str, str] | None:
    """Run and attempt that readers see."""
    return _seen(state(spark, root))


def _append(
    spark: SparkSession, root: str, run: tuple[str, str], status: str,
    seen: Callable[[list[Row]], tuple[str, str] | None],
) -> None:
    """Append a row after the head. Where another run was faster and its row counts instead, append
    again after that one; `seen` tells from the rows that count what readers are to see."""
    while True:
        before = history(spark, root)
        head = before[-1] if before else None
        entry = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
        follows, seq = (head["entry"], head["seq"] + 1) if head else (None, 0)
        row = (entry, follows, seq, *run, status, *(seen(before) or (None, None)))
        spark.createDataFrame([row], RUN_LOG).coalesce(1).write.mode("append").parquet(f"{root}/run_log")
        if any(r["entry"] == entry for r in history(spark, root)):
            return


def append_log(spark: SparkSession, root: str, run_id: str, attempt: str, status: str) -> None:
    """A halted run carries the last successful one forward."""
    run = (run_id, attempt)
    _append(spark, root, run, status, lambda log: run if status == PUBLISHED else _seen(log[-1] if log else None))


def load_baseline(spark: SparkSession, root: str) -> DataFrame:
    """Source counts of the last published run; empty before there is one."""
    counts = read_published(spark, root, "baseline")
    if counts is None:
        return spark.createDataFrame([], BASELINE)
    return counts.select("source_type", "n_rows")


def read_published(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    """A table as of the last published run."""
    published = last_success(spark, root)
    return None if published is None else read(spark, root, table, *published)


def _previous(log: list[Row], current: tuple[str, str] | None) -> tuple[str, str] | None:
    """What was published before the current run first was, and has not been rolled back since."""
    if current is None:
        return None
    first = min((r["seq"] for r in log if r["status"] == PUBLISHED and r["run_id"] == current[0]), default=None)
    left = {r["run_id"]: r["seq"] for r in log if r["status"] == ROLLED_BACK}
    standing = [
        r for r in log
        if first is not None and r["status"] == PUBLISHED and r["seq"] < first and left.get(r["run_id"], -1) < r["seq"]
    ]
    return (standing[-1]["run_id"], standing[-1]["attempt"]) if standing else None


def roll_back(spark: SparkSession, root: str) -> str:
    """Publish again what was published before the current run first was; nothing is rewritten.

    What has been rolled back before is not returned to, so that repeated calls go back step by
    step.
    """
    log = history(spark, root)
    current = _seen(log[-1]) if log else None
    previous = _previous(log, current)
    if previous is None:
        raise ValueError("no earlier published run to roll back to")
    _append(spark, root, current, ROLLED_BACK, lambda _: previous)
    return previous[0]


def reachable(log: list[Row], steps: int | None = None) -> set[str]:
    """Attempts that readers see or roll-backs, `steps` at most, can return to; and the last run's."""
    found, current = {log[-1]["attempt"]} if log else set(), _seen(log[-1]) if log else None
    while current is not None:
        found.add(current[1])
        if steps is not None:
            steps -= 1
            if steps < 0:
                break
        current = _previous(log, current)
    return found


def clear(spark: SparkSession, root: str, steps: int | None = None, abandoned: Collection[str] = ()) -> list[str]:
    """Delete the tables of ended attempts that nothing can return to; their paths below `root`.

    An attempt that is not in the log may still be writing and stays, unless the caller names it as
    abandoned. The log itself is kept whole. With `steps`, only that many roll-backs stay possible.
    """
    every = run_log(spark, root).select("attempt").distinct().collect()
    doomed = ({r["attempt"] for r in every} | set(abandoned)) - reachable(history(spark, root), steps)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    base = hadoop.Path(root)
    files = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    gone = []
    for status in files.globStatus(hadoop.Path(f"{root}/*/run_id=*/attempt=*")) or []:
        path = status.getPath()
        if path.getName().removeprefix("attempt=") in doomed:
            files.delete(path, True)
            parent = path.getParent()
            gone.append(f"{parent.getParent().getName()}/{parent.getName()}/{path.getName()}")
            if not files.listStatus(parent):
                files.delete(parent, False)
    return sorted(gone)
