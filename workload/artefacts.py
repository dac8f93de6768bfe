"""Queries over what a publishing run leaves behind, and over files written and read again."""

from __future__ import annotations

from datetime import timedelta
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clearfold.operators import monitors, retrieval, sketches
from clearfold.plans.run import RunResult, run
from clearfold.schema import CANONICAL_COLUMNS, ORDER_COLUMN
from clearfold.settings import KNOWLEDGE_SOURCE, SOURCES
from clearfold.sources import canonical, readers, tables
from workload.kb_raw import kb_raw, source_records
from workload.queries import NOW, questions

TICKET_COLUMNS = {
    "ticket_id": "doc_id", "source_uri": "source_uri", "subject": "title", "updated_at": "effective_date",
    "priority": "CAST(NULL AS STRING)", "status": "CAST(NULL AS STRING)", "body": "content",
}
ISSUE_COLUMNS = {"key": "doc_id", "summary": "title", "updated": "effective_date", "description": "content"}
# Neighbouring records that share a file, where their order in files matters.
SHARD = 1000
DOCUMENT_COLUMNS = [c for c in CANONICAL_COLUMNS if c != "source_type"]


def _folder(spark: SparkSession) -> str:
    return f"{tables.shared_folder(spark)}/{tables.new_attempt()}"


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tickets and documents written as their sources would hand them over, and read again."""
    folder, records = _folder(spark), source_records(spark, sf_dir)
    tickets = records.where("source_type = 'postgres'").selectExpr(*(f"{v} AS {k}" for k, v in TICKET_COLUMNS.items()))
    tables.export_csv(tickets, f"{folder}/tickets")
    tables.export_csv(records.where("source_type = 'file'").select(DOCUMENT_COLUMNS), f"{folder}/documents")
    back = readers.read_tickets(spark, f"{folder}/tickets")
    return back.unionByName(readers.read_documents(spark, f"{folder}/documents")).drop(ORDER_COLUMN)


def issues_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, records = _folder(spark), source_records(spark, sf_dir)
    issue = F.struct(*(F.expr(v).alias(k) for k, v in ISSUE_COLUMNS.items()))
    lines = records.where("source_type = 'jira'").select(F.to_json(issue, {"ignoreNullFields": "false"}).alias("value"))
    lines.write.text(f"{folder}/issues")
    return readers.read_issues(spark, f"{folder}/issues", lines=True).drop(ORDER_COLUMN)


def csv_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tickets in several files, in order within each, and the positions they are read with."""
    tickets = source_records(spark, sf_dir).where("source_type = 'postgres'")
    row = tickets.selectExpr(*(f"{v} AS {k}" for k, v in TICKET_COLUMNS.items()), ORDER_COLUMN)
    shard = F.lpad((F.col(ORDER_COLUMN) / SHARD).cast("bigint").cast("string"), 12, "0")
    in_order = row.withColumn("shard", shard).repartition("shard").sortWithinPartitions("shard", ORDER_COLUMN)
    folder = _folder(spark)
    options = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    in_order.drop(ORDER_COLUMN).write.partitionBy("shard").options(**options).csv(f"{folder}/tickets")
    return readers.read_tickets(spark, f"{folder}/tickets").select(ORDER_COLUMN, "doc_id", "source_uri", "content")


def issue_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issues as files that each hold one JSON array, on several lines, and read again."""
    records = source_records(spark, sf_dir).where("source_type = 'jira'")
    issue = F.struct(*(F.expr(v).alias(k) for k, v in ISSUE_COLUMNS.items()))
    text = F.to_json(issue, {"ignoreNullFields": "false"})
    file = (F.col(ORDER_COLUMN) / SHARD).cast("bigint").alias("file")
    # The first object of a file brings the opening bracket, the others a comma, the last the closing one.
    # Lines of their own, united with the objects, could come to another task than these.
    placed = records.select(file, ORDER_COLUMN, text.alias("value")).repartition("file")
    in_file = Window.partitionBy("file").orderBy(ORDER_COLUMN)
    before = F.when(F.row_number().over(in_file) == 1, "[\n").otherwise(", ")
    after = F.when(F.lead(ORDER_COLUMN).over(in_file).isNull(), "\n]").otherwise("")
    whole = placed.select("file", ORDER_COLUMN, F.concat(before, "value", after).alias("value"))
    lines = whole.sortWithinPartitions("file", ORDER_COLUMN)
    folder = _folder(spark)
    lines.drop(ORDER_COLUMN).write.partitionBy("file").text(f"{folder}/issues")
    return readers.read_issues(spark, f"{folder}/issues").drop(ORDER_COLUMN)


def raw_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.write(kb_raw(spark, sf_dir), _folder(spark), "raw", "r", tables.new_attempt()).drop("run_id")


def _by_source(records: DataFrame, names=SOURCES) -> dict[str, DataFrame]:
    return {
        name: canonical.number(records.where(F.col("source_type") == name), rank, F.col(ORDER_COLUMN))
        for rank, name in enumerate(SOURCES)
        if name in names
    }


def _readable(records: DataFrame) -> DataFrame:
    """Days that do not exist are left out, which makes their records undated."""
    return records.withColumn("effective_date", F.expr("nullif(effective_date, '2026-13-45')"))


def _two_runs(spark: SparkSession, handed: DataFrame, root: str) -> None:
    """A run over all sources, every record in version v0, and a day later one over issues and
    documents in their own versions."""
    records = _readable(handed)
    run(spark, _by_source(records.withColumn("version", F.lit("v0"))), root, NOW)
    run(spark, _by_source(records, ("jira", "file")), root, NOW + timedelta(days=1))


@lru_cache(maxsize=4)
def _scenario(spark: SparkSession, application: str, sf_dir: str) -> tuple[str, RunResult]:
    """Two published runs, then the second repeated with unreadable days: the root and the result."""
    root, handed = _folder(spark), tables.materialised(kb_raw(spark, sf_dir))
    _two_runs(spark, handed, root)
    return root, run(spark, _by_source(handed), root, NOW + timedelta(days=1))


def _published(spark: SparkSession, sf_dir: str) -> tuple[str, RunResult]:
    return _scenario(spark, spark.sparkContext.applicationId, sf_dir)


def _store(spark: SparkSession, root: str) -> DataFrame:
    return tables.read_published(spark, root, "store").select("chunk_order", "doc_id", "version", "effective_date", "text")


def published_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _store(spark, _published(spark, sf_dir)[0])


def published_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best chunks of the published store, found in its inverted index alone."""
    index = tables.read_published(spark, _published(spark, sf_dir)[0], "postings")
    found = retrieval.matches(index, questions(spark, sf_dir), 5)
    return found.select("question_id", F.col("rank").cast("bigint").alias("rank"), "chunk_order", "score")


def baseline_after_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.load_baseline(spark, _published(spark, sf_dir)[0])


def run_state_after_halt(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = tables.run_log(spark, _published(spark, sf_dir)[0])
    same = F.col("attempt") == F.col("last_success_attempt")
    return log.select("seq", "run_id", "status", "last_success_run", same.alias("readers_see_it"))


def gate_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, halted = _published(spark, sf_dir)
    report = tables.read(spark, root, "quality_report", halted.run_id, halted.attempt)
    return report.where("section = 'run'").select("run_id", "item", "status", "value", "detail")


def rolled_back_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _folder(spark)
    _two_runs(spark, kb_raw(spark, sf_dir), root)
    tables.roll_back(spark, root)
    return _store(spark, root).withColumn("source", F.lit(KNOWLEDGE_SOURCE))


def _sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Estimates over the stored sketches of two runs, each of which saw half of the records."""
    root, attempt, records = _folder(spark), tables.new_attempt(), kb_raw(spark, sf_dir)
    for half in (0, 1):
        own = sketches.of_sources(records.where(F.col(ORDER_COLUMN) % 2 == half))
        tables.write(own, root, "sketches", f"run{half}", attempt)
    return sketches.estimates(spark.read.parquet(f"{root}/sketches"))


def approximate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct keys, and whether the merged sketches tell them to within their error."""
    counted = monitors.cardinality(kb_raw(spark, sf_dir)).withColumn("one", F.lit(1))
    told = _sketched(spark, sf_dir).select(F.lit(1).alias("one"), F.col("doc_ids").alias("told"))
    off = F.abs(F.col("told") - F.col("doc_ids")) / F.col("doc_ids")
    return counted.join(told, "one").select("doc_ids", (off <= sketches.KEYS_WITHIN).alias("is_near"))


def approximate_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Least and greatest length, and whether the merged sketches' median has a rank near a half."""
    told = _sketched(spark, sf_dir).first()
    lengths = monitors.measured(kb_raw(spark, sf_dir)).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("content_length") < told["median_length"]).alias("below"),
        F.count_if(F.col("content_length") <= told["median_length"]).alias("up_to"),
    )
    least, most = (0.5 - sketches.RANK_WITHIN) * F.col("n"), (0.5 + sketches.RANK_WITHIN) * F.col("n")
    return lengths.select(
        F.lit(told["n_rows"]).cast("bigint").alias("n_rows"),
        F.lit(told["min_length"]).cast("bigint").alias("min_length"),
        F.lit(told["max_length"]).cast("bigint").alias("max_length"),
        ((F.col("below") <= most) & (F.col("up_to") >= least)).alias("is_near"),
    )


def evaluation_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The evaluation that a run leaves as CSV, read again."""
    root = _folder(spark)
    asked = questions(spark, sf_dir)
    done = run(spark, _by_source(_readable(kb_raw(spark, sf_dir))), root, NOW, questions=asked)
    path = tables.partition_path(root, "evaluation_csv", done.run_id, done.attempt)
    back = spark.read.options(header=True, quote='"', escape='"', multiLine=True).csv(path)
    typed = {"question_id": "bigint", "before_correct": "boolean", "after_correct": "boolean"}
    return back.withColumns({c: F.col(c).cast(t) for c, t in typed.items()})


def load_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each source's records and the hours since it was loaded; issues were never loaded."""
    loaded = {"postgres": NOW - timedelta(hours=3), "file": NOW - timedelta(minutes=45)}
    stats = canonical.source_stats(canonical.source_counts(kb_raw(spark, sf_dir)), loaded)
    since = monitors.hours_since(monitors.utc("loaded_at", stats), monitors.utc_literal(NOW))
    return stats.select("source_type", "n_rows", since.alias("hours"))


def empty_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks of what was cleaned from records of an undeclared source, of which there are none."""
    return monitors.check_distribution(kb_raw(spark, sf_dir).where(~F.col("source_type").isin(*SOURCES)))


ARTEFACTS = {
    q.__name__: q
    for q in (
        csv_round_trip, csv_positions, issues_round_trip, issue_arrays, raw_snapshot, published_store, published_topk, baseline_after_publish,
        run_state_after_halt, gate_reason, rolled_back_store, approximate_keys, approximate_median,
        evaluation_csv, load_times, empty_batch,
    )
}
