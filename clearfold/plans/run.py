"""One publishing run: ingest, clean, monitor, validate, embed, publish.

Stages meet in written tables of the attempt, which survive lost executors and are read back with only the
columns the next stage needs. The texts are shuffled once, to join the cleaned ones with their
verdicts; verdicts, quarantine, checks and gate all work on narrow rows.

    spark-submit clearfold/plans/run.py --tickets t.csv --issues i.json --documents d.csv --root out
"""

from __future__ import annotations

import argparse
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearfold.operators import cleaning, evaluation, expectations, monitors, retrieval, sketches
from clearfold.plans import report
from clearfold.schema import EVALUATION_COLUMNS, ORDER_COLUMN
from clearfold.settings import SOURCES, Thresholds, parse_now, run_id_of
from clearfold.sources import canonical, readers, tables


@dataclass(frozen=True)
class RunResult:
    run_id: str
    attempt: str
    status: str
    halt_reason: str | None
    funnel: dict[str, int]
    embedded: int
    worst: str
    suite: list = field(default_factory=list)

    @property
    def exit_code(self) -> int:
        return 1 if self.halt_reason else 0


def _total(spark: SparkSession, n: int) -> DataFrame:
    return spark.createDataFrame([(n,)], "n_rows bigint")


def run(
    spark: SparkSession,
    by_source: Mapping[str, DataFrame],
    root: str,
    now: datetime,
    loaded_at: Mapping[str, datetime] | None = None,
    questions: DataFrame | None = None,
    thresholds: Thresholds = Thresholds(),
    slas: DataFrame | None = None,
    warn_low_ocr: bool = False,
    approximate: bool = False,
) -> RunResult:
    """Run over canonical records per source, writing every table under `root`.

    `questions`: question_id, question, expect_keywords, stale_marker. `slas`: source_type,
    sla_hours, where sources differ. `warn_low_ocr` adds the check of kept but doubtful scans.
    `approximate` takes median length and distinct keys from sketches, which it stores as a table.
    """
    run_id, attempt = run_id_of(now), tables.new_attempt()

    def keep(rows: DataFrame, table: str) -> DataFrame:
        return tables.write(rows, root, table, run_id, attempt).drop("run_id")

    raw = keep(canonical.union_sources(by_source), "raw")
    counts = keep(canonical.source_counts(raw), "source_counts")
    stats = canonical.source_stats(counts, loaded_at or {s: now for s in SOURCES})

    staged = keep(cleaning.narrow(cleaning.stage(raw)), "staged")
    routed = keep(cleaning.outcomes(staged, thresholds), "outcomes")
    keep(cleaning.quarantine_rows(routed, run_id), "quarantine")
    cleaned = keep(cleaning.cleaned_texts(raw, routed), "cleaned")
    funnel = keep(cleaning.funnel(routed), "funnel")

    in_store_order = F.col("group_seq").alias(ORDER_COLUMN)
    kept = routed.where(cleaning.is_cleaned()).select(
        in_store_order, *[c for c in routed.columns if c != ORDER_COLUMN]
    )
    baseline = tables.load_baseline(spark, root)
    estimated = sketches.estimates(keep(sketches.of_sources(kept), "sketches")) if approximate else None
    checks = monitors.monitor(kept, stats, baseline, now, thresholds, raw, slas, estimated)
    if warn_low_ocr:
        checks = checks.unionByName(monitors.check_low_ocr(kept, thresholds))
    checks = keep(checks, "checks")

    results = keep(expectations.run_suite(kept), "suite_results")
    embedded, halted, suite, judged = 0, None, results, None
    try:
        collected = expectations.validate_or_halt(results)
    except expectations.PipelineHalt as halt:
        halted, collected = str(halt), results.collect()
        suite = expectations.with_samples(results, expectations.failure_samples(kept))
    suite = keep(suite if halted else results.withColumn("detail", F.lit("")), "suite")

    if halted is None:
        store = keep(retrieval.build_store(cleaning.of_knowledge_source(cleaned)), "store")
        embedded = store.count()
        keep(retrieval.postings(store), "postings")
        keep(counts, "baseline")
        if questions is not None:
            before = retrieval.build_store(cleaning.knowledge_rows(raw))
            both = evaluation.both_stores(before, store)
            judged = keep(evaluation.before_after(both, questions, run_id), "evaluation")
            with_run = judged.withColumn("run_id", F.lit(run_id)).select(EVALUATION_COLUMNS)
            tables.export_csv(with_run, tables.partition_path(root, "evaluation_csv", run_id, attempt))

    totals = funnel.first().asDict()
    edges = monitors.lineage(
        counts, _total(spark, totals["cleaned"]), _total(spark, embedded), run_id
    )
    edges = keep(edges, "lineage")
    keep(report.quality_report(run_id, funnel, suite, checks, edges, judged), "quality_report")

    status = tables.HALTED if halted else tables.PUBLISHED
    tables.append_log(spark, root, run_id, attempt, status)
    worst = monitors.worst_status(checks).first()["worst"]
    return RunResult(run_id, attempt, status, halted, totals, embedded, worst, collected)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    for source in ("tickets", "issues", "documents"):
        p.add_argument(f"--{source}", required=True, nargs="+", help=f"{source} files")
    p.add_argument("--issue-lines", action="store_true", help="issues are JSON lines, not arrays")
    p.add_argument("--questions", help="JSON lines: question_id, question, expect_keywords, stale_marker")
    p.add_argument("--root", required=True, help="folder of the run's tables")
    p.add_argument("--loaded", nargs="*", default=[], metavar="SOURCE=TIME", help="when sources were loaded, ISO 8601")
    p.add_argument("--sla", nargs="*", default=[], metavar="SOURCE=HOURS", help="freshness SLAs that differ")
    p.add_argument("--approximate", action="store_true", help="median and distinct keys from sketches")
    p.add_argument("--now", help="the run's clock, ISO 8601")
    args = p.parse_args(argv)

    builder = SparkSession.builder.appName("clearfold").config("spark.sql.session.timeZone", "UTC")
    spark = builder.config("spark.python.sql.dataFrameDebugging.enabled", "false").getOrCreate()
    by_source = {
        "postgres": readers.read_tickets(spark, args.tickets),
        "jira": readers.read_issues(spark, args.issues, args.issue_lines),
        "file": readers.read_documents(spark, args.documents),
    }
    asked = None
    if args.questions:
        schema = "question_id string, question string, expect_keywords array<string>, stale_marker string"
        asked = spark.read.schema(schema).json(args.questions)
    now = parse_now(args.now)
    loaded = {s: now for s in SOURCES} | {s: parse_now(t) for s, t in (x.split("=", 1) for x in args.loaded)}
    slas = [(s, float(h)) for s, h in (x.split("=", 1) for x in args.sla)]
    slas = spark.createDataFrame(slas, "source_type string, sla_hours double") if slas else None
    result = run(spark, by_source, args.root, now, loaded, asked, slas=slas, approximate=args.approximate)
    print(f"run_id={result.run_id} status={result.status} monitor worst={result.worst}")
    for name, n in result.funnel.items():
        print(f"{name}={n}")
    print(f"embedded={result.embedded}")
    if result.halt_reason:
        print(result.halt_reason)
    return result.exit_code


if __name__ == "__main__":
    raise SystemExit(main())
