"""A run's quality report as one long table (run_id, section, item, status, value, detail)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearfold.operators.expectations import halt_reasons


def _section(rows: DataFrame, run_id: str, section: str, item: Column, **columns: Column) -> DataFrame:
    return rows.select(
        F.lit(run_id).alias("run_id"),
        F.lit(section).alias("section"),
        item.alias("item"),
        columns.get("status", F.lit("")).alias("status"),
        columns.get("value", F.lit(None)).cast("double").alias("value"),
        columns.get("detail", F.lit("")).alias("detail"),
    )


def funnel_section(funnel: DataFrame, run_id: str) -> DataFrame:
    pairs = F.array(
        *(F.struct(F.lit(c).alias("item"), F.col(c).alias("value")) for c in funnel.columns)
    )
    return _section(
        funnel.select(F.inline(pairs)), run_id, "funnel", F.col("item"), value=F.col("value")
    )


def suite_section(suite: DataFrame, run_id: str) -> DataFrame:
    item = F.concat("name", F.lit("("), "column", F.lit(")"))
    status = F.when(F.col("success"), "PASS").otherwise("FAIL")
    detail = F.col("detail") if "detail" in suite.columns else F.lit("")
    return _section(
        suite, run_id, "suite", item, status=status, value=F.col("unexpected"), detail=detail
    )


def checks_section(checks: DataFrame, run_id: str) -> DataFrame:
    facts = {c: F.col(c) for c in ("status", "value", "detail")}
    return _section(checks, run_id, "checks", F.col("name"), **facts)


def lineage_section(edges: DataFrame, run_id: str) -> DataFrame:
    item = F.concat("from_node", F.lit(" -> "), "to_node")
    return _section(edges, run_id, "lineage", item, value=F.col("n_rows"))


def evaluation_section(evaluation: DataFrame, run_id: str) -> DataFrame:
    """Status is the verdict after cleaning, the value how many of the two answers are right."""
    right = F.col("before_correct").cast("int") + F.col("after_correct").cast("int")
    status = F.when(F.col("after_correct"), "CORRECT").otherwise("WRONG")
    detail = F.concat(F.col("before_doc"), F.lit(" -> "), F.col("after_doc"))
    item = F.col("question_id").cast("string")
    return _section(evaluation, run_id, "evaluation", item, status=status, value=right, detail=detail)


def run_section(results: DataFrame, edges: DataFrame, run_id: str) -> DataFrame:
    """Whether the run may publish and, if not, why; and how many records are in the store.

    `results` are the suite's, `edges` the lineage, whose last one ends in the store.
    """
    halted = halt_reasons(results)
    status = F.when(F.col("halt_reason").isNull(), "PUBLISHED").otherwise("HALTED")
    of_run = _section(
        halted, run_id, "run", F.lit("run_status"), status=status, detail=F.coalesce("halt_reason", F.lit(""))
    )
    stored = edges.where(F.col("to_node") == "vector_store")
    return of_run.unionByName(
        _section(stored, run_id, "run", F.lit("embedded_records"), value=F.col("n_rows"))
    )


def quality_report(
    run_id: str,
    funnel: DataFrame,
    suite: DataFrame,
    checks: DataFrame,
    edges: DataFrame,
    evaluation: DataFrame | None = None,
) -> DataFrame:
    sections = [
        run_section(suite, edges, run_id),
        funnel_section(funnel, run_id),
        suite_section(suite, run_id),
        checks_section(checks, run_id),
        lineage_section(edges, run_id),
    ]
    if evaluation is not None:
        sections.append(evaluation_section(evaluation, run_id))
    report = sections[0]
    for section in sections[1:]:
        report = report.unionByName(section)
    return report
