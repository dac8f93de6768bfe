"""Expectations on a table's columns, and the gate that stops a run that fails them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clearfold.functions.dates import is_calendar_date
from clearfold.functions.text import is_blank
from clearfold.schema import ORDER_COLUMN
from clearfold.settings import ISO_DATE_PATTERN

SAMPLE_SIZE = 3


class PipelineHalt(Exception):
    """The data breaks its contract; nothing may be published."""


@dataclass(frozen=True)
class Expectation:
    """Any condition a row's value must meet; `met` is None for uniqueness, which has no row form.

    `shown` names the column that samples are taken from, where that is another.
    """

    name: str
    column: str
    met: Column | None = None
    shown: str | None = None


def not_null(column: str) -> Expectation:
    """Neither null nor blank."""
    return Expectation("not_null", column, ~is_blank(F.col(column).cast("string")))


def has_content() -> Expectation:
    """not_null of the content of narrow rows, which carry whether it is blank, and a preview."""
    return Expectation("not_null", "content", ~F.col("content_blank"), "content_preview")


def unique(column: str) -> Expectation:
    """No value twice; null counts as a value."""
    return Expectation("unique", column)


def match_regex(column: str, pattern: str) -> Expectation:
    """The pattern matches from the start of the value."""
    return Expectation(
        "match_regex", column, F.col(column).cast("string").rlike(f"^(?:{pattern})")
    )


def valid_date(column: str) -> Expectation:
    """A day that exists, written year-month-day."""
    return Expectation("valid_date", column, is_calendar_date(F.col(column).cast("string")))


def default_suite(rows: DataFrame) -> list[Expectation]:
    """The contract's suite, for narrow rows or such as still have their content."""
    return [
        has_content() if "content_blank" in rows.columns else not_null("content"),
        unique("doc_id"),
        not_null("effective_date"),
        match_regex("effective_date", ISO_DATE_PATTERN),
        valid_date("effective_date"),
    ]


def _broken(e: Expectation) -> Column:
    return ~F.coalesce(e.met, F.lit(False))


def _repeated(rows: DataFrame, column: str) -> DataFrame:
    keys = rows.groupBy(F.col(column).cast("string").alias("value")).agg(
        F.count(F.lit(1)).alias("n"), F.min(ORDER_COLUMN).alias("at")
    )
    return keys.where(F.col("n") > 1)


def run_suite(rows: DataFrame, expectations: Sequence[Expectation] | None = None) -> DataFrame:
    """One row per expectation: (ordinal, name, column, success, unexpected).

    All row conditions are counted in a single pass. Uniqueness counts repeated values, not rows.
    """
    suite = list(enumerate(expectations if expectations is not None else default_suite(rows)))
    by_row = [(i, e) for i, e in suite if e.met is not None]
    parts = []
    if by_row:
        counts = rows.agg(*(F.count_if(_broken(e)).alias(f"n{i}") for i, e in by_row))
        results = [_result(i, e, F.col(f"n{i}")) for i, e in by_row]
        parts.append(counts.select(F.inline(F.array(*results))))
    for i, e in suite:
        if e.met is None:
            repeats = _repeated(rows, e.column).agg(F.count(F.lit(1)).alias("n"))
            parts.append(repeats.select(F.inline(F.array(_result(i, e, F.col("n"))))))
    results = parts[0]
    for part in parts[1:]:
        results = results.unionByName(part)
    return results


def _result(ordinal: int, e: Expectation, unexpected: Column) -> Column:
    return F.struct(
        F.lit(ordinal).alias("ordinal"),
        F.lit(e.name).alias("name"),
        F.lit(e.column).alias("column"),
        (unexpected == 0).alias("success"),
        unexpected.alias("unexpected"),
    )


def failure_samples(
    rows: DataFrame, expectations: Sequence[Expectation] | None = None, size: int = SAMPLE_SIZE
) -> DataFrame:
    """The first few offending values or keys of each expectation, by input order.

    (ordinal, name, column, position, value). The rank limit is applied in every task before
    rows meet, so an expectation that nearly all rows fail does not gather them.
    """
    suite = list(enumerate(expectations if expectations is not None else default_suite(rows)))
    parts = []
    for i, e in suite:
        if e.met is None:
            bad = _repeated(rows, e.column).select("at", "value")
        else:
            bad = rows.where(_broken(e)).select(
                F.col(ORDER_COLUMN).alias("at"), F.col(e.shown or e.column).cast("string").alias("value")
            )
        first = bad.withColumn("ordinal", F.lit(i)).withColumns(
            {"name": F.lit(e.name), "column": F.lit(e.column)}
        )
        parts.append(first)
    bad = parts[0]
    for part in parts[1:]:
        bad = bad.unionByName(part)
    order = W.partitionBy("ordinal").orderBy("at")
    ranked = bad.withColumn("position", F.row_number().over(order)).where(F.col("position") <= size)
    return ranked.select("ordinal", "name", "column", "position", "value")


def with_samples(results: DataFrame, samples: DataFrame) -> DataFrame:
    """Suite results with a detail text listing the sampled values."""
    listed = samples.groupBy("ordinal").agg(
        F.sort_array(F.collect_list(F.struct("position", "value"))).alias("s")
    )
    values = F.transform("s", lambda s: F.coalesce(s["value"], F.lit("null")))
    detail = listed.select("ordinal", F.concat(F.lit("e.g. "), F.array_join(values, ", ")).alias("detail"))
    return results.join(F.broadcast(detail), "ordinal", "left").withColumn(
        "detail", F.coalesce("detail", F.lit(""))
    )


# Fixed value: how a halt announces itself.
HALT_PREFIX = "bad data before agent -> "


def halt_reasons(results: DataFrame) -> DataFrame:
    """(halt_reason): one row, null when every expectation is met."""
    item = F.format_string("%s(%s)=%d", "name", "column", "unexpected")
    broken = F.when(~F.col("success"), F.struct("ordinal", item.alias("item")))
    listed = results.agg(F.sort_array(F.collect_list(broken)).alias("failed"))
    text = F.concat(F.lit(HALT_PREFIX), F.array_join("failed.item", "; "))
    return listed.select(F.when(F.size("failed") > 0, text).alias("halt_reason"))


def validate_or_halt(results: DataFrame) -> list[Row]:
    """Collect the suite's few result rows; raise when one failed."""
    reason = halt_reasons(results).first()["halt_reason"]
    if reason:
        raise PipelineHalt(reason)
    return results.orderBy("ordinal").collect()
