"""Map source columns onto the canonical record and bring the sources together."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clearfold.functions import text
from clearfold.schema import CANONICAL_COLUMNS, ORDER_COLUMN, SOURCE_STATS
from clearfold.settings import SOURCES

# Input positions of the first source start at 0, of the next at 2**58, and so on; what
# monotonically_increasing_id() can reach within a source stays far below.
SOURCE_STRIDE = 1 << 58


def _of(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def canonicalise(rows: DataFrame, mapping: Mapping[str, str | Column]) -> DataFrame:
    """Project a source onto the canonical columns, with their coercions.

    `mapping` names, per canonical column, a source column or gives an expression; a source
    column that does not exist is an error. Text that is no number for ocr_confidence is too.
    A missing key is the empty key, as a record without one still has its text.
    The input position (ingest_seq) is kept when the source already has one.
    """
    value = {c: _of(mapping[c]) for c in CANONICAL_COLUMNS}
    ocr = F.nullif(value["ocr_confidence"].cast("string"), F.lit("")).cast("double")
    coerced = {
        **value,
        "doc_id": text.strip_blanks(text.text_or_empty(value["doc_id"].cast("string"))),
        "version": text.blank_to_null(value["version"].cast("string")),
        "ocr_confidence": F.coalesce(ocr, F.lit(1.0)),
        "content": text.text_or_empty(value["content"]),
    }
    position = [ORDER_COLUMN] if ORDER_COLUMN in rows.columns else []
    return rows.select(*position, *(coerced[c].alias(c) for c in CANONICAL_COLUMNS))


def number(records: DataFrame, rank: int, position: Column | None = None) -> DataFrame:
    """Give one source's records their input positions, behind those of lower ranks.

    Without `position` the scan order is taken. That is only reproducible directly on the scan
    and has to be written (the raw snapshot) before anything shuffles the records.
    """
    within = F.monotonically_increasing_id() if position is None else position
    seq = (F.lit(rank).cast("bigint") * F.lit(SOURCE_STRIDE) + within).alias(ORDER_COLUMN)
    return records.select(seq, *CANONICAL_COLUMNS)


def union_sources(by_source: Mapping[str, DataFrame], names: Sequence[str] = SOURCES) -> DataFrame:
    """All sources in the order of `names`; each is numbered unless it already is.

    A source that `names` does not declare is an error, so that none is lost.
    """
    unknown = sorted(set(by_source) - set(names))
    if unknown:
        raise ValueError(f"undeclared sources: {', '.join(unknown)}")
    ranked = []
    for rank, name in enumerate(names):
        if name in by_source:
            records = by_source[name]
            ranked.append(records if ORDER_COLUMN in records.columns else number(records, rank))
    return reduce(DataFrame.unionByName, ranked)


def declared_sources(spark: SparkSession, names=SOURCES) -> DataFrame:
    return spark.createDataFrame([(n,) for n in names], "source_type string")


def source_counts(records: DataFrame, names=SOURCES) -> DataFrame:
    """Records per source; a declared one that delivered nothing counts 0, an undeclared one counts."""
    counted = records.groupBy("source_type").agg(F.count(F.lit(1)).alias("n"))
    declared = declared_sources(records.sparkSession, names)
    return declared.join(counted, "source_type", "full").select(
        "source_type", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_rows")
    )


def source_stats(counts: DataFrame, loaded_at: Mapping[str, datetime]) -> DataFrame:
    """Counts with each source's load time."""
    times = [(n, t) for n, t in loaded_at.items()]
    loads = counts.sparkSession.createDataFrame(times, "source_type string, loaded_at timestamp")
    joined = counts.join(F.broadcast(loads), "source_type", "left")
    return joined.select(*[f.split()[0] for f in SOURCE_STATS.split(", ")])
