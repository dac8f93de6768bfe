"""Canonical raw records derived by fixed rules from the documents and labels tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clearfold.schema import CANONICAL_COLUMNS, ORDER_COLUMN
from clearfold.settings import REPLACEMENT_CHAR
from clearfold.sources.canonical import canonicalise


# Schemas of the tables read, so that no job has to look them up.
SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "benchmark": "item_id bigint, text string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str, key: str | None = None) -> DataFrame:
    """A given table; with a unique key, always spread over the session's shuffle partitions.

    The given files may be few and large, or be one row group, which one task would have to read
    and work through. A join on the key uses the same partitioning.
    """
    rows = spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")
    return rows.repartition(key) if key else rows


def source_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records as a source would hand them over: unparsed dates and OCR confidence as text."""
    docs = table(spark, sf_dir, "documents", "doc_id").select("doc_id", "text", "lang")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    day = "date_add(date'2026-01-01', int(doc_id * 7 % 60))"
    source = "CASE lang WHEN 'de' THEN 'postgres' WHEN 'es' THEN 'jira' ELSE 'file' END"
    return docs.join(labels, "doc_id", "left").selectExpr(
        f"doc_id AS {ORDER_COLUMN}",
        "substring(sha2(substring_index(text, '\\n', 1), 256), 1, 12) AS doc_id",
        f"{source} AS source_type",
        f"concat({source}, '/', string(doc_id)) AS source_uri",
        "substring_index(text, '\\n', 1) AS title",
        f"""CASE WHEN doc_id % 50 = 9 THEN NULL
                 WHEN doc_id % 50 = 19 THEN '2026-13-45'
                 WHEN doc_id % 10 = 6 THEN date_format({day}, 'dd/MM/yyyy')
                 WHEN doc_id % 10 = 7 THEN date_format({day}, 'dd/MM/yy')
                 WHEN doc_id % 10 = 8 THEN date_format({day}, 'yyyy/MM/dd')
                 ELSE date_format({day}, 'yyyy-MM-dd') END AS effective_date""",
        "CASE WHEN doc_id % 4 = 3 THEN '' ELSE concat('v', doc_id % 4 + 1) END AS version",
        "CASE quality WHEN 0 THEN '0.55' WHEN 1 THEN '0.95' END AS ocr_confidence",
        f"""CASE WHEN doc_id % 97 = 13 THEN '   '
                 WHEN doc_id % 89 = 5 THEN concat(text, ' {REPLACEMENT_CHAR}')
                 ELSE text END AS content""",
    )


def kb_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    handed = source_records(spark, sf_dir)
    return canonicalise(handed, {c: c for c in CANONICAL_COLUMNS})
