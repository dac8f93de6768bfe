"""Schemas of the canonical record and of the tables a run writes."""

from __future__ import annotations

from pyspark.sql import types as T

# The column names of the contract and of the tables a run writes.
CANONICAL_COLUMNS = [
    "doc_id",
    "source_type",
    "source_uri",
    "title",
    "effective_date",
    "version",
    "ocr_confidence",
    "content",
]

# Spark rows have no order, so the input position is a column of its own.
ORDER_COLUMN = "ingest_seq"

CANONICAL = T.StructType(
    [T.StructField(ORDER_COLUMN, T.LongType(), False)]
    + [
        T.StructField(c, T.DoubleType() if c == "ocr_confidence" else T.StringType())
        for c in CANONICAL_COLUMNS
    ]
)

CLEANED_COLUMNS = CANONICAL_COLUMNS + ["effective_date_status", "content_hash"]

QUARANTINE_COLUMNS = [
    "run_id",
    "doc_id",
    "source_type",
    "source_uri",
    "action",
    "reason",
    "content",
]

EVALUATION_COLUMNS = [
    "run_id", "question_id", "question", "before_answer", "before_doc", "before_correct",
    "after_answer", "after_doc", "after_version", "after_effective_date", "after_correct",
]

CHECKS = "pillar string, name string, status string, value double, detail string"
SUITE = (
    "ordinal int, name string, column string, success boolean, unexpected bigint, detail string"
)
BASELINE = "source_type string, n_rows bigint"
RUN_LOG = (
    "entry string, follows string, seq bigint, run_id string, attempt string, status string, "
    "last_success_run string, last_success_attempt string"
)
SOURCE_STATS = "source_type string, n_rows bigint, loaded_at timestamp"
