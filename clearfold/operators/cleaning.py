"""Normalise, dedupe, supersede and route canonical records.

Every decision is taken on narrow rows (no title, no content beyond a preview), with
aggregations that combine on the map side and joins on keys that cannot be hot:

* duplicates: one minimum per (doc_id, source_type, content_hash); a group of copies that holds
  a third of the corpus leaves each map task as a single row;
* superseding: one maximum per doc_id, handed back on (doc_id, salt) where a doc_id has several
  contents;
* the verdicts meet the records again on ingest_seq, which is unique.

Positions, dates and flags are packed into one decimal, so minima and maxima carry their record's
facts through hash aggregation. Narrow rows are meant to be written once: the texts are then
normalised and hashed a single time.

No window is partitioned by a data key, so no key's records have to fit one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearfold.functions import dates, text
from clearfold.schema import CLEANED_COLUMNS, ORDER_COLUMN
from clearfold.settings import KNOWLEDGE_SOURCE, Thresholds
from clearfold.sources.tables import materialised

# Outcomes a record can have besides being cleaned (action null).
REJECT, FLAG = "reject", "flag"
EMPTY = "empty_content"
DUPLICATE = "duplicate_content_hash"
SUPERSEDED_BY = "superseded_by_"
SUPERSEDED_NO_DATE = "superseded_no_date"
MISSING_DATE = "review_missing_date"
LOW_OCR = "review_low_ocr"

# Parts a doc_id's records are spread over when they look up their group's survivor.
SALTS = 256

_FACTS = ["effective_date", "effective_date_status", "version", "ocr_confidence", "has_replacement_char"]


def stage(records: DataFrame) -> DataFrame:
    """Normalised records with date status, content hash and the replacement-character flag.

    A record without content keeps its raw date and gets neither status nor hash.
    """
    composed = records.withColumns(
        {
            "doc_id": text.text_or_empty(F.col("doc_id")),
            "title": text.collapse_blanks(text.nfc(text.text_or_empty(F.col("title")))),
            "_nfc": text.nfc(text.text_or_empty(F.col("content"))),
        }
    )
    trimmed = composed.withColumns(
        {
            "content": text.collapse_blanks(F.col("_nfc")),
            "has_replacement_char": text.has_replacement_char(F.col("_nfc")),
            "_date": dates.parse_date(F.col("effective_date")),
        }
    )
    filled = F.col("content") != ""
    raw_date, parsed = F.col("effective_date"), F.col("_date")
    hashed = text.content_hash(F.col("source_type"), F.col("doc_id"), F.col("content"))
    return trimmed.withColumns(
        {
            "effective_date": F.when(filled, dates.normalised_date(raw_date, parsed)).otherwise(raw_date),
            "effective_date_status": F.when(filled, dates.date_status(raw_date, parsed)),
            "content_hash": F.when(filled, hashed),
        }
    ).drop("_nfc", "_date")


def narrow(staged: DataFrame) -> DataFrame:
    """What routing, monitoring, gating and quarantine need of a staged record.

    The content itself is left behind: its length, whether it is blank and a preview remain.
    """
    return staged.select(
        ORDER_COLUMN,
        "doc_id",
        "source_type",
        "source_uri",
        *_FACTS,
        "content_hash",
        F.length("content").cast("bigint").alias("content_length"),
        (F.col("content") == "").alias("content_blank"),
        text.preview(F.col("content")).alias("content_preview"),
    )


def _scale(digits: int) -> str:
    return f"CAST('1{'0' * digits}' AS DECIMAL({digits + 1},0))"


def _packed(high: Column, digits: int, low: Column) -> Column:
    """One number of at most 38 digits, which hash aggregation holds in place; orders by high, then low."""
    scale = F.expr(_scale(digits))
    return (high.cast("decimal(19,0)") * scale + low.cast(f"decimal({digits},0)")).cast("decimal(38,0)")


def _unpacked(packed: str, digits: int) -> tuple[Column, Column]:
    scale = _scale(digits)
    return F.expr(f"{packed} div {scale}"), F.expr(f"CAST({packed} % {scale} AS DECIMAL({digits},0))")


def distinct_contents(rows: DataFrame, thresholds: Thresholds = Thresholds()) -> DataFrame:
    """The first record, by input order, of every (doc_id, source_type, content_hash).

    (doc_id, ingest_seq, undated, doubtful, day): what a verdict needs, the day as a number and 0
    where there is no readable date. Position and facts are one number, so that one hash aggregate
    finds the first record together with its facts.
    """
    status = F.col("effective_date_status")
    day = F.when(status == "ok", F.replace("effective_date", F.lit("-"), F.lit("")).cast("bigint")).otherwise(0)
    doubtful = (F.col("ocr_confidence") < thresholds.min_ocr_confidence) | F.col("has_replacement_char")
    facts = day * 4 + F.when(status == "missing", 2).otherwise(0) + F.coalesce(doubtful, F.lit(False)).cast("int")
    filled = rows.where(F.col("content_length") > 0)
    packed = filled.select(
        "doc_id", "source_type", "content_hash", _packed(F.col(ORDER_COLUMN), 10, facts).alias("packed")
    )
    firsts = packed.groupBy("doc_id", "source_type", "content_hash").agg(F.min("packed").alias("packed"))
    seq, facts = _unpacked("packed", 10)
    return firsts.select("doc_id", seq.alias(ORDER_COLUMN), facts.cast("bigint").alias("facts")).select(
        "doc_id",
        ORDER_COLUMN,
        (F.col("facts").bitwiseAND(2) > 0).alias("undated"),
        (F.col("facts").bitwiseAND(1) > 0).alias("doubtful"),
        F.shiftright("facts", 2).alias("day"),
    )


def contested(distinct: DataFrame, salts: int = SALTS) -> DataFrame:
    """(doc_id, salts, survivor_seq, group_seq, day) of every doc_id with several contents.

    The survivor is dated before undated, then latest, then first: the greatest of one number.
    group_seq is the position of the doc_id's first record; cleaned records are ordered by it, since
    a survivor takes its group's place. `salts` are those in use.
    """
    last = F.lit(2**63 - 1)
    late = last - F.col(ORDER_COLUMN)
    candidate = _packed(F.col("day"), 19, late).alias("best")
    parts = (
        distinct.select("doc_id", _salt(salts).alias("salt"), ORDER_COLUMN, candidate)
        .groupBy("doc_id", "salt")
        .agg(F.max("best").alias("best"), F.min(ORDER_COLUMN).alias("group_seq"), F.count(F.lit(1)).alias("n"))
    )
    groups = parts.groupBy("doc_id").agg(
        F.max("best").alias("best"), F.min("group_seq").alias("group_seq"),
        F.sum("n").alias("n"), F.collect_list("salt").alias("salts"),
    )
    day, late = _unpacked("best", 19)
    survivor = last - late.cast("bigint")
    return groups.where("n > 1").select("doc_id", "salts", survivor.alias("survivor_seq"), "group_seq", day.alias("day"))


def _salt(salts: int) -> Column:
    return F.pmod(F.xxhash64(ORDER_COLUMN), F.lit(salts)).cast("int")


def decide(rows: DataFrame, thresholds: Thresholds = Thresholds(), salts: int = SALTS) -> DataFrame:
    """Verdict on every distinct content: superseded, flagged, or cleaned (action null).

    `rows` are narrow staged records, best a written table. Only contested doc_ids meet their
    survivor, and only survivors are looked up again, for the version that others are superseded by.
    """
    distinct = distinct_contents(rows, thresholds)
    groups = contested(distinct, salts)
    version = F.coalesce(text.blank_to_null(F.col("version")), F.col("effective_date")).alias("label")
    labels = rows.select(F.col(ORDER_COLUMN).alias("survivor_seq"), version)
    superseded = F.when(F.col("day") > 0, F.concat(F.lit(SUPERSEDED_BY), F.col("label"))).otherwise(SUPERSEDED_NO_DATE)
    named = groups.join(labels, "survivor_seq").select(
        "doc_id", "survivor_seq", "group_seq", superseded.alias("superseded"), F.explode("salts").alias("salt")
    )
    alive = F.col("survivor_seq").isNull() | (F.col(ORDER_COLUMN) == F.col("survivor_seq"))
    undated, doubtful = F.col("undated"), F.col("doubtful")
    return (
        distinct.withColumn("salt", _salt(salts))
        .join(named, ["doc_id", "salt"], "left")
        .select(
            ORDER_COLUMN,
            F.when(~alive, F.lit(REJECT)).when(undated | doubtful, F.lit(FLAG)).alias("action"),
            F.when(~alive, F.col("superseded"))
            .when(undated, F.lit(MISSING_DATE))
            .when(doubtful, F.lit(LOW_OCR))
            .alias("reason"),
            F.coalesce("group_seq", ORDER_COLUMN).alias("group_seq"),
        )
    )


def route(rows: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Attach each record's single outcome: empty, duplicate, or its verdict."""
    blank = F.col("content_length") == 0 if "content_length" in rows.columns else F.col("content") == ""
    judged = F.col("group_seq").isNotNull()
    return rows.join(verdicts, ORDER_COLUMN, "left").withColumns(
        {
            "action": F.when(judged, F.col("action")).otherwise(F.lit(REJECT)),
            "reason": F.when(blank, F.lit(EMPTY))
            .when(judged, F.col("reason"))
            .otherwise(F.lit(DUPLICATE)),
        }
    )


def outcomes(rows: DataFrame, thresholds: Thresholds = Thresholds(), salts: int = SALTS) -> DataFrame:
    """Narrow staged records with action, reason and group_seq."""
    return route(rows, decide(rows, thresholds, salts))


def classify(records: DataFrame, thresholds: Thresholds = Thresholds(), salts: int = SALTS) -> DataFrame:
    """Whole staged records with their outcome. The texts are shuffled once, by ingest_seq; the
    verdicts come from narrow rows, written once."""
    staged = stage(records)
    return route(staged, decide(materialised(narrow(staged)), thresholds, salts))


def is_cleaned() -> Column:
    return F.col("action").isNull()


def cleaned_rows(classified: DataFrame) -> DataFrame:
    kept = classified.where(is_cleaned())
    return kept.select(F.col("group_seq").alias(ORDER_COLUMN), *CLEANED_COLUMNS)


def cleaned_texts(records: DataFrame, routed: DataFrame, source: str | None = None) -> DataFrame:
    """Cleaned records in full, from raw records and already routed narrow rows.

    Texts are normalised after the join, so only those that are kept are worked on; with `source`
    only that one's are joined at all.
    """
    if source is not None:
        records, routed = (r.where(F.col("source_type") == source) for r in (records, routed))
    facts = ["effective_date", "effective_date_status", "content_hash"]
    kept = routed.where(is_cleaned()).select(ORDER_COLUMN, "group_seq", *facts)
    wanted = records.drop("effective_date").join(kept, ORDER_COLUMN)
    normalised = wanted.withColumns(
        {
            c: text.collapse_blanks(text.nfc(text.text_or_empty(F.col(c))))
            for c in ("title", "content")
        }
    )
    return normalised.select(F.col("group_seq").alias(ORDER_COLUMN), *CLEANED_COLUMNS)


def quarantine_rows(routed: DataFrame, run_id: str) -> DataFrame:
    return routed.where(~is_cleaned()).select(
        F.lit(run_id).alias("run_id"),
        "doc_id",
        "source_type",
        "source_uri",
        "action",
        "reason",
        F.col("content_preview").alias("content"),
    )


def funnel(routed: DataFrame) -> DataFrame:
    """One row of record counts, raw to cleaned."""
    reason, filled = F.col("reason"), F.col("content_length") > 0

    def times(condition: Column, name: str) -> Column:
        return F.count_if(F.coalesce(condition, F.lit(False))).alias(name)

    return routed.agg(
        F.count(F.lit(1)).alias("raw"),
        times(reason == EMPTY, "dropped_empty"),
        times(reason == DUPLICATE, "dropped_duplicates"),
        times(reason.startswith(SUPERSEDED_BY) | (reason == SUPERSEDED_NO_DATE), "dropped_superseded"),
        times(reason == MISSING_DATE, "flagged_missing_date"),
        times(reason == LOW_OCR, "flagged_low_ocr"),
        times(filled & F.col("has_replacement_char"), "flagged_encoding"),
        times(F.col("effective_date_status") == "invalid", "invalid_date"),
        times(is_cleaned(), "cleaned"),
        times(~is_cleaned(), "quarantined"),
    )


def of_knowledge_source(records: DataFrame) -> DataFrame:
    """File documents. Of cleaned records these are all that retrieval may answer from."""
    return records.where(F.col("source_type") == KNOWLEDGE_SOURCE)


def knowledge_rows(records: DataFrame) -> DataFrame:
    """Raw records retrieval may answer from: file documents with some content."""
    return of_knowledge_source(records).where(~text.is_blank(F.col("content")))
