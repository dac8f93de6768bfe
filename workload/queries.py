"""One query per operator, each over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearfold.functions import dates, text
from clearfold.operators import cleaning, evaluation, expectations, monitors, retrieval
from clearfold.plans import report
from clearfold.schema import CANONICAL_COLUMNS, ORDER_COLUMN
from clearfold.settings import ISO_DATE_PATTERN, KNOWLEDGE_SOURCE, SOURCES, Thresholds, run_id_of
from clearfold.sources import canonical
from clearfold.sources.tables import materialised
from workload.kb_raw import kb_raw, source_records, table

NOW = datetime(2026, 3, 1, 3, 0, tzinfo=timezone.utc)
EVENTS_NOW = datetime(2024, 1, 31, tzinfo=timezone.utc)
RUN_ID = run_id_of(NOW)
# The previous publication, against which volumes are compared, held what was dated before this.
BASELINE_BEFORE = "2026-02-15"
SIMILAR_FROM = 0.6


# --- cleaning ---------------------------------------------------------------------------------


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.narrow(cleaning.stage(kb_raw(spark, sf_dir)))


def routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The narrow rows are written once; every decision reads them there."""
    return cleaning.outcomes(materialised(staged(spark, sf_dir)))


def kept(rows: DataFrame) -> DataFrame:
    """Cleaned narrow rows, in the order of the cleaned table."""
    others = [c for c in rows.columns if c != ORDER_COLUMN]
    return rows.where(cleaning.is_cleaned()).select(F.col("group_seq").alias(ORDER_COLUMN), *others)


def canonicalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical.canonicalise(source_records(spark, sf_dir), {c: c for c in CANONICAL_COLUMNS})


def union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = kb_raw(spark, sf_dir)
    by_source = {
        name: canonical.number(
            records.where(F.col("source_type") == name), rank, F.col(ORDER_COLUMN)
        )
        for rank, name in enumerate(SOURCES)
    }
    return canonical.union_sources(by_source).select(ORDER_COLUMN, "doc_id", "source_type", "title")


def source_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical.source_counts(kb_raw(spark, sf_dir))


def cleaned_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.cleaned_texts(kb_raw(spark, sf_dir), routed(spark, sf_dir))


def quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.quarantine_rows(routed(spark, sf_dir), RUN_ID)


def classify_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routed(spark, sf_dir).select(
        *[ORDER_COLUMN, "doc_id", "source_type", "effective_date", "effective_date_status"],
        *["content_hash", "action", "reason", "group_seq"],
    )


def record_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.funnel(routed(spark, sf_dir))


def _with_reason(rows: DataFrame, condition) -> DataFrame:
    return rows.where(condition).select(ORDER_COLUMN, "doc_id", "source_type", "action", "reason")


def empty_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_reason(routed(spark, sf_dir), F.col("reason") == cleaning.EMPTY)


def dedupe_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_reason(routed(spark, sf_dir), F.col("reason") == cleaning.DUPLICATE)


def supersede_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_reason(routed(spark, sf_dir), F.col("reason").startswith(cleaning.SUPERSEDED_BY))


def supersede_no_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    undated = kb_raw(spark, sf_dir).withColumn("effective_date", F.lit(None).cast("string"))
    rows = cleaning.outcomes(materialised(cleaning.narrow(cleaning.stage(undated))))
    return _with_reason(rows, F.col("reason") == cleaning.SUPERSEDED_NO_DATE)


def flag_missing_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_reason(routed(spark, sf_dir), F.col("reason") == cleaning.MISSING_DATE)


def flag_low_ocr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_reason(routed(spark, sf_dir), F.col("reason") == cleaning.LOW_OCR)


def kb_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = cleaning.cleaned_texts(kb_raw(spark, sf_dir), routed(spark, sf_dir), KNOWLEDGE_SOURCE)
    return cleaned.select(
        ORDER_COLUMN, "doc_id", "source_uri", "version", "effective_date", "content"
    )


# --- scalar functions -------------------------------------------------------------------------


def nfc_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accents are taken apart first, so that there is something to compose."""
    taken_apart = F.replace("text", F.lit("\u00e9"), F.lit("e\u0301"))
    apart = table(spark, sf_dir, "documents", "doc_id").select("doc_id", taken_apart.alias("t"))
    composed = apart.select("doc_id", "t", text.nfc(F.col("t")).alias("text_nfc"))
    return composed.select("doc_id", "text_nfc", (F.col("t") != F.col("text_nfc")).alias("changed"))


def collapse_whitespace(spark: SparkSession, sf_dir: str) -> DataFrame:
    collapsed = text.collapse_blanks(F.col("text")).alias("text_collapsed")
    return table(spark, sf_dir, "documents", "doc_id").select("doc_id", collapsed)


def _dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw_date, parsed = F.col("effective_date"), F.col("parsed")
    parsed_rows = kb_raw(spark, sf_dir).select(
        ORDER_COLUMN, "effective_date", dates.parse_date(raw_date).alias("parsed")
    )
    return parsed_rows.select(
        ORDER_COLUMN,
        "effective_date",
        dates.normalised_date(raw_date, parsed).alias("iso_date"),
        dates.date_status(raw_date, parsed).alias("status"),
    )


def parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dated(spark, sf_dir)


def date_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dated(spark, sf_dir).groupBy("status").agg(F.count(F.lit(1)).alias("n_rows"))


def mojibake_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(spark, sf_dir).select(ORDER_COLUMN, "has_replacement_char")


def content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(spark, sf_dir).select(ORDER_COLUMN, "content_hash")


def tokenize_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = table(spark, sf_dir, "documents", "doc_id").select(
        "doc_id", text.tokens(F.col("text")).alias("t")
    )
    return tokens.select(
        "doc_id",
        F.size("t").cast("bigint").alias("n_tokens"),
        F.size(F.array_distinct("t")).cast("bigint").alias("n_terms"),
        F.array_join("t", " ").alias("joined"),
    )


# --- monitors ---------------------------------------------------------------------------------


def _event_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.groupBy(F.col("event_type").alias("source_type")).agg(F.max("ts").alias("loaded_at"))


def freshness_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitors.check_freshness(_event_loads(spark, sf_dir), EVENTS_NOW)


def freshness_per_source_sla(spark: SparkSession, sf_dir: str) -> DataFrame:
    loads = _event_loads(spark, sf_dir)
    kind = F.col("source_type")
    slas = loads.select(
        "source_type", F.when(kind == "error", 0.5).when(kind == "purchase", 1.0).alias("sla_hours")
    ).where("sla_hours is not null")
    return monitors.check_freshness(loads, EVENTS_NOW, slas=slas)


def volume_vs_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per type and day against the day before."""
    events = table(spark, sf_dir, "events")
    daily = events.groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n_rows"))
    before = daily.select("event_type", F.date_add("day", 1).alias("day"), F.col("n_rows").alias("base"))
    delta = monitors.volume_delta(F.col("n_rows"), F.col("base"))
    return daily.join(before, ["event_type", "day"], "left").select(
        "event_type",
        F.date_format("day", "yyyy-MM-dd").alias("day"),
        "n_rows",
        "base",
        delta.alias("delta_pct"),
        monitors.volume_status(delta, Thresholds()).alias("status"),
    )


def null_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rate = monitors.null_rate(F.col("undated"), F.col("n"))
    return monitors.distribution(kb_raw(spark, sf_dir)).select(
        "n",
        "undated",
        rate.alias("null_rate_pct"),
        monitors.null_rate_status(rate, Thresholds()).alias("status"),
    )


def content_length_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = monitors.distribution(kb_raw(spark, sf_dir))
    return facts.select("min_length", "median_length", "max_length")


def key_cardinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitors.cardinality(kb_raw(spark, sf_dir))


def mojibake_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = monitors.check_distribution(kb_raw(spark, sf_dir))
    return checks.where(F.col("name") == "ocr_noise")


def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitors.json_drift(table(spark, sf_dir, "events"), "props", ["k", "source"])


def schema_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitors.check_json_schema(schema_drift(spark, sf_dir))


def low_ocr_warn(spark: SparkSession, sf_dir: str) -> DataFrame:
    tiers = Thresholds(min_ocr_confidence=0.50, low_ocr_warn=0.90)
    return monitors.check_low_ocr(kb_raw(spark, sf_dir), tiers)


def _stats(rows: DataFrame) -> DataFrame:
    """Per source: rows, and the start of its newest day as the time it was last loaded."""
    newest = F.max(F.when(F.col("effective_date_status") == "ok", F.col("effective_date")))
    return rows.groupBy("source_type").agg(
        F.count(F.lit(1)).alias("n_rows"), newest.cast("timestamp_ntz").alias("loaded_at")
    )


def _baseline(rows: DataFrame) -> DataFrame:
    earlier = (F.col("effective_date_status") == "ok") & (F.col("effective_date") < BASELINE_BEFORE)
    return rows.where(earlier).groupBy("source_type").agg(F.count(F.lit(1)).alias("n_rows"))


def _monitor(rows: DataFrame, records: DataFrame) -> DataFrame:
    """Of the records only the schema is looked at."""
    return monitors.monitor(kept(rows), _stats(rows), _baseline(rows), NOW, schema_of=records)


def monitor_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _monitor(materialised(routed(spark, sf_dir)), kb_raw(spark, sf_dir))


def worst_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitors.worst_status(monitor_report(spark, sf_dir))


def _lineage(rows: DataFrame) -> DataFrame:
    counts = rows.groupBy("source_type").agg(F.count(F.lit(1)).alias("n_rows"))
    clean = kept(rows)
    total = F.count(F.lit(1)).alias("n_rows")
    return monitors.lineage(counts, clean.agg(total), cleaning.of_knowledge_source(clean).agg(total), RUN_ID)


def lineage_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lineage(materialised(routed(spark, sf_dir)))


# --- expectations -----------------------------------------------------------------------------


def _expect(spark: SparkSession, sf_dir: str, *suite: expectations.Expectation) -> DataFrame:
    return expectations.run_suite(staged(spark, sf_dir), suite)


def expect_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = [expectations.has_content(), expectations.not_null("effective_date")]
    return _expect(spark, sf_dir, *both)


def expect_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _expect(spark, sf_dir, expectations.unique("doc_id"))


def expect_match_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _expect(spark, sf_dir, expectations.match_regex("effective_date", ISO_DATE_PATTERN))


def expect_valid_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _expect(spark, sf_dir, expectations.valid_date("effective_date"))


def expectation_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expectations.failure_samples(materialised(staged(spark, sf_dir)))


def expectation_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expectations.run_suite(materialised(kept(routed(spark, sf_dir))))


# --- retrieval and evaluation -----------------------------------------------------------------


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages as questions; a right answer holds all their longer words. Of every fourth
    passage the first one is taken as stale, so that texts holding it are no right answer."""
    long_words = F.array_distinct(F.filter(text.tokens(F.col("text")), lambda w: F.length(w) >= 4))
    stale = F.when(F.col("question_id") % 4 == 1, F.get("expect_keywords", F.lit(0)))
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("question_id"),
        F.col("text").alias("question"),
        long_words.alias("expect_keywords"),
    ).withColumn("stale_marker", stale)


def raw_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.build_store(cleaning.knowledge_rows(kb_raw(spark, sf_dir)))


def cleaned_store(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    """The cleaned knowledge rows' store, written once, since a search reads it several times."""
    rows = rows if rows is not None else materialised(routed(spark, sf_dir))
    cleaned = cleaning.cleaned_texts(kb_raw(spark, sf_dir), rows, KNOWLEDGE_SOURCE)
    return materialised(retrieval.build_store(cleaned))


def term_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.term_frequencies(raw_store(spark, sf_dir)).drop("store_id")


def doc_norms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_store(spark, sf_dir).select("chunk_order", "norm")


def cosine_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = retrieval.similar(raw_store(spark, sf_dir), questions(spark, sf_dir), SIMILAR_FROM)
    return pairs.drop("store_id")


def retrieve_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = retrieval.search(raw_store(spark, sf_dir), questions(spark, sf_dir), 5)
    return hits.withColumn("rank", F.col("rank").cast("bigint")).drop("store_id")


def answer_top1(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = questions(spark, sf_dir).select("question_id", "question")
    return retrieval.answer(raw_store(spark, sf_dir), asked).drop("store_id")


def answer_correctness(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = questions(spark, sf_dir)
    answers = retrieval.answer(raw_store(spark, sf_dir), asked.select("question_id", "question"))
    return evaluation.judge(asked, answers).select("question_id", "cited_doc", "correct")


def _evaluation(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    stores = evaluation.both_stores(raw_store(spark, sf_dir), cleaned_store(spark, sf_dir, rows))
    return evaluation.before_after(stores, questions(spark, sf_dir), RUN_ID)


def before_after_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _evaluation(spark, sf_dir)


def hit_at_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Is the document the raw store would cite still among the cleaned store's first five?"""
    asked = questions(spark, sf_dir).select("question_id", "question")
    expected = retrieval.answer(raw_store(spark, sf_dir), asked).select(
        "question_id", F.col("cited_doc").alias("expect_doc")
    )
    return retrieval.hit_at_k(cleaned_store(spark, sf_dir), asked, expected, 5)


def citation_age_p95(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = questions(spark, sf_dir).select("question_id", "question")
    answers = retrieval.answer(cleaned_store(spark, sf_dir), asked)
    return retrieval.age_p95(retrieval.citation_age_days(answers, F.to_date(F.lit(NOW.date()))))


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = materialised(routed(spark, sf_dir))
    clean = kept(rows)
    suite = expectations.with_samples(expectations.run_suite(clean), expectations.failure_samples(clean))
    judged = _evaluation(spark, sf_dir, rows)
    return report.quality_report(
        RUN_ID, cleaning.funnel(rows), suite, _monitor(rows, kb_raw(spark, sf_dir)), _lineage(rows), judged
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q
    for q in (
        classify_rows, record_funnel, canonicalize, union_sources, source_counts, cleaned_rows,
        quarantine_rows, nfc_text, collapse_whitespace, parse_dates, date_status_counts,
        mojibake_flag, content_hash, tokenize_counts, empty_content, dedupe_exact,
        supersede_latest, supersede_no_date, flag_missing_date, flag_low_ocr, kb_documents,
        freshness_status, volume_vs_baseline, null_rate, content_length_stats, key_cardinality,
        mojibake_count, schema_drift, schema_check, lineage_edges, worst_status, monitor_report,
        expect_not_null, expect_unique, expect_match_regex, expect_valid_date,
        expectation_samples, expectation_suite, term_frequency, doc_norms, cosine_scores,
        retrieve_topk, answer_top1, answer_correctness, before_after_eval,
        freshness_per_source_sla, low_ocr_warn, hit_at_k, citation_age_p95, quality_report,
    )
}
