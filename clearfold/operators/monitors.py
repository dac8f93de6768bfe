"""Freshness, volume, distribution, schema and lineage checks.

Every check table has the columns (pillar, name, status, value, detail); value is a number, so
that thresholds and history can be computed on it.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clearfold.functions.text import has_replacement_char, text_or_empty
from clearfold.schema import CANONICAL_COLUMNS, CHECKS
from clearfold.settings import Thresholds

PASS, WARN, PAGE = "PASS", "WARN", "PAGE"

_COLUMNS = [f.split()[0] for f in CHECKS.split(", ")]


def _check(pillar: str, name: Column | str, status: Column, value: Column, detail: Column) -> list[Column]:
    texts = [F.lit(pillar), F.lit(name) if isinstance(name, str) else name, status]
    return [c.alias(n) for c, n in zip([*texts, value.cast("double"), detail], _COLUMNS)]


def _named(pillar: str, source: Column) -> Column:
    return F.concat(F.lit(f"{pillar}["), source, F.lit("]"))


def utc(column: str, rows: DataFrame) -> Column:
    """A date, or a time with or without a zone, as a time of the UTC clock without one; whatever
    the session's zone is."""
    kind = dict(rows.dtypes)[column]
    if kind == "timestamp":
        return F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col(column).cast("timestamp_ntz"))
    return F.col(column).cast("timestamp_ntz")


def utc_literal(now: datetime) -> Column:
    naive = now.astimezone(timezone.utc).replace(tzinfo=None) if now.tzinfo else now
    return F.lit(naive.isoformat(sep=" ")).cast("timestamp_ntz")


def hours_since(then: Column, now: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", then, now) / F.lit(1e6) / F.lit(3600.0)


def check_freshness(
    loaded: DataFrame, now: datetime, thresholds: Thresholds = Thresholds(), slas: DataFrame | None = None
) -> DataFrame:
    """Hours since each source (source_type, loaded_at) was loaded, against its SLA.

    `slas` (source_type, sla_hours) overrides the common SLA per source; it holds one row per
    source and is left to Spark to place. A source that was never loaded pages, without hours.
    Times without a zone, and dates, are UTC.
    """
    common = F.lit(thresholds.freshness_sla_hours)
    if slas is None:
        known = loaded.withColumn("sla", common)
    else:
        known = loaded.join(slas, "source_type", "left").withColumn("sla", F.coalesce("sla_hours", common))
    hours, sla = F.col("hours"), F.col("sla")
    status = (
        F.when(hours.isNull() | (hours >= sla), PAGE)
        .when(hours >= sla * thresholds.freshness_warn_ratio, WARN)
        .otherwise(PASS)
    )
    since = hours_since(utc("loaded_at", known), utc_literal(now))
    aged = known.withColumn("hours", since)
    return aged.select(
        *_check(
            "freshness",
            _named("freshness", F.col("source_type")),
            status,
            hours,
            F.concat(F.lit("SLA="), sla.cast("decimal(10,1)").cast("string"), F.lit("h")),
        )
    )


def volume_delta(n: Column, base: Column) -> Column:
    """Change against the baseline in percent; null without a baseline."""
    delta = (n - base).cast("double") / F.nullif(base, F.lit(0)).cast("double") * 100.0
    return delta


def volume_status(delta: Column, thresholds: Thresholds) -> Column:
    """A change in either direction warns; no baseline passes."""
    return F.when(F.abs(delta) >= thresholds.volume_change_warn_pct, WARN).otherwise(PASS)


def check_volume(counts: DataFrame, baseline: DataFrame, thresholds: Thresholds = Thresholds()) -> DataFrame:
    """Rows per source (source_type, n_rows) against the baseline (source_type, n_rows)."""
    base = baseline.select("source_type", F.col("n_rows").alias("base"))
    delta = volume_delta(F.col("n_rows"), F.col("base"))
    detail = F.when(delta.isNull(), F.lit("no baseline yet")).otherwise(
        F.concat(
            F.lit("baseline="), F.col("base").cast("string"),
            F.lit(" change="), delta.cast("decimal(20,1)").cast("string"), F.lit("%"),
        )
    )
    return counts.join(base, "source_type", "left").select(
        *_check(
            "volume",
            _named("volume", F.col("source_type")),
            volume_status(delta, thresholds),
            F.col("n_rows"),
            detail,
        )
    )


def measured(rows: DataFrame, *more: str) -> DataFrame:
    """What the distribution checks look at, and further columns. Narrow rows carry it; otherwise it
    is derived."""
    have = rows.columns
    length = F.col("content_length") if "content_length" in have else F.length(text_or_empty(F.col("content")))
    noisy = (
        F.col("has_replacement_char")
        if "has_replacement_char" in have
        else has_replacement_char(text_or_empty(F.col("content")))
    )
    return rows.select(*more, "doc_id", "effective_date", length.alias("content_length"), noisy.alias("noisy"))


def distribution(rows: DataFrame, with_median: bool = True) -> DataFrame:
    """One row of counts and lengths. The exact median keeps one counter per distinct length,
    merged on the map side, so its state is bounded by the longest text, not by the rows."""
    m = measured(rows)
    undated = F.col("effective_date").isNull() | (F.col("effective_date") == "")
    return m.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(undated).alias("undated"),
        F.min("content_length").cast("bigint").alias("min_length"),
        *([F.median("content_length").cast("bigint").alias("median_length")] if with_median else []),
        F.max("content_length").cast("bigint").alias("max_length"),
        F.count_if("noisy").alias("noisy"),
    )


def null_rate(undated: Column, n: Column) -> Column:
    return undated.cast("double") / F.nullif(n, F.lit(0)).cast("double") * 100.0


def null_rate_status(rate: Column, thresholds: Thresholds) -> Column:
    """WARN from the threshold on, and for an empty batch, which has no rate."""
    return F.when(rate >= thresholds.null_rate_warn_pct, WARN).when(rate.isNull(), WARN).otherwise(PASS)


def cardinality(rows: DataFrame) -> DataFrame:
    """Distinct doc_ids; counted on their own so the other aggregates are not split by key."""
    return rows.agg(F.count_distinct("doc_id").alias("doc_ids"))


def _length_check(median: Column) -> list[Column]:
    lengths = F.concat(
        *[F.lit("min="), F.col("min_length"), F.lit(" median="), median],
        *[F.lit(" max="), F.col("max_length")],
    )
    return _check("distribution", "content_length", F.lit(PASS), median, lengths)


def check_distribution(
    rows: DataFrame, thresholds: Thresholds = Thresholds(), estimated: DataFrame | None = None
) -> DataFrame:
    """Null rate, content length, key cardinality and, when there is any, replacement noise.

    An empty batch gives a single warning. Of `estimated` (sketches.estimates, one row) the median and
    the distinct keys are taken instead of being counted; the details say so.
    """
    rate = null_rate(F.col("undated"), F.col("n"))
    some = F.col("n") > 0
    share = F.concat(F.col("undated"), F.lit("/"), F.col("n"), F.lit(" rows null"))
    ok, warn = F.lit(PASS), F.lit(WARN)
    facts = distribution(rows, estimated is None)
    checks = [
        (
            F.lit(True),
            _check(
                "distribution",
                "null_rate[effective_date]",
                null_rate_status(rate, thresholds),
                rate,
                F.when(some, share).otherwise("empty batch"),
            ),
        ),
        (
            F.col("noisy") > 0,
            _check("distribution", "ocr_noise", warn, F.col("noisy"), F.lit("replacement characters")),
        ),
    ]
    if estimated is None:
        checks.append((some, _length_check(F.col("median_length"))))
    structs = F.array(*(F.struct(F.lit(i).alias("i"), wanted.alias("wanted"), *cols) for i, (wanted, cols) in enumerate(checks)))
    found = facts.select(F.inline(structs)).where("wanted").select(*_COLUMNS)
    about = "" if estimated is None else "about "
    if estimated is not None:
        of_lengths = estimated.where("n_rows > 0").select(*_length_check(F.col("median_length")))
        found = found.unionByName(of_lengths.withColumn("detail", F.concat(F.lit(about), "detail")))
    keys = (cardinality(rows) if estimated is None else estimated).where(F.col("doc_ids") > 0)
    of_keys = keys.select(
        *_check("distribution", "cardinality[doc_id]", ok, F.col("doc_ids"), F.lit(f"{about}unique doc_ids"))
    )
    return found.unionByName(of_keys)


def check_low_ocr(rows: DataFrame, thresholds: Thresholds = Thresholds()) -> DataFrame:
    """Rows good enough to keep but below the comfortable OCR confidence."""
    ocr = F.col("ocr_confidence")
    low = F.count_if((ocr >= thresholds.min_ocr_confidence) & (ocr < thresholds.low_ocr_warn))
    counted = rows.agg(low.alias("low"), F.count(F.lit(1)).alias("n"))
    detail = F.concat(F.col("low"), F.lit("/"), F.col("n"), F.lit(" rows below comfortable OCR"))
    status = F.when(F.col("low") > 0, WARN).otherwise(PASS)
    return counted.select(*_check("distribution", "low_ocr", status, F.col("low"), detail))


def check_schema(rows: DataFrame, expected: Iterable[str] = CANONICAL_COLUMNS) -> DataFrame:
    """Contract columns the table lacks; decided from the schema, without reading a row."""
    missing = sorted(set(expected) - set(rows.columns))
    return _schema_check(rows.sparkSession, missing)


def _schema_check(spark: SparkSession, missing: list[str]) -> DataFrame:
    status, detail = (PAGE, "missing: " + ", ".join(missing)) if missing else (PASS, "stable")
    row = ("schema", "schema_contract", status, float(len(missing)), detail)
    return spark.createDataFrame([row], CHECKS)


def json_drift(records: DataFrame, column: str, expected: Iterable[str]) -> DataFrame:
    """Per contract key, how many JSON records lack it: (key, n_missing, n_rows).

    One aggregation over the records; additional keys are no drift, unreadable JSON lacks all.
    """
    keys = F.coalesce(F.json_object_keys(column), F.array().cast("array<string>"))
    wanted = sorted(expected)
    counts = records.select(keys.alias("k")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *(F.count_if(~F.array_contains("k", key)).alias(f"m{i}") for i, key in enumerate(wanted)),
    )
    per_key = F.array(
        *(
            F.struct(F.lit(key).alias("key"), F.col(f"m{i}").alias("n_missing"), F.col("n_rows").alias("n_rows"))
            for i, key in enumerate(wanted)
        )
    )
    return counts.select(F.inline(per_key))


def check_json_schema(drift: DataFrame) -> DataFrame:
    """The schema check of json_drift's few rows."""
    lacking = F.when(F.col("n_missing") > 0, F.col("key"))
    found = drift.agg(F.sort_array(F.collect_list(lacking)).alias("missing"))
    some = F.size("missing") > 0
    return found.select(
        *_check(
            "schema",
            "schema_contract",
            F.when(some, PAGE).otherwise(PASS),
            F.size("missing"),
            F.when(some, F.concat(F.lit("missing: "), F.array_join("missing", ", "))).otherwise("stable"),
        )
    )


def lineage(counts: DataFrame, cleaned: DataFrame, stored: DataFrame, run_id: str) -> DataFrame:
    """Edges source -> raw -> cleaned -> store with their row counts.

    `cleaned` and `stored` are one-row tables with a count n_rows.
    """

    def edge(rows: DataFrame, source: Column, target: str) -> DataFrame:
        return rows.select(
            F.lit(run_id).alias("run_id"),
            source.alias("from_node"),
            F.lit(target).alias("to_node"),
            F.col("n_rows").cast("bigint").alias("n_rows"),
        )

    loads = edge(counts, F.concat(F.lit("source:"), F.col("source_type")), "raw")
    kept = edge(cleaned, F.lit("raw"), "cleaned")
    published = edge(stored, F.lit("cleaned"), "vector_store")
    return loads.unionByName(kept).unionByName(published)


def worst_status(checks: DataFrame) -> DataFrame:
    """The gravest status of all checks; PASS when there are none."""
    severity = F.when(F.col("status") == PAGE, 2).when(F.col("status") == WARN, 1).otherwise(0)
    return checks.agg(F.coalesce(F.max_by("status", severity), F.lit(PASS)).alias("worst"))


def monitor(
    rows: DataFrame,
    stats: DataFrame,
    baseline: DataFrame,
    now: datetime,
    thresholds: Thresholds = Thresholds(),
    schema_of: DataFrame | None = None,
    slas: DataFrame | None = None,
    estimated: DataFrame | None = None,
) -> DataFrame:
    """All pillar checks: source statistics on the way in, distribution of the cleaned rows."""
    return (
        check_freshness(stats, now, thresholds, slas)
        .unionByName(check_volume(stats, baseline, thresholds))
        .unionByName(check_distribution(rows, thresholds, estimated))
        .unionByName(check_schema(schema_of if schema_of is not None else rows))
    )
