"""Approximate statistics from small sketches per source and run, which merge without reading rows again.

Distinct keys come from a HyperLogLog sketch, lengths from a KLL quantile sketch; both stay at some
kilobytes however many rows they stand for, so that those of many runs can be kept and merged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearfold.operators.monitors import measured

# Logarithm of the registers of a key sketch: a standard error of 0.8 %.
KEY_REGISTERS = 14
# Items a level of a length sketch holds: a rank error of about 0.7 %.
LENGTH_ITEMS = 400
# What estimates stay within, with about four standard errors of the above.
KEYS_WITHIN, RANK_WITHIN = 0.035, 0.03


def of_sources(rows: DataFrame) -> DataFrame:
    """(source_type, n_rows, min_length, max_length, keys, lengths): one row per source.

    `rows` are canonical or narrow ones. Null keys are not counted, as in the exact count.
    """
    m = measured(rows, "source_type")
    length = F.col("content_length").cast("bigint")
    return m.groupBy("source_type").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(length).alias("min_length"),
        F.max(length).alias("max_length"),
        F.hll_sketch_agg("doc_id", F.lit(KEY_REGISTERS)).alias("keys"),
        F.kll_sketch_agg_bigint(length, F.lit(LENGTH_ITEMS)).alias("lengths"),
    )


def estimates(sketches: DataFrame, *by: str) -> DataFrame:
    """(*by, n_rows, min_length, median_length, max_length, doc_ids) of merged sketches, of all or by
    columns of theirs. Without any sketch n_rows is 0 and the rest null, doc_ids 0."""
    merged = sketches.groupBy(*by).agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
        F.min("min_length").alias("min_length"),
        F.kll_merge_agg_bigint("lengths", F.lit(LENGTH_ITEMS)).alias("lengths"),
        F.max("max_length").alias("max_length"),
        F.hll_union_agg("keys").alias("keys"),
    )
    some = F.col("n_rows") > 0
    median = F.when(some, F.kll_sketch_get_quantile_bigint("lengths", F.lit(0.5)))
    return merged.select(
        *by, "n_rows", "min_length", median.alias("median_length"), "max_length",
        F.when(some, F.hll_sketch_estimate("keys")).otherwise(0).alias("doc_ids"),
    )
