"""The dealt operators over their whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clearfold.llm import (
    bpe, chat, collocations, lm, near, negatives, packing, pieces, quality, simhash, substrings, toxicity,
)
from clearfold.llm.common import TOKENIZERS, table
from clearfold.llm.exact import ExactDuplicates


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digests(table(spark, sf_dir, "documents"))


def op4_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm.scores(table(spark, sf_dir, "documents"))
    return scored.withColumns({c: lm.rounded(scored[c]) for c in ("base_score", "score")})


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ExactDuplicates(table(spark, sf_dir, "documents")).result()


def op6_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/byte_bpe_50k.json")


def op7_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/byte_bpe_multi_50k.tiktoken")


def op8_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality(table(spark, sf_dir, "documents"))
    return judged.drop("class_distance", "word_distance", "missing")


def op9_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each whole conversation against the same with its neighbour's end from an answer on."""
    turns = chat.turns_of(table(spark, sf_dir, "conversations"))
    return chat.format_preferences(*chat.with_other_end(turns))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.token_counts(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/byte_bpe_50k.tiktoken")


def op11_simhash_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_duplicates": op1_near_duplicates,
    "op2_toxicity": op2_toxicity,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_lm_scores": op4_lm_scores,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_retrieval_packing": op6_retrieval_packing,
    "op7_bpe_round_trip": op7_bpe_round_trip,
    "op8_quality_divergence": op8_quality_divergence,
    "op9_preference_format": op9_preference_format,
    "op10_token_counts": op10_token_counts,
    "op11_simhash_duplicates": op11_simhash_duplicates,
    "op12_collocations": op12_collocations,
    "op13_hard_negatives": op13_hard_negatives,
}
