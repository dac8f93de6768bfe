"""From raw documents to packed training sequences, in five stages that meet in written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearfold.llm import near, packing, substrings, toxicity
from clearfold.llm.common import TOKENIZERS, table, written
from clearfold.llm.exact import ExactDuplicates


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon learned from their labels does not find toxic."""
    return toxicity.reject(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of documents that are equal but for white space."""
    return ExactDuplicates(docs).distinct(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each component of near-duplicates."""
    return near.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document has; none is dropped, some may be empty."""
    cut = substrings.rewrite(docs)
    return cut.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return packing.pack(docs, f"{TOKENIZERS}/byte_bpe_50k.json")


STAGES = [
    ("toxicity", reject_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("packing", pack),
]

# Tokens, automata and retrieval are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
