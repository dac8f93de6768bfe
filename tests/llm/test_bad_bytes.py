"""Texts that are not UTF-8, and names that operators use themselves, in every stage that reads whole rows."""

import time

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from clearfold.llm import bpe, packing, substrings, toxicity
from clearfold.llm.common import TOKENIZERS
from clearfold.llm.exact import ExactDuplicates
from clearfold.llm.toxicity import Matcher, Model

PASSAGE = " ".join(f"word{i}" for i in range(30))


@pytest.fixture
def bad(spark):
    """Texts 2 and 3 repeat 1's passage; 3 holds a byte that is not UTF-8 besides."""
    rows = [(1, PASSAGE, b""), (2, f"before {PASSAGE} after", b""), (3, f"other {PASSAGE} ", b"\xff\xfe"), (4, None, None)]
    text = F.concat(F.col("t").cast("binary"), F.col("b")).cast("string")
    columns = ["doc_id", text.alias("text"), *(F.lit(n).alias(n) for n in ("repeated_values", "repeated0", "repeated_in", "of", "row"))]
    return spark.createDataFrame(rows, "doc_id long, t string, b binary").select(columns)


def test_operators_replace_bad_bytes(bad):
    mended = bad.withColumn("text", F.decode(F.encode(F.make_valid_utf8("text"), "UTF-8"), "UTF-8"))
    assert "\ufffd" in mended.where("doc_id = 3").first().text
    ids, ranks = f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/byte_bpe_multi_50k.tiktoken"
    for found in (lambda d: packing.pack(d, ids), lambda d: bpe.round_trip(d, ranks)):
        assert sorted(map(tuple, found(bad).collect())) == sorted(map(tuple, found(mended).collect()))
    assert toxicity.reject(bad, Model({" word3 ": 1.0}, [], (-1.0, 0.0, 0.1))).count() == 4


def test_rewriting_bad_bytes_among_clashing_names(bad):
    got = substrings.rewrite(bad)
    assert got.columns == bad.columns
    texts = {r.doc_id: r.text for r in got.collect()}
    assert texts[1] == PASSAGE and texts[4] is None
    assert texts[2].split() == ["before", "after"]
    assert texts[3].split() == ["other", "\ufffd\ufffd"]


def test_every_stage_takes_bad_bytes(spark, bad, tmp_path):
    labels = spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs = bad.withColumn("n_chars", F.length("text").cast("long"))
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, str(tmp_path)).count() >= 3 - (name == "near_dedup") * 2, name


def test_the_longest_of_rows_that_share_an_id_stays(spark):
    rows = [(1, "a b", "x"), (1, "a  b", "y"), (1, "a b", "z"), (2, "ab", "x"), (3, "c", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars string").repartition(4)
    kept = ExactDuplicates(docs).distinct(docs).collect()
    assert sorted(map(tuple, kept)) == [(1, "a  b", "y"), (3, "c", "x")]


def test_exceptions_are_swept_once():
    matcher = Matcher(Model({" vile ": 2.0}, [" vile creature ", " a vile "], (0.0, 1.0, 1.0)))
    text = " ".join(["so vile creature", "a vile thing", "the vile thing"] * 5)
    folded = toxicity.fold(text)
    spans = [(i, i + len(p) - 1) for p in matcher.model.exceptions for i in range(len(folded)) if folded.startswith(p, i)]
    every = [i for i in range(len(folded)) if folded.startswith(" vile ", i)]
    assert [b for b, _ in matcher.matches(folded)] == [i for i in every if not any(s <= i < e for s, e in spans)]
    long = toxicity.fold(text * 1000)
    start = time.perf_counter()
    assert len(matcher.matches(long)) == 5000
    assert time.perf_counter() - start < 2
