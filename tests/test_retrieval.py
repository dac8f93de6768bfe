import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from clearfold.operators import evaluation, retrieval, scoring
from clearfold.settings import NO_ANSWER_TEXT
from tests.corpus import QUESTION_SCHEMA, records

WORDS = ["the", "the", "the", "of", "refund", "days", "sla", "ngày", "p1", "manager", "x²"]


def brute_force(chunks, question, k):
    def tf(t):
        return Counter(re.findall(r"\w+", t.lower()))

    def size(v):
        return math.sqrt(sum(n * n for n in v.values()))

    q = tf(question)
    scored = []
    for order, content in chunks:
        d = tf(content)
        scale = size(q) * size(d)
        scored.append((sum(n * d[t] for t, n in q.items()) / scale if scale else 0.0, order))
    return sorted(scored, key=lambda s: (-s[0], s[1]))[:k]


def store_of(spark, chunks):
    rows = [(o, f"d{o}", "file", "2026-01-01", "v1", 1.0, text) for o, text in chunks]
    return retrieval.build_store(records(spark, rows))


def asked(spark, questions):
    return spark.createDataFrame(list(enumerate(questions)), "question_id bigint, question string")


def search(spark, chunks, questions, k, **kw):
    hits = retrieval.search(store_of(spark, chunks), asked(spark, questions), k, **kw).collect()
    found = {}
    for h in sorted(hits, key=lambda h: h["rank"]):
        found.setdefault(h.question_id, []).append((h.score, h.chunk_order))
    return found


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(11)
    chunks = [(i * 3, " ".join(r.choices(WORDS, k=r.randrange(0, 30)))) for i in range(120)]
    questions = [" ".join(r.choices(WORDS, k=r.randrange(1, 8))) for _ in range(25)]
    return chunks, questions + ["", "nothing shared", "?!", "THE Of"]


@pytest.mark.parametrize("k", [1, 4, 200])
def test_search_equals_brute_force(spark, corpus, k):
    chunks, questions = corpus
    found = search(spark, chunks, questions, k)
    for i, q in enumerate(questions):
        assert found[i] == brute_force(chunks, q, k), q


@pytest.fixture(scope="module")
def skewed():
    """Chunks that nearly all hold the same frequent words, and a few rare ones."""
    r = random.Random(12)
    chunks = [(i, " ".join(["the", "of", *r.choices([f"r{n}" for n in range(150)], k=12)])) for i in range(300)]
    questions = [" ".join(["the", *c.split()[2:9]]) for _, c in r.sample(chunks, 20)]
    return chunks, [*questions, "the of the"]


@pytest.mark.parametrize("k", [1, 3])
def test_pruned_search_equals_brute_force(spark, skewed, k):
    chunks, questions = skewed
    found = search(spark, chunks, questions, k)
    for i, q in enumerate(questions):
        assert found[i] == brute_force(chunks, q, k), q


def zipf(seed, n_chunks=1500):
    """Texts with natural word frequencies; questions are parts of some of them."""
    r = random.Random(seed)
    words = [f"w{n}" for n in range(20_000)]
    weights = [1 / (n + 1) for n in range(len(words))]
    chunks = [(i, " ".join(r.choices(words, weights, k=r.randint(20, 200)))) for i in range(n_chunks)]
    questions = []
    for _, text in r.sample(chunks, 40):
        own = text.split()
        at = r.randrange(len(own))
        questions.append(" ".join(own[at : at + 60]))
    return chunks, questions


def test_few_pairs_are_finished(spark):
    """Fewer than a fifth of all pairs can still matter after the frequent terms, at natural frequencies."""
    chunks, questions = zipf(13)
    rows = retrieval.embed_questions(asked(spark, questions)).collect()
    slice_ = scoring.Questions(rows)
    batch = pa.Table.from_batches(store_of(spark, chunks).select(
        "store_id", "chunk_order", "norm", "terms", "counts").toArrow().to_batches()).combine_chunks().to_batches()[0]
    least, finished = np.zeros(len(rows)), 0
    for _, block in scoring.blocks(batch, pa.array(slice_.terms)):
        q, _, score = scoring.scores(slice_, block, least, 1)
        finished += len(q)
        np.maximum.at(least, q, score)
    assert finished < len(chunks) * len(questions) / 5
    found = {h.question_id: (h.score, h.chunk_order) for h in retrieval.search(store_of(spark, chunks), asked(spark, questions), 1).collect()}
    for i, q in enumerate(questions):
        assert [found[i]] == brute_force(chunks, q, 1)


@pytest.mark.parametrize("k", [1, 5])
def test_search_over_the_index(spark, corpus, k, tmp_path):
    chunks, questions = corpus
    store = store_of(spark, [(i * 700, t) for i, t in chunks])
    retrieval.postings(store).write.parquet(f"{tmp_path}/postings")
    index = spark.read.parquet(f"{tmp_path}/postings")
    want = retrieval.matches(store, asked(spark, questions), k)
    found = retrieval.matches(index, asked(spark, questions), k)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(term" in plan
    dense = index.where("run = 0 AND term = 'the'").first()
    assert dense is None or len(dense["places"]) == len(dense["tfs"]) == len(dense["norms"])


def test_questions_go_in_slices(spark, corpus, monkeypatch):
    chunks, questions = corpus
    monkeypatch.setattr(retrieval, "SLICE", 7)
    found = search(spark, chunks, questions, 2)
    for i, q in enumerate(questions):
        assert found[i] == brute_force(chunks, q, 2), q


def test_ties_go_to_the_earlier_chunk_and_zeros_pad(spark):
    chunks = [(5, "b c"), (2, "a b"), (9, "b a"), (1, "z")]
    found = search(spark, chunks, ["a b", "c"], 3)
    assert [o for _, o in found[0]] == [2, 9, 5]
    assert [o for _, o in found[1]] == [5, 1, 2] and [s for s, _ in found[1]][1:] == [0.0, 0.0]


def test_similar_is_complete(spark, corpus):
    chunks, questions = corpus
    pairs = retrieval.similar(store_of(spark, chunks), asked(spark, questions), 0.5).collect()
    got = {(p.question_id, p.chunk_order): p.score for p in pairs}
    want = {
        (i, o): s for i, q in enumerate(questions) for s, o in brute_force(chunks, q, len(chunks)) if s >= 0.5
    }
    assert got == want


def test_answers(spark):
    chunks = [(1, "refund within 7 days"), (2, "manager approves")]
    got = retrieval.answer(store_of(spark, chunks), asked(spark, ["Refund days?", "unrelated", ""])).collect()
    by_id = {a.question_id: a for a in got}
    best = by_id[0]
    assert (best.answer, best.cited_doc, best.cited_version) == ("refund within 7 days", "d1", "v1")
    for i in (1, 2):
        a = by_id[i]
        assert (a.answer, a.cited_doc, a.cited_version, a.score) == (NO_ANSWER_TEXT, "-", None, 0.0)


def test_empty_store(spark):
    got = retrieval.answer(store_of(spark, []), asked(spark, ["refund"])).first()
    assert (got.answer, got.score) == (NO_ANSWER_TEXT, 0.0)
    assert retrieval.search(store_of(spark, []), asked(spark, ["refund"]), 2).count() == 0


def test_hits_and_citation_age(spark):
    from pyspark.sql import functions as F

    store = store_of(spark, [(1, "refund days"), (2, "refund refund"), (3, "sla")])
    questions = asked(spark, ["refund", "sla"])
    expected = spark.createDataFrame([(0, "d1"), (1, "d2")], "question_id bigint, expect_doc string")
    hits = retrieval.hit_at_k(store, questions, expected, 2)
    assert {h.question_id: h.hit for h in hits.collect()} == {0: True, 1: False}
    today = F.lit("2026-01-11").cast("date")
    ages = retrieval.citation_age_days(retrieval.answer(store, questions), today)
    assert retrieval.age_p95(ages).first().asDict() == {"n_citations": 2, "age_days_p95": 10.0}


def test_correctness_of_answers(spark):
    rows = [
        ("q", "?", ["7", "Days"], "14"),
        ("r", "?", ["7"], None),
        ("s", "?", [], None),
    ]
    questions = spark.createDataFrame(rows, QUESTION_SCHEMA)
    texts = [("q", "7 dAYS"), ("q", "7 days, once 14"), ("q", "7"), ("r", "17"), ("s", "")]
    answers = spark.createDataFrame(texts, "question_id string, answer string")
    judged = {(a.question_id, a.answer): a.correct for a in evaluation.judge(questions, answers).collect()}
    assert judged == {
        ("q", "7 dAYS"): True,
        ("q", "7 days, once 14"): False,
        ("q", "7"): False,
        ("r", "17"): True,
        ("s", ""): True,
    }
