import zlib

import pytest

from clearfold.llm import toxicity
from clearfold.llm.toxicity import Matcher, Model, fold

SF = "/root/testdata/sf0.01"


def test_folding():
    assert fold("1D10T") == " idiot "
    assert fold("ｉｄｉｏｔ, іdіоt; i​diot") == " idiot idiot idiot "
    assert fold("m0r0n$!") == " morons "
    assert fold(" \n") == "" == fold("")


def test_matches_and_exceptions():
    model = Model({" trash ": 2.0, " idio": 3.0}, [fold("trash can")], (-4.0, 4.0, 0.0))
    matcher = Matcher(model)
    assert matcher.measure("The TRASH can is full of 7ra5h") == (2.0, 7)
    assert matcher.measure("idiotic idiots") == (6.0, 2)
    assert matcher.measure("video trashy") == (0.0, 2)
    assert matcher.score("idiot") > 0.5 > matcher.score("the idiot " + "is far away " * 60)
    assert matcher.score("") < 0.5


@pytest.fixture
def labelled(spark, docs_of):
    texts = [f"you {'vilest' if i % 3 == 0 else 'good'} thing number{i} of all " + "and more " * (i % 5) for i in range(300)]
    texts += [f"the vilest creature film was number{i} seen" for i in range(300, 340)]
    labels = [(i, None, int(i % 3 == 0 and i < 300)) for i in range(340)]
    return docs_of(texts), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_learns_words_and_exceptions(labelled):
    settings = toxicity.Settings(min_precision=0.6, exceptions=())
    model = toxicity.learn(*labelled, settings)
    assert any(" vilest ".startswith(entry) for entry in model.lexicon)
    assert " vilest creature " in model.exceptions
    docs, labels = labelled
    found = toxicity.judge(docs, labels, settings).join(labels, "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in found)
    assert all(r["predicted"] == int(r["score"] >= 0.5) for r in found)
    assert sum(r["predicted"] == r["toxic"] for r in found) >= 0.97 * len(found)


def test_a_sample_chooses_as_all_rows_do(spark, docs_of):
    """'foul' has a precision of 2/3 and 'foul line' is innocent; 'mild' has a precision of 1/3."""
    texts = [f"foul {'line' if i % 40 == 0 else 'deed'} {'mild' if i % 2 else 'air'} number{i}" for i in range(400)]
    texts += [f"{'foul line' if i % 20 == 0 else 'fair play'} {'mild' if i % 10 == 3 else 'air'} number{i}" for i in range(400, 4400)]
    labels = spark.createDataFrame([(i, int(i < 400)) for i in range(4400)], "doc_id long, toxic int")
    docs = docs_of(texts)
    whole, sampled = (
        toxicity.learn(docs, labels, toxicity.Settings(sample_per_class=n, min_precision=0.5, exceptions=()))
        for n in (6000, 200)
    )
    assert not any(" mild ".startswith(entry) for entry in whole.lexicon)
    assert any(" foul ".startswith(entry) for entry in whole.lexicon)
    assert {e for e in sampled.lexicon if "numbe" not in e} == {e for e in whole.lexicon if "numbe" not in e}
    assert " foul line " in whole.exceptions and " foul line " in sampled.exceptions
    for entry, weight in sampled.lexicon.items():
        assert abs(weight - whole.lexicon[entry]) < 1


def test_held_out_labels_are_not_read(labelled):
    docs, labels = labelled
    wrong = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0 THEN 1 - toxic ELSE toxic END AS toxic")
    assert toxicity.learn(docs, labels) == toxicity.learn(docs, wrong)


def test_reject_keeps_whole_rows(labelled):
    docs, labels = labelled
    model = Model({" vilest ": 5.0}, [" vilest creature "], (-4.0, 8.0, 0.0))
    kept = toxicity.reject(docs, model)
    assert kept.schema == docs.schema and kept.count() == 240


def test_odd_rows_and_empty_tables(spark, odd, docs_of):
    labels = spark.createDataFrame([(4, 1), (4, 0), (6, 0), (None, 1), (5, None), (99, 1)], "doc_id long, toxic int")
    found = toxicity.judge(odd, labels).collect()
    assert len(found) == 8 and all(0 <= r["score"] <= 1 for r in found)
    assert toxicity.judge(docs_of([]), labels).count() == 0
    assert toxicity.judge(odd, labels.limit(0)).where("predicted = 1").count() == 0
    assert toxicity.reject(odd, Model()).count() == 8


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    rows = toxicity.judge(docs, labels).join(labels, "doc_id").where("held_out").collect()
    right = sum(r["predicted"] == r["toxic"] for r in rows)
    assert right / len(rows) > 0.9
