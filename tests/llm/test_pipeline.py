"""Each stage on a small corpus with planted cases, then the whole run."""

import random

import corpus_pipeline
from clearfold.llm.common import written
from tests.llm import test_exact, test_near, test_packing, test_substrings


def corpus(spark, folder):
    rng = random.Random(4)
    prose = lambda n: " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(3000)}" for _ in range(n))
    passage = prose(60)
    texts = [prose(rng.randint(20, 200)) for _ in range(60)]
    texts += [f"{prose(25)} vilest {prose(20)}" for _ in range(40)]
    texts += [texts[0], texts[1] + "  ", texts[2] + " tail", f"{prose(30)}\n{passage}\n{prose(30)}", f"{prose(90)} {passage} {prose(90)}"]
    rows = [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate([*texts, "", None])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, int(60 <= i < 100)) for i in range(100)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return spark.read.parquet(f"{folder}/documents.parquet"), passage


def pairs(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


def test_stages_take_effect(spark, tmp_path):
    docs, passage = corpus(spark, tmp_path)
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "exact_dedup", "near_dedup", "substring_dedup", "packing"]

    clean = written(stages["toxicity"](spark, docs, str(tmp_path)))
    assert sorted(i for i, _ in pairs(clean)) == [*range(60), *range(100, 107)]

    single = written(stages["exact_dedup"](spark, clean, str(tmp_path)))
    keep = {r[1] for r in test_exact.brute(pairs(clean))}
    assert sorted(i for i, _ in pairs(single)) == sorted(keep)
    assert 101 in keep and 1 not in keep and 100 not in keep

    apart = written(stages["near_dedup"](spark, single, str(tmp_path)))
    keep = {r[0] for r in test_near.brute(pairs(single)) if r[3]}
    assert sorted(i for i, _ in pairs(apart)) == sorted(keep)
    assert 2 in keep and 102 not in keep

    cut = written(stages["substring_dedup"](spark, apart, str(tmp_path)))
    removed = {r[0]: r[2] for r in test_substrings.brute(pairs(apart))}
    before, after = dict(pairs(apart)), dict(pairs(cut))
    assert before.keys() == after.keys()
    for i, text in after.items():
        assert len((text or "").split()) == len((before[i] or "").split()) - removed[i]
        assert removed[i] or text == before[i]
    assert passage in after[103] and removed[104] == 60
    assert all(r["n_chars"] == len(r["text"] or "") for r in cut.collect())

    for table in (clean, single, apart, cut):
        assert table.columns == columns
    test_packing.check(cut, 2048)
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert {r["doc_id"] for r in whole.collect()} == after.keys()


def test_odd_and_empty_tables_pass_every_stage(spark, odd, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (odd, odd.limit(0)):
        docs = docs.select("doc_id", "text", "lang", "source", "n_chars")
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = written(stage(spark, docs, str(tmp_path)))
            assert out.columns == docs.columns, name
            assert docs.isEmpty() or not out.isEmpty()
            docs = out
        corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
