import hashlib
import random
from collections import defaultdict

import pytest

from clearfold.llm import substrings


def brute(rows, window=13):
    first = {}
    words = [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in words:
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in words:
        gone = set()
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k : k + window])] < i:
                gone.update(range(k, k + window))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus():
    rng = random.Random(3)
    passages = [[f"p{k}_{i}" for i in range(rng.choice([12, 13, 14, 30, 90]))] for k in range(12)]
    texts = []
    for _ in range(120):
        words = []
        for _ in range(rng.randint(0, 5)):
            words += rng.choice(passages) if rng.random() < 0.5 else [f"w{rng.randrange(40)}" for _ in range(rng.randint(1, 30))]
        texts.append(" ".join(words))
    return [*texts, "a " * 50, "a " * 60, texts[0], texts[1].replace(" ", "\n")]


@pytest.mark.parametrize("blocks", [8192, 1])
def test_against_brute_force(docs_of, monkeypatch, blocks):
    monkeypatch.setattr(substrings, "MAX_BLOCKS", blocks)
    docs = docs_of(corpus()).repartition(5)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted(map(tuple, substrings.digests(docs).collect()), key=str) == brute(rows)


def test_odd_rows(odd):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert sorted(map(tuple, substrings.digests(odd).collect()), key=str) == brute(rows)


def test_rewrite_cuts_and_keeps_the_rest(docs_of):
    passage = " ".join(f"p{i}" for i in range(20))
    docs = docs_of([passage, f"before  this\n{passage}  after\nthat ", None, "  untouched  "])
    out = substrings.rewrite(docs)
    assert out.columns == docs.columns
    assert dict(out.select("doc_id", "text").collect()) == {
        0: passage, 1: "before  this\nafter\nthat", 2: None, 3: "  untouched  "}


def test_empty_table(docs_of):
    assert substrings.digests(docs_of([])).count() == 0
    assert substrings.rewrite(docs_of([])).count() == 0


def test_copies_of_a_document_go_whole(docs_of):
    text = " ".join(map(str, range(40)))
    found = substrings.digests(docs_of([text, text, text])).collect()
    removed = defaultdict(int, {r["doc_id"]: r["n_removed"] for r in found})
    assert (removed[0], removed[1], removed[2]) == (0, 40, 40)
