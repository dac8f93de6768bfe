import random

import pytest

from clearfold.llm import near
from clearfold.llm.graph import components


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    label = {i: i for i in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                label[max(x, y)] = min(x, y)
    return sorted((i, len(sets[i]), root(i), root(i) == i) for i in ids)


def edited(words, share, rng):
    return [rng.choice("pqrst") * 3 + str(rng.random()) if rng.random() < share else w for w in words]


def corpus(seed):
    rng = random.Random(seed)
    texts = [" ".join(f"v{rng.randrange(500)}" for _ in range(rng.randint(1, 120))) for _ in range(40)]
    base = [f"b{i}" for i in range(150)]
    texts += [" ".join(edited(base, rng.choice([0.0, 0.01, 0.02, 0.04, 0.08]), rng)) for _ in range(80)]
    passage = [f"p{i}" for i in range(60)]
    texts += [" ".join([*passage, *(f"u{rng.random()}" for _ in range(30))]) for _ in range(30)]
    texts += [texts[0].upper(), "  " + texts[1].replace(" ", "\n"), "One TWO", "one two", "one two three"]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("small", [32, 3])
def test_against_brute_force(docs_of, monkeypatch, small):
    monkeypatch.setattr(near, "SMALL", small)
    monkeypatch.setattr(near, "BLOCK_MEMBERS", 16)
    docs = docs_of(corpus(small)).repartition(4)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted(map(tuple, near.near_duplicates(docs).collect())) == brute(rows)


def test_odd_rows(odd):
    rows = sorted(map(str, near.near_duplicates(odd).collect()))
    found = {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in near.near_duplicates(odd).collect()}
    assert len(rows) == 8
    assert {(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (5, 1, 5, True), (None, 1, None, True)} <= found
    assert next(n for i, n, _, _ in found if i == 4) == 9000


def test_keep_one(docs_of):
    docs = docs_of(["a b c d e f", "A b  c d e f", "other words"])
    kept = near.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 2]


def test_empty_table(docs_of):
    assert near.near_duplicates(docs_of([])).count() == 0


def test_components(spark):
    rng = random.Random(5)
    chain = list(range(100, 180))
    rng.shuffle(chain)
    links = [*zip(chain, chain[1:]), (1, 2), (2, 1), (3, 3), (9, 1), (7, 9)]
    found = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert found == {**{n: 100 for n in chain}, **{n: 1 for n in (1, 2, 9, 7)}}
