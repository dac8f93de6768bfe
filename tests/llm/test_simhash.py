import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from clearfold.llm import simhash


def fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def labels_of(prints):
    label = list(range(len(prints)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 3:
                x, y = root(i), root(j)
                label[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(prints))]


def corpus(seed):
    rng = random.Random(seed)
    texts = [None, "", " \t", "one", "One two", "one TWO three", "one two three four"]
    for _ in range(60):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([3, 20, 150]))]
        for _ in range(rng.randint(1, 4)):
            texts.append(" ".join(w if rng.random() > 0.01 else w.upper() + "x" for w in base))
    return texts + texts[10:20]


def test_against_brute_force(docs_of):
    texts = corpus(1)
    rows = sorted(map(tuple, simhash.near_duplicates(docs_of(texts)).collect()))
    prints = [fingerprint(t) for t in texts]
    assert rows == [(i, f"{p:016x}", c) for i, (p, c) in enumerate(zip(prints, labels_of(prints)))]


def test_fingerprint_is_sparks_hash(spark, docs_of):
    """Where there is one shingle, its bits are the hash that Spark computes with the same seed."""
    docs = docs_of(["a b c", "Ä é 字", "x"])
    own = docs.select("doc_id", F.lower(F.lpad(F.hex(F.xxhash64(F.lower("text"))), 16, "0")).alias("h"))
    expected = {r["doc_id"]: r["h"] for r in own.where("doc_id <> 1").collect()}
    found = {r["doc_id"]: r["fingerprint"] for r in simhash.near_duplicates(docs).collect()}
    assert {i: found[i] for i in expected} == expected


def test_masks_hold_every_close_pair():
    rng = random.Random(2)
    for shared in (0, simhash.masks()[3], simhash.masks(simhash.masks()[3])[7]):
        free = [i for i in range(64) if not shared >> i & 1]
        for _ in range(200):
            flip = sum(1 << i for i in rng.sample(free, 3))
            assert any(not flip & m for m in simhash.masks(shared))
            assert all(m & shared == shared for m in simhash.masks(shared))


@pytest.mark.parametrize("bucket", [256, 32])
def test_dense_buckets_are_cut_further(spark, monkeypatch, bucket):
    """Fingerprints that share most bits; small buckets force several levels."""
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    rng = random.Random(3)
    base, spread = rng.getrandbits(64), rng.sample(range(64), 14)
    prints = list({base ^ sum(1 << i for i in spread if rng.random() < 0.5) for _ in range(400)})
    prints += [rng.getrandbits(64) for _ in range(50)]
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    nodes = spark.createDataFrame(list(enumerate(signed)), "node long, print long")
    links = simhash.links(nodes).collect()
    assert all((prints[r["a"]] ^ prints[r["b"]]).bit_count() <= 3 for r in links)
    from clearfold.llm.graph import components

    found = dict(components(spark.createDataFrame([tuple(r) for r in links], "a long, b long")).collect())
    assert [found.get(i, i) for i in range(len(prints))] == labels_of(prints)


def test_close_links_are_few():
    prints = np.arange(64, dtype=np.uint64)
    assert len(simhash.close_links(list(range(64)), prints)) == 63


def test_odd_rows(odd):
    rows = [tuple(r) for r in simhash.near_duplicates(odd).collect()]
    assert len(rows) == 8
    found = {i: (p, c) for i, p, c in rows}
    assert [found[i] for i in (1, 2, 3)] == [("0" * 16, 1)] * 3
    assert found[5][1] == 5 and found[None][1] is None


def test_repeated_ids_join_their_texts(spark):
    rows = [(1, "a b c d"), (2, "e f g h"), (3, "a b c d"), (3, "e f g h"), (None, "e f g h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["component_id"] for r in simhash.near_duplicates(docs).collect()} == {1}


def test_empty_table(docs_of):
    assert simhash.near_duplicates(docs_of([])).count() == 0
