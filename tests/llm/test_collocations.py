import random
import re
from collections import Counter

import pytest

from clearfold.llm import collocations


def brute(rows, least=10, longest=3, top=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang, data = lang or "und", (text or "").encode().lower()
        for piece in re.split(rb"[.,;:!?\n\x0b\x0c\r]", data):
            words = [w for w in re.split(rb"[ \t]+", piece) if w]
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f.update((lang, *words[i : i + k]) for i in range(len(words) - k + 1))
    often = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    out = []
    for p, a in often.items():
        if any(len(q) > len(p) and q[0] == p[0] and 100 * b >= 50 * a
               and any(q[i : i + len(p) - 1] == p[1:] for i in range(1, len(q))) for q, b in often.items()):
            continue
        cuts = [(1_000_000 * a * a // (f[p[:k]] * f[(p[0], *p[k:])]), k) for k in range(2, len(p))]
        score, k = min(cuts)
        out.append((p[0], -score, -a, b" ".join(p[1:]), f[p[:k]], f[(p[0], *p[k:])], n[p[0]]))
    ranked, rank = [], Counter()
    for lang, score, a, phrase, left, right, total in sorted(out):
        rank[lang] += 1
        if rank[lang] <= top:
            ranked.append((lang, rank[lang], phrase.decode(), -a, left, right, total, -score))
    return ranked


def corpus(seed, size=300):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)]
    fixed = ["New York City", "by and large", "ping pong", "a b a b a", "one two three four"]
    rows = [(None, None), ("en", ""), ("en", " \t\n"), ("de", "...")]
    for _ in range(size):
        words = []
        for _ in range(rng.randrange(30)):
            words.append(rng.choice(fixed) if rng.random() < 0.2 else rng.choice(vocabulary[: rng.choice([3, 40])]))
            words.append(rng.choice([" ", "  ", "\t", ", ", ".", "\n", " ! "]) if rng.random() < 0.3 else " ")
        rows.append((rng.choice(["en", "de", None]), "".join(words)))
    return rows + rows[20:60]


@pytest.mark.parametrize("shards, longest, top", [(2, 3, 2000), (3, 4, 5)])
def test_against_brute_force(spark, shards, longest, top):
    rows = corpus(shards)
    docs = spark.createDataFrame([(i, lang, t) for i, (lang, t) in enumerate(rows)], "doc_id long, lang string, text string")
    found = collocations.collocations(docs.repartition(3), top, longest=longest, shards=shards)
    expected = brute(rows, longest=longest, top=top)
    assert len(expected) > 10
    assert sorted(map(tuple, found.collect())) == expected


def test_crowded_field(spark, monkeypatch):
    """Where phrases share places, more of them are counted, and none twice."""
    monkeypatch.setattr(collocations, "FIELD_BITS", 4)
    rows = corpus(7, 150)
    docs = spark.createDataFrame([(i, lang, t) for i, (lang, t) in enumerate(rows)], "doc_id long, lang string, text string")
    assert sorted(map(tuple, collocations.collocations(docs).collect())) == brute(rows)


def test_large_counts_are_exact(spark):
    rows = [(10**14 + 7, 10**14 + 9, 10**14 + 11), (999_999_999_999_989, 999_999_999_999_989, 999_999_999_999_989)]
    counts = spark.createDataFrame(rows, "a long, l long, r long").selectExpr(
        *(f"CAST({c} AS DECIMAL(15,0)) AS {c}_" for c in "alr")
    )
    found = [r[0] for r in counts.selectExpr("(a_ * a_ * 1000000BD) div (l_ * r_)").collect()]
    assert found == [10**6 * a * a // (b * c) for a, b, c in rows]


def test_odd_rows_and_empty_table(odd, docs_of):
    assert collocations.collocations(odd).count() == 0
    assert collocations.collocations(odd, least=2, top=50_000).where("phrase = 'one two'").collect()[0]["a"] == 2
    assert collocations.collocations(docs_of([])).count() == 0
