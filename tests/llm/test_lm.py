import math
import zlib
from collections import Counter

import pytest

from clearfold.llm import lm


def brute(rows, order, strength):
    def tokens(text):
        return [*(text or "").encode().lower().split(), None]

    def held(i):
        return zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2

    counts = Counter()
    for i, text in rows:
        if not held(i):
            t = tokens(text)
            counts.update(tuple(t[k - n : k]) for n in range(1, order + 1) for k in range(n, len(t) + 1))
    single = {g: c for g, c in counts.items() if len(g) == 1}
    total, distinct = sum(single.values()), len(single)
    out = []
    for i, text in rows:
        t = tokens(text)
        base = score = 0.0
        for k in range(len(t)):
            p = (counts[(t[k],)] + 1) / (total + distinct + 1)
            base += math.log10(p)
            for n in range(1, min(k, order - 1) + 1):
                state = counts[tuple(t[k - n : k])]
                p = (counts[tuple(t[k - n : k + 1])] + strength * p) / (state + strength)
            score += math.log10(p)
        known = sum(counts[(x,)] > 0 for x in t)
        out.append((i, held(i), len(t), known, total, round(base, 6), round(score, 6)))
    return sorted(out, key=str)


def found(docs, **settings):
    rows = lm.scores(docs, **settings)
    rows = rows.withColumns({c: lm.rounded(rows[c]) for c in ("base_score", "score")})
    return sorted(map(tuple, rows.collect()), key=str)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_against_brute_force(docs_of, monkeypatch, order):
    monkeypatch.setattr(lm, "BLOCK_BYTES", 300)
    texts = [f"The cat {k % 7} sat\non the MAT {k % 5} the end" for k in range(60)]
    docs = docs_of([*texts, None, "", "x", "the the the"])
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert found(docs, order=order, strength=3.0) == brute(rows, order, 3.0)


def test_odd_rows(odd):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert found(odd, strength=5.0) == brute(rows, 2, 5.0)


def test_empty_table_and_no_training(docs_of):
    assert lm.scores(docs_of([])).count() == 0
    held = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 7 == 2)
    assert found(docs_of({held: "a b"})) == [(held, True, 3, 0, 0, 0.0, 0.0)]
