"""Memory of scoring a block, in plain Python."""

from __future__ import annotations

import tracemalloc

import numpy as np

from clearfold.operators import scoring


def test_a_full_slice_of_questions_is_finished_in_parts(monkeypatch):
    rng = np.random.default_rng(7)
    vectors = [np.unique(rng.integers(0, 4000, 60)) for _ in range(2048)]
    rows = [
        {"question_id": i, "q_norm": len(v) ** 0.5, "q_terms": [str(t) for t in v], "q_counts": [1] * len(v)}
        for i, v in enumerate(vectors[:1024])
    ]
    asked = scoring.Questions(rows)
    places = {t: i for i, t in enumerate(asked.terms)}
    held = [[places[str(t)] for t in v if str(t) in places] for v in vectors[1024:]]
    chunk = np.repeat(np.arange(1024), [len(h) for h in held])
    norms = np.array([len(v) ** 0.5 for v in vectors[1024:]])
    block = scoring.Block(np.arange(1024), norms, chunk, np.concatenate(held).astype(np.int64), np.ones(len(chunk)))
    least = np.zeros(1024)
    tracemalloc.start()
    found = scoring.scores(asked, block, least, None)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    print("peak", peak)
    assert peak < 60e6
    monkeypatch.setattr(scoring, "ASKED", 1024)
    for one, other in zip(found, scoring.scores(asked, block, least, None)):
        assert np.array_equal(one, other)
