import math
import random

import pytest

from clearfold.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, rank int, score long"


def brute(rows):
    taking = []
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            taking.append((i, [math.floor(256 * x) for x in v], (label + 1) % 10 if i % 7 == 0 else label))
    out = []
    for i, v, label in taking:
        if i % 50:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, other) for j, w, other in taking if j != i)
        for p, j, _ in [x for x in scored if x[2] == label][:5]:
            fit = [(n, k) for n, k, other in scored if other != label and 50 * -p <= 100 * -n <= 95 * -p]
            out += [(i, j, r, k, -p, -n) for r, (n, k) in enumerate(fit[:3], 1)]
    return sorted(out)


def corpus(seed, n=400, width=20):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 0.3) for _ in range(width)] for _ in range(10)]
    rows = []
    for i in range(n):
        label = rng.randrange(10)
        # Eighths and few values, so that scores tie.
        v = [round(8 * (c + rng.gauss(0.1, 0.2))) / 8 for c in centres[label]]
        rows.append((i, v[: rng.choice([width, width, width - 3])], label if rng.random() > 0.05 else (label + 3) % 10))
    rows += [(n + k, rows[3][1], rows[3][2]) for k in range(40)]
    rows += [(1050, None, 1), (1100, [1.0, None], 1), (1150, [float("nan")], 2), (1200, [float("inf")], 2), (None, [1.0], 1)]
    return rows + [(1250, [0.5] * width, None), (1300, [0.0] * width, 3), (1350, [], 3)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA)


@pytest.mark.parametrize("blocks", [None, (64, 4, 2)])
def test_against_brute_force(spark, monkeypatch, blocks):
    if blocks:
        for name, n in zip(("BLOCK_ROWS", "BLOCK_ANCHORS", "RUN"), blocks):
            monkeypatch.setattr(negatives, name, n)
    rows = corpus(1)
    expected = brute(rows)
    assert len(expected) > 20
    assert sorted(map(tuple, negatives.hard_negatives(frame(spark, rows).repartition(3)).collect())) == expected


def test_scan_drops_nothing_that_matters():
    rng = random.Random(4)
    rows = [{"vec_id": i, "label": i % 3, "vector": [rng.randrange(-50, 50) for _ in range(40)]} for i in range(500)]
    block = negatives.Block(rows, 40)
    for anchor in rows[:20]:
        others = [r for r in rows if r["label"] == anchor["label"] and r["vec_id"] != anchor["vec_id"]]
        scored = [(sum(a * b for a, b in zip(anchor["vector"], r["vector"])), r["vec_id"]) for r in others]
        assert negatives.positives_in(block, anchor, 40, []) == sorted(scored, key=lambda x: (-x[0], x[1]))[:5]


def test_windows_are_exact():
    for p in (0, 1, 19, 20, 21, 99, 100, 10**15 + 7):
        least, most = negatives.window(p)
        assert 50 * p <= 100 * least < 50 * p + 100 and 95 * p - 100 < 100 * most <= 95 * p


def test_repeated_and_huge_rows(spark):
    rows = [(0, [1.0], 1), (0, [1.0], 1), (1, [1.0], 1), (2, [0.75], 2), (50, [3e38, -3e38], 1)]
    found = sorted(map(tuple, negatives.hard_negatives(frame(spark, rows)).collect()))
    # 0 is divisible by 7, so its label is 2 there; the copies of row 0 are not each other's positives.
    assert all(r[0] in (0, 50) and r[1] != r[0] for r in found)
    assert found == sorted(set(found))


def test_empty_table(spark):
    assert negatives.hard_negatives(frame(spark, [])).count() == 0
