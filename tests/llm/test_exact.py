import hashlib
import random
from collections import defaultdict

from clearfold.llm import exact
from clearfold.llm.exact import ExactDuplicates


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        text = text or ""
        groups["".join(c for c in text if c not in "\t\n\x0b\x0c\r ")].append((-len(text), doc_id is None, doc_id or 0, doc_id))
    out = []
    for key, members in groups.items():
        keep = min(members)[3]
        sha = hashlib.sha256(key.encode()).hexdigest()
        out += [(m[3], keep, len(members), m[3] == keep, sha) for m in members]
    return sorted(out, key=str)


def test_against_brute_force(docs_of):
    random.seed(1)
    texts = ["".join(random.choice("ab \n é") for _ in range(random.randint(0, 6))) for _ in range(300)]
    docs = docs_of([*texts, None, *["hot  text"] * 150, "hottext"])
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted(map(tuple, ExactDuplicates(docs).result().collect()), key=str) == brute(rows)


def test_odd_rows(odd):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert sorted(map(tuple, ExactDuplicates(odd).result().collect()), key=str) == brute(rows)


def test_full_field_changes_nothing(docs_of, monkeypatch):
    monkeypatch.setattr(exact, "MAX_BLOCKS", 1)
    monkeypatch.setattr(exact, "BLOCK_BITS", 8)
    docs = docs_of([f"t{i % 40}" for i in range(60)])
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted(map(tuple, ExactDuplicates(docs).result().collect()), key=str) == brute(rows)


def test_distinct_keeps_one_whole_row_of_each_group(odd):
    kept = ExactDuplicates(odd).distinct(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 3, 4, 5, 6]


def test_empty_table(docs_of):
    docs = docs_of([])
    assert ExactDuplicates(docs).result().count() == 0
    assert ExactDuplicates(docs).distinct(docs).count() == 0
