import random
import time
import zlib
from collections import defaultdict

import numpy as np
import tiktoken
from tokenizers import Tokenizer

from clearfold.llm import packing
from clearfold.llm.common import TOKENIZERS

PATH = f"{TOKENIZERS}/byte_bpe_50k.json"


def check(docs, length):
    """Each id of each document in one piece; sequences gapless, full or a power of two long."""
    tokenizer = Tokenizer.from_file(PATH)
    wanted = defaultdict(list)
    for r in docs.collect():
        ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [1]
        wanted[r["doc_id"], len(ids)].append(ids)
    rows = packing.pack(docs, PATH, length).collect()
    sequences, covered = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        covered[r["doc_id"], r["doc_tokens"]].append((r["start"], r["length"], r["ids_crc32"]))
    for pieces in sequences.values():
        end = 0
        for offset, size in sorted(pieces):
            assert offset == end and size > 0
            end += size
        assert end == length or end & (end - 1) == 0
    assert covered.keys() == wanted.keys()
    for key, pieces in covered.items():
        assert sum(size for _, size, _ in pieces) == sum(map(len, wanted[key]))
        crcs = {
            (start, size): zlib.crc32(np.array(ids[start : start + size], "<u4").tobytes())
            for ids in wanted[key] for start, size, _ in pieces
        }
        assert all(crcs[start, size] == crc for start, size, crc in pieces)
    return sequences


def test_pieces(docs_of, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_DOCUMENTS", 16)
    texts = [f"Common words of topic{k % 4} and its own thing{k} " * (k % 9) for k in range(100)]
    sequences = check(docs_of([*texts, None]).repartition(2), 64)
    assert len(sequences) > 10


def test_odd_rows(odd):
    check(odd, 2048)


def test_empty_table(docs_of):
    assert packing.pack(docs_of([]), PATH).count() == 0


def test_neighbours_share_terms():
    tokenizer = packing.tokenizer_of(PATH)
    shards = [" red fox", " blue sea", " red fox den", " sea blue boat", " none"]
    index = packing.Index([tokenizer.terms(tokenizer.encode(s)) for s in shards])
    assert index.neighbours(0) == [2] and index.neighbours(3) == [1] and index.neighbours(4) == []
    assert packing.arrange(index, [10] * 5, 20) == [0, 2, 1, 3, 4]
    assert packing.cuts(20 + 13, 20) == [0, 20, 28, 32, 33]


def test_frequent_terms_count_as_bm25_says():
    """Documents 0 and 1 share only a term that over a quarter of all have."""
    terms = [{1, 2}, {1, 3}, {4}, {1, 5, 6}, {7, 8}, {7, 9}, {10}, {11}, {12}, {8, 9}]
    documents = [(np.array(sorted(t), np.uint64), np.array([1 + (x == 1) * (i == 3) for x in sorted(t)])) for i, t in enumerate(terms)]
    index = packing.Index(documents)
    df = {x: sum(x in t for t in terms) for t in terms for x in t}
    lengths = [int(c.sum()) for _, c in documents]

    def bm25(seed, other):
        norm = packing.K1 * (1 - packing.B + packing.B * lengths[other] * len(terms) / sum(lengths))
        own = dict(zip(*map(list, documents[other])))
        return sum(
            np.log1p((len(terms) - df[x] + 0.5) / (df[x] + 0.5)) * own[x] * (packing.K1 + 1) / (own[x] + norm)
            for x in terms[seed] & terms[other]
        )

    assert df[1] * packing.COMMON_SHARE > len(terms)
    for seed in range(len(terms)):
        scores = {d: bm25(seed, d) for d in range(len(terms)) if d != seed and terms[d] & terms[seed]}
        assert index.neighbours(seed) == sorted(scores, key=lambda d: (-round(scores[d], 9), d))
    assert index.neighbours(0) == [3, 1] or index.neighbours(0) == [1, 3]


def test_ids_are_the_tokenizers():
    tokenizer = packing.tokenizer_of(PATH)
    texts = ["a  b\n c", " lead", "tail ", "it's  <|endoftext|> x", "\x1c \x85 y", "", "word word", "Größe 字 ½"]
    whole = [tokenizer.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [tokenizer.encode(t).tolist() for t in texts] == whole


def test_ids_of_odd_texts_are_the_tokenizers():
    tokenizer = packing.tokenizer_of(PATH)
    some = [*"aZé字ß0½٣'stremvld' \t\n\r\x0b\x0c\x1c\x85\xa0\u3000!.-_<|>\u200b\ufffd😀\0", "  ", " '", "'ll", "\n\n", "<|endoftext"]
    chance = random.Random(5)
    texts = ["".join(chance.choices(some, k=chance.randrange(14))) for _ in range(5000)]
    for text in texts:
        assert tokenizer.encode(text).tolist() == tokenizer.tokenizer.encode(text, add_special_tokens=False).ids


def test_texts_are_not_stopped_at_for_special_tokens():
    """Encoding takes clearly less than by branches tried in turn and a stop at every character."""
    tokenizer = packing.tokenizer_of(PATH)
    assert tokenizer.ranks.special_tokens_set == set(tokenizer.specials) != set()
    branches = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    plain = tiktoken.Encoding("plain", pat_str=branches, mergeable_ranks=tokenizer.ranks._mergeable_ranks, special_tokens={})
    text = "It's the water that was found, not more than 100 people in the house. " * 3000

    def seconds(encode):
        begin = time.process_time()
        encode(text)
        return time.process_time() - begin

    times = [(seconds(tokenizer.encode), seconds(lambda t: plain.encode_to_numpy(t, disallowed_special=()))) for _ in range(9)]
    own, other = map(min, zip(*times))
    assert own < 0.75 * other


def test_terms_are_words_with_their_numbers():
    tokenizer = packing.tokenizer_of(PATH)
    one, numbers = tokenizer.terms(tokenizer.encode(" unforeseen fox, unforeseen end."))
    assert sorted(numbers) == [1, 1, 1, 1, 2]
    assert set(tokenizer.terms(tokenizer.encode(" fox"))[0]) <= set(one)
