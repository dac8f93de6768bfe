"""Packing of documents into sequences by lexical retrieval.

Each task cuts its documents into shards of bounded size and builds a BM25 index of each. Starting
from a seed, the seed's best unused neighbours follow it until the sequence is full; the document
cut there is the next seed. So a shard is one gapless stream, and nothing is shuffled. What is left
at a shard's end is cut into powers of two, which need no padding; no sequence has any.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from clearfold.llm.common import id_and_bytes, mix, seeds, texts_of

LENGTH = 2048
END_ID = 1
SHARD_DOCUMENTS = 1024
SHARD_TOKENS = 1 << 21
K1, B = 1.2, 0.75
# Terms of one document lead nowhere. The weights of terms of over a quarter of all documents are kept as
# rows over all of them, which add up faster than postings.
COMMON_SHARE = 4

# Fixed value: the pattern of the tokenizer's pre-tokenisation. What needs no look ahead is one group, which
# matches the same and is not tried branch by branch.
PATTERN = r"""(?:'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+)|\s+(?!\S)|\s+"""


def _bytes_of() -> dict[str, int]:
    """Which byte each character of a byte-level vocabulary stands for: printable ones for
    themselves, the others for the code points from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(others)}


class PackTokenizer:
    """Ids of texts, and the terms that they spell.

    Texts are merged by rank, which gives the tokenizer's ids faster: ranks merge as the file's list
    of merges does if ids follow that list, which is checked. Texts that spell out a special token go
    to the tokenizer itself, which cuts them there first.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        self.specials = {t["content"]: t["id"] for t in content["added_tokens"]}
        vocabulary = {t: i for t, i in content["model"]["vocab"].items() if t not in self.specials}
        merges = [m if isinstance(m, list) else m.split(" ") for m in content["model"]["merges"]]
        if any(vocabulary["".join(m)] != 256 + k for k, m in enumerate(merges)):
            raise ValueError("the ids do not follow the merges")
        of = _bytes_of()
        ranks = {bytes(of[c] for c in token): i for token, i in vocabulary.items()}
        # Without special tokens to look for, tiktoken stops at every character of a text to look for one.
        self.ranks = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=self.specials)
        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.begins = np.ones(size, bool)
        for token, i in ranks.items():
            self.begins[i] = not token[:1].isalnum() and token[0] < 128
        self.worth = mix(np.arange(1, size + 1, dtype=np.uint64))

    def encode(self, text: str) -> np.ndarray:
        if any(s in text for s in self.specials):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.ranks.encode_to_numpy(text, disallowed_special=())

    def terms(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct words, as hashes of their ids, and how often each occurs. A word begins with
        an id that spells a space or a sign first."""
        if not len(ids):
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        first = self.begins[ids]
        first[0] = True
        starts = np.flatnonzero(first)
        place = np.arange(len(ids)) - np.repeat(starts, np.diff(np.append(starts, len(ids))))
        words = np.add.reduceat(self.worth[ids] * _PLACE[np.minimum(place, len(_PLACE) - 1)], starts)
        return np.unique(words, return_counts=True)


_PLACE = seeds(64, 31) | np.uint64(1)


@lru_cache(maxsize=1)
def tokenizer_of(path: str) -> PackTokenizer:
    return PackTokenizer(path)


Terms = tuple[np.ndarray, np.ndarray]


class Index:
    """BM25 over the documents of a shard, each given by its terms and their numbers."""

    def __init__(self, documents: list[Terms]):
        self.n = len(documents)
        owner = np.repeat(np.arange(self.n), [len(t) for t, _ in documents])
        times = np.concatenate([c for _, c in documents]).astype(np.float64)
        distinct, every = np.unique(np.concatenate([t for t, _ in documents]), return_inverse=True)
        lengths = np.bincount(owner, times, self.n)
        df = np.bincount(every, minlength=len(distinct))
        keep = (df > 1)[every]
        every, owner, times = every[keep], owner[keep], times[keep]
        idf = np.log1p((self.n - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - B + B * lengths / max(1.0, lengths.mean()))
        weights = idf[every] * times * (K1 + 1) / (times + norm[owner])
        common = df * COMMON_SHARE > max(8, self.n)
        row = np.cumsum(common) - 1
        dense = common[every]
        self.rows = np.zeros((int(common.sum()), self.n))
        self.rows[row[every[dense]], owner[dense]] = weights[dense]
        self.row_terms = self._of_documents(row[every[dense]], owner[dense])
        every, owner, weights = every[~dense], owner[~dense], weights[~dense]
        order = np.argsort(every, kind="stable")
        self.documents = owner[order]
        self.weights = weights[order]
        self.begins = np.searchsorted(every[order], np.arange(len(distinct) + 1))
        self.terms = self._of_documents(every, owner)

    def _of_documents(self, values: np.ndarray, owner: np.ndarray) -> list[np.ndarray]:
        return np.split(values, np.cumsum(np.bincount(owner, minlength=self.n))[:-1])

    def neighbours(self, seed: int) -> list[int]:
        """Documents that share a term with the seed, best first; ties by place."""
        terms = self.terms[seed]
        begins, ends = self.begins[terms], self.begins[terms + 1]
        sizes = ends - begins
        places = np.arange(sizes.sum()) + np.repeat(begins - np.cumsum(sizes) + sizes, sizes)
        scores = np.bincount(self.documents[places], self.weights[places], self.n)
        scores = scores + self.rows[self.row_terms[seed]].sum(axis=0)
        scores[seed] = 0
        found = np.flatnonzero(scores)
        return found[np.argsort(-scores[found], kind="stable")].tolist()


def arrange(index: Index, sizes: list[int], length: int) -> list[int]:
    """The order in which the documents of a shard follow each other."""
    unused = dict.fromkeys(range(len(sizes)))
    order: list[int] = []
    position, following = 0, iter(())
    while unused:
        document = next((d for d in following if d in unused), None)
        fresh = document is None
        if fresh:
            document = next(iter(unused))
        del unused[document]
        order.append(document)
        before, position = position // length, position + sizes[document]
        if fresh or position // length != before:
            following = iter(index.neighbours(document))
    return order


def cuts(total: int, length: int) -> list[int]:
    """Where the sequences of a stream begin: full ones, then powers of two; and its end."""
    begins = list(range(0, total, length))
    if total % length:
        at, rest = begins[-1], total % length
        while rest:
            power = 1 << (rest.bit_length() - 1)
            at, rest = at + power, rest - power
            begins.append(at)
        return begins
    return [*begins, total]


Piece = tuple[int | None, int, int, int, int, int, int]


def pack_shard(ids: list[int | None], tokens: list[np.ndarray], terms: list[Terms], length: int) -> list[Piece]:
    """doc_id, start, length, crc32 of the ids, tokens of the document, sequence of the shard, offset."""
    sizes = [len(t) for t in tokens]
    begins = cuts(sum(sizes), length)
    pieces: list[Piece] = []
    sequence, position = 0, 0
    for document in arrange(Index(terms), sizes, length):
        start = 0
        while start < sizes[document]:
            take = min(sizes[document] - start, begins[sequence + 1] - position)
            crc = zlib.crc32(tokens[document][start : start + take].tobytes())
            offset = position - begins[sequence]
            pieces.append((ids[document], start, take, crc, sizes[document], sequence, offset))
            start, position = start + take, position + take
            if position == begins[sequence + 1]:
                sequence += 1
    return pieces


NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def _packed(batches: Iterator[pa.RecordBatch], path: str, length: int, end_id: int) -> Iterator[pa.RecordBatch]:
    tokenizer = tokenizer_of(path)
    next_sequence = TaskContext.get().partitionId() << 33
    ids, tokens, terms, size = [], [], [], 0

    def flush() -> pa.RecordBatch:
        nonlocal next_sequence, size
        columns = list(zip(*pack_shard(ids, tokens, terms, length)))
        arrays = [pa.array(c, pa.int64()) for c in columns]
        sequences = np.array(columns[5], np.int64)
        arrays[5] = pa.array(sequences + next_sequence)
        next_sequence += int(sequences.max()) + 1
        ids.clear(), tokens.clear(), terms.clear()
        size = 0
        return pa.RecordBatch.from_arrays(arrays, NAMES)

    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch.column("text"))):
            own = tokenizer.encode(text)
            ids.append(doc_id)
            terms.append(tokenizer.terms(own))
            tokens.append(np.append(own, np.uint32(end_id)))
            size += len(tokens[-1])
            if len(ids) >= SHARD_DOCUMENTS or size >= SHARD_TOKENS:
                yield flush()
    if ids:
        yield flush()


def pack(docs: DataFrame, path: str, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset: one row per piece.

    A document's ids are those of the tokenizer file `path`, then `end_id`; null texts count as
    empty and give that one id, bytes that are not UTF-8 as replacement characters. Rows that share a doc_id are packed as documents of their own.
    """
    rows = id_and_bytes(docs)
    return rows.mapInArrow(partial(_packed, path=path, length=length, end_id=end_id), ", ".join(f"{n} long" for n in NAMES))
