"""Word-piece token counts by a linear longest-match automaton, without building pieces.

The vocabulary becomes a trie. Each node has a failure link, the node that matches the rest of its
string once the longest tokens at its front are taken off, and the number of tokens so taken. A word
is read once; the counts met on failure links add up to what greedy longest matching would give.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache, partial

import pyarrow as pa
from pyspark.sql import DataFrame

from clearfold.llm.bpe import Cache
from clearfold.llm.common import id_and_bytes

ROOT = 0
UNKNOWN = 1


class LongestMatch:
    """Counts the tokens of greedy longest matching; tokens are byte strings.

    A word with a byte sequence that no token begins is one unknown token, as in word-piece.
    """

    def __init__(self, vocabulary: list[bytes]):
        child: dict[int, int] = {}
        parents, symbols, is_token = [ROOT], [0], [False]
        for token in vocabulary:
            node = ROOT
            for symbol in token:
                key = node << 8 | symbol
                found = child.get(key)
                if found is None:
                    found = child[key] = len(parents)
                    parents.append(node)
                    symbols.append(symbol)
                    is_token.append(False)
                node = found
            is_token[node] = node != ROOT
        self.child = child
        self.link: list[int | None] = [None] * len(parents)
        self.popped = [0] * len(parents)
        for node in self._by_depth(parents):
            if is_token[node]:
                self.link[node], self.popped[node] = ROOT, 1
                continue
            at, count = self.link[parents[node]], self.popped[parents[node]]
            while at is not None and (at << 8 | symbols[node]) not in child:
                count += self.popped[at]
                at = self.link[at]
            if at is not None:
                self.link[node], self.popped[node] = child[at << 8 | symbols[node]], count

    @staticmethod
    def _by_depth(parents: list[int]) -> list[int]:
        depth = [0] * len(parents)
        for node in range(1, len(parents)):
            depth[node] = depth[parents[node]] + 1
        return sorted(range(1, len(parents)), key=depth.__getitem__)

    def count(self, word: bytes) -> int:
        child, link, popped = self.child, self.link, self.popped
        node, total = ROOT, 0
        for symbol in word:
            while (following := child.get(node << 8 | symbol)) is None:
                total += popped[node]
                node = link[node]
                if node is None:
                    return UNKNOWN
            node = following
        while node != ROOT:
            total += popped[node]
            node = link[node]
            if node is None:
                return UNKNOWN
        return total


@lru_cache(maxsize=2)
def automaton(path: str) -> LongestMatch:
    with open(path, "rb") as lines:
        return LongestMatch([base64.b64decode(line.split()[0]) for line in lines if line.strip()])


def _counts(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    match = automaton(path)
    cache = Cache(lambda word: match.count(b" " + word))
    for batch in batches:
        words, tokens = [], []
        for text in batch.column("text").to_pylist():
            counts = [cache[word] for word in text.split()]
            words.append(len(counts))
            tokens.append(sum(counts))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())],
            ["doc_id", "n_words", "n_tokens"],
        )


def token_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_words, n_tokens: one row per row of `docs` (doc_id, text).

    Words are runs of anything but ASCII white space; each is matched with one space before it
    against the file of ranks `vocabulary`. Null and empty texts have no words and no tokens.
    """
    return id_and_bytes(docs).mapInArrow(
        partial(_counts, path=vocabulary), "doc_id long, n_words long, n_tokens long"
    )
