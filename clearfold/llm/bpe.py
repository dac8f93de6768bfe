"""Byte-level BPE encoding and decoding, with vectorised pre-tokenisation.

Every code point has a class. A small automaton reads the classes from left to right; its states
say what a token may do next. Since transition functions compose associatively, the text is laid out
as rows that are scanned side by side: first each row's composed function, then the state in which
each row begins, then the state after every code point. The states and the neighbouring classes
give the places where tokens begin. The slices go through pair merging, whose results are cached.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearfold.llm.common import id_and_bytes, ship, texts_of

# Classes of code points. The letters are those that contractions are made of.
SPACE, OTHER_WHITE, DIGIT, SIGN, APOSTROPHE, LETTER, LETTER_STMD, LETTER_RV, LETTER_E, LETTER_L = range(10)
WHITE_POINTS = [
    9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]
CONTRACTION_CLASSES = {"s": LETTER_STMD, "t": LETTER_STMD, "m": LETTER_STMD, "d": LETTER_STMD,
                       "r": LETTER_RV, "v": LETTER_RV, "e": LETTER_E, "l": LETTER_L}

# States: what was read last. OPEN: an apostrophe that begins a token; DONE: a contraction's end;
# HALF_E, HALF_L: an opened contraction that lacks its e or l.
AFTER_WHITE, AFTER_SPACE, IN_LETTERS, IN_DIGITS, IN_SIGNS, OPEN, DONE, HALF_E, HALF_L = range(9)

# Pieces up to this size are merged by looking through all pairs, longer ones with a heap.
SHORT = 48


def _next(state: int, kind: int) -> int:
    if kind == SPACE:
        return AFTER_SPACE
    if kind == OTHER_WHITE:
        return AFTER_WHITE
    if kind == DIGIT:
        return IN_DIGITS
    if kind == SIGN:
        return IN_SIGNS
    if kind == APOSTROPHE:
        return IN_SIGNS if state in (AFTER_SPACE, IN_SIGNS, OPEN) else OPEN
    if state == OPEN and kind == LETTER_STMD:
        return DONE
    if state == OPEN and kind == LETTER_RV:
        return HALF_E
    if state == OPEN and kind == LETTER_L:
        return HALF_L
    if (state, kind) in ((HALF_E, LETTER_E), (HALF_L, LETTER_L)):
        return DONE
    return IN_LETTERS


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class of each code point; composition of functions with symbols; their values by state.

    Symbols 10 to 19 are the classes of a text's first code point, whatever came before it. The
    functions are those that symbols compose to; number 0 is the identity.
    """
    kinds = np.full(0x110000, SIGN, np.uint8)
    for point in range(0x110000):
        major = unicodedata.category(chr(point))[0]
        if major == "L":
            kinds[point] = LETTER
        elif major == "N":
            kinds[point] = DIGIT
    kinds[WHITE_POINTS] = OTHER_WHITE
    kinds[32], kinds[39] = SPACE, APOSTROPHE
    for letter, kind in CONTRACTION_CLASSES.items():
        kinds[ord(letter)] = kind
    states = range(9)
    symbols = [tuple(_next(s, k) for s in states) for k in range(10)]
    symbols += [(_next(AFTER_WHITE, k),) * 9 for k in range(10)]
    functions = {tuple(states): 0}
    rows, waiting = [], [tuple(states)]
    for f in waiting:
        row = []
        for g in symbols:
            h = tuple(g[x] for x in f)
            if h not in functions:
                functions[h] = len(functions)
                waiting.append(h)
            row.append(functions[h])
        rows.append(row)
    return kinds, np.array(rows, np.uint8), np.array(waiting, np.uint8)


def scan(symbols: np.ndarray) -> np.ndarray:
    """State after every symbol, from a beginning after white space."""
    _, compose, value = _tables()
    n = len(symbols)
    if n == 0:
        return np.zeros(0, np.uint8)
    width = max(16, int(np.sqrt(n)))
    height = -(-n // width)
    padded = np.zeros(width * height, np.uint8)
    padded[:n] = symbols
    columns = np.ascontiguousarray(padded.reshape(height, width).T)
    prefix = np.zeros((width, height), np.uint8)
    composed = np.zeros(height, np.uint8)
    for k in range(width):
        composed = compose[composed, columns[k]]
        prefix[k] = composed
    begins = np.zeros(height, np.uint8)
    state = AFTER_WHITE
    for row, f in enumerate(composed.tolist()):
        begins[row] = state
        state = value[f, state]
    return np.ascontiguousarray(value[prefix, begins].T).reshape(-1)[:n]


def token_starts(points: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Whether a token of the pattern begins at each code point; texts begin at `firsts`."""
    kinds = _tables()[0][points]
    n = len(points)
    begins = np.zeros(n + 1, bool)
    begins[firsts] = True
    begins[n] = True
    symbols = kinds + np.uint8(10) * begins[:n]
    states = scan(symbols)
    white = kinds <= OTHER_WHITE
    group = np.minimum(kinds, LETTER)
    group[kinds == APOSTROPHE] = SIGN
    before_state = np.concatenate([[AFTER_WHITE], states[:-1]])
    before_group = np.concatenate([[OTHER_WHITE], group[:-1]])
    starts = (before_group != group) & (before_state != AFTER_SPACE)
    starts |= before_state == DONE
    last = np.ones(n, bool)
    last[:-1] = ~white[1:]
    last &= ~begins[1:]
    run = np.concatenate([[False], white[:-1]])
    starts = np.where(white, ~run | last, starts) | begins[:n]
    done = states == DONE
    starts[done] = False
    starts[np.flatnonzero(done & (before_state >= HALF_E)) - 1] = False
    return starts


class Ranks:
    """A vocabulary of ranks and the merging of pairs by it."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.bytes = {rank: token for token, rank in self.ranks.items()}

    def merge(self, piece: bytes) -> list[int]:
        ranks = self.ranks
        if piece in ranks:
            return [ranks[piece]]
        if len(piece) > SHORT:
            return self._merge_long(piece)
        parts = [piece[i : i + 1] for i in range(len(piece))]
        pairs = [ranks.get(parts[i] + parts[i + 1]) for i in range(len(parts) - 1)]
        while True:
            best, at = None, -1
            for i, rank in enumerate(pairs):
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                return [ranks[p] for p in parts]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at < len(pairs):
                pairs[at] = ranks.get(parts[at] + parts[at + 1])
            if at:
                pairs[at - 1] = ranks.get(parts[at - 1] + parts[at])

    def _merge_long(self, piece: bytes) -> list[int]:
        """The same over a linked list of parts, with the pairs in a heap."""
        ranks, n = self.ranks, len(piece)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        ends, alive = list(range(1, n + 1)), [True] * n

        def pair(i: int) -> tuple[int, int, int, int] | None:
            j = after[i]
            rank = ranks.get(piece[i : ends[j]]) if j < n else None
            return None if rank is None else (rank, i, ends[i], ends[j])

        heap = [x for x in map(pair, range(n)) if x]
        heapq.heapify(heap)
        while heap:
            _, i, middle, end = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or ends[i] != middle or j >= n or ends[j] != end:
                continue
            ends[i], after[i], alive[j] = end, after[j], False
            if after[i] < n:
                before[after[i]] = i
            for k in (i, before[i]):
                if k >= 0 and (found := pair(k)):
                    heapq.heappush(heap, found)
        return [ranks[piece[i : ends[i]]] for i in range(n) if alive[i]]


@lru_cache(maxsize=2)
def ranks_of(path: str) -> Ranks:
    return Ranks(path)


class Cache(dict):
    """Values of a function of strings, in two generations of bounded size."""

    def __init__(self, compute, size: int = 300_000):
        super().__init__()
        self.compute, self.size, self.old = compute, size, {}

    def __missing__(self, key):
        found = self.old.get(key)
        if found is None:
            found = self.compute(key)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = found
        return found


class Encoder:
    """Encodes and decodes texts; ids travel as little-endian unsigned 32-bit integers."""

    AT_ONCE = 1 << 20

    def __init__(self, path: str):
        self.ranks = ranks_of(path)
        self.cache = Cache(lambda s: np.array(self.ranks.merge(s.encode()), "<u4").tobytes())

    def pieces(self, texts: list[str]) -> Iterator[tuple[str, list[int]]]:
        """Each text with the places where its tokens of the pattern begin, and its length."""
        row = 0
        while row < len(texts):
            end, size = row, 0
            while end < len(texts) and (end == row or size + len(texts[end]) <= self.AT_ONCE):
                size += len(texts[end])
                end += 1
            some = texts[row:end]
            offsets = np.cumsum([0, *map(len, some)])
            points = np.frombuffer("".join(some).encode("utf-32-le"), "<u4")
            nonempty = offsets[:-1][np.diff(offsets) > 0]
            places = np.flatnonzero(token_starts(points, nonempty)) if len(points) else np.zeros(0, int)
            cuts = np.searchsorted(places, offsets)
            for k, text in enumerate(some):
                yield text, [*(places[cuts[k] : cuts[k + 1]] - offsets[k]).tolist(), len(text)]
            row = end

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        cache = self.cache
        for text, places in self.pieces(texts):
            yield b"".join([cache[text[a:b]] for a, b in zip(places, places[1:])])

    def encode_with_offsets(self, texts: list[str]) -> Iterator[tuple[bytes, np.ndarray]]:
        """Also the byte at which each id's part of the UTF-8 text begins, and the text's length."""
        for ids in self.encode(texts):
            sizes = [len(self.ranks.bytes[i]) for i in np.frombuffer(ids, "<u4").tolist()]
            yield ids, np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.ranks.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    encoder = Encoder(path)
    for batch in batches:
        texts = texts_of(batch.column("text"))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(list(encoder.encode(texts)), pa.binary())], ["doc_id", "ids"]
        )


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids: the ids of each text as one binary value; null texts have no ids, bytes that are
    not UTF-8 are encoded as replacement characters."""
    return id_and_bytes(docs).mapInArrow(partial(_encoded, path=path), "doc_id long, ids binary")


def _decoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    encoder = Encoder(path)
    for batch in batches:
        texts = [encoder.decode(ids or b"") for ids in batch.column("ids").to_pylist()]
        yield batch.append_column("bytes", pa.array(texts, pa.binary()))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, ids, bytes: what the ids stand for; null ids stand for nothing."""
    ship(encoded.sparkSession)
    return encoded.select("doc_id", "ids").mapInArrow(
        partial(_decoded, path=path), "doc_id long, ids binary, bytes binary"
    )


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: one row per row of `docs` (doc_id, text).

    Null and empty texts have no ids; rows that share an id, or have none, are rows of their own.
    """
    return decode(encode(docs, path), path).select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )
