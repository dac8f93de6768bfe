"""Language-model scores by a weighted backoff automaton.

A token is a lower-cased word or a text's end. The automaton's states are the n-grams, up to one less
than the order, that training has seen. An arc that training has seen bears the smoothed
probability of its token; from any other the failure arc leads to the state without the oldest token
and bears what smoothing leaves for it: with count c of a state and strength s,
p(token | state) = (count + s * p(token | shorter)) / (c + s), and below all states the add-one
estimate. Probabilities of a state add up to one.

The automaton grows with the corpus and is on no machine as a whole. Documents are dealt into blocks
of about four megabytes. A block sends its distinct n-grams, as sorted hashes, to the parts of the
hash range; a part adds the training counts of all blocks and answers each block for what it sent.
A block then holds the part of the automaton that its texts can reach, and they are traversed from
left to right, each step taking the token's arc or, as often as there is none, failing first.

Two different n-grams share a hash with a probability of 2**-64.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearfold.llm.common import Words, id_and_bytes, mix, remainder, seeds, written

ORDER = 2
# Chosen on a training fold.
STRENGTH = 500.0
BLOCK_BYTES = 1 << 22
BLOCKS_PER_PART = 4
HELD_OUT = (7, 2)

_END = seeds(1, 21)[0]
_GRAM = seeds(16, 22) | np.uint64(1)


def _blocks(docs: DataFrame) -> int:
    size = docs.agg(F.sum(F.octet_length("text")).alias("size")).first()["size"]
    return max(1, math.ceil((size or 0) / BLOCK_BYTES))


def _dealt(docs: DataFrame, blocks: int) -> DataFrame:
    """(block, doc_id, text, held_out); rows without an id are dealt by their texts."""
    key = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id"))
    n, rest = HELD_OUT
    held_out = (remainder(F.col("doc_id"), n) == rest).alias("held_out")
    return id_and_bytes(docs, held_out, F.pmod(key, F.lit(blocks)).cast("int").alias("block"))


class Grams:
    """Tokens of some texts, one after the other, and the hashes of the n-grams that end at each."""

    def __init__(self, table: pa.Table, order: int):
        column = table.column("text").combine_chunks().cast(pa.large_binary())
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        words = Words(data, offsets - offsets[0], lower=True)
        tokens = np.insert(words.hashes, words.offsets[1:], _END)
        self.firsts = words.offsets[:-1] + np.arange(len(column))
        self.sizes = np.diff(words.offsets) + 1
        self.place = np.arange(len(tokens)) - np.repeat(self.firsts, self.sizes)
        held_out = table.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
        self.trains = np.repeat(~held_out, self.sizes)
        self._which: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.orders = []
        total = np.zeros(len(tokens), np.uint64)
        for k in range(order):
            total[k:] += tokens[: len(tokens) - k] * _GRAM[k]
            self.orders.append(mix(total + np.uint64(k)))

    def distinct(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the n-grams of k + 1 tokens, ascending, and the number of each in training texts."""
        whole = self.place >= k
        keys, inverse = np.unique(self.orders[k][whole], return_inverse=True)
        return keys, np.bincount(inverse[self.trains[whole]], minlength=len(keys))

    def which(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """For each token, which of the n-grams of k + 1 tokens ends there, in order of hashes, -1 where
        the text has no k tokens before it; and a token at which each n-gram ends."""
        if k not in self._which:
            whole = np.flatnonzero(self.place >= k)
            _, first, inverse = np.unique(self.orders[k][whole], return_index=True, return_inverse=True)
            which = np.full(len(self.place), -1)
            which[whole] = inverse
            self._which[k] = which, whole[first]
        return self._which[k]


def _count(table: pa.Table, order: int, bits: int) -> pa.Table:
    grams = Grams(table, order)
    block = table.column("block")[0].as_py()
    rows = []
    for k in range(order):
        keys, counts = grams.distinct(k)
        part = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
        begins = np.flatnonzero(np.diff(part, prepend=-1))
        for a, b in zip(begins.tolist(), [*begins[1:].tolist(), len(keys)]):
            rows.append((block, k, int(part[a]), _packed_keys(keys[a:b]), _packed_counts(counts[a:b])))
    columns = list(zip(*rows))
    return pa.table(columns, schema=_SENT)


def _packed_keys(keys: np.ndarray) -> bytes:
    """Ascending keys as the bytes of their differences, the highest bytes of all first: most of
    these are zero and compress away."""
    return np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8)[:, ::-1].T.tobytes()


def _unpacked_keys(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(8, -1)[::-1].T
    return np.cumsum(np.ascontiguousarray(planes).view(np.uint64).reshape(-1), dtype=np.uint64)


def _packed_counts(counts: np.ndarray) -> bytes:
    """Counts in the narrowest unsigned integers that hold them; their size in bytes comes first."""
    width = next(w for w in (1, 2, 4, 8) if int(counts.max(initial=0)) < 1 << 8 * w)
    return bytes([width]) + counts.astype(f"<u{width}").tobytes()


def _unpacked_counts(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"<u{raw[0]}", offset=1).astype(np.int64)


_SENT = pa.schema([("block", pa.int32()), ("gram", pa.int32()), ("part", pa.int32()),
                   ("keys", pa.binary()), ("counts", pa.binary())])
_ANSWER = pa.schema([("block", pa.int32()), ("gram", pa.int32()), ("part", pa.int32()), ("totals", pa.binary()),
                     ("tokens", pa.int64()), ("distinct", pa.int64())])
_ANSWER_DDL = "block int, gram int, part int, totals binary, tokens long, distinct long"


def _add(table: pa.Table) -> pa.Table:
    """Answers to all blocks about a part; the first row also has the part's sums."""
    keys = [_unpacked_keys(k) for k in table.column("keys").to_pylist()]
    counts = np.concatenate([_unpacked_counts(c) for c in table.column("counts").to_pylist()])
    distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    totals = np.zeros(len(distinct), np.int64)
    np.add.at(totals, inverse, counts)
    cuts = np.cumsum([0, *map(len, keys)])
    answers = [_packed_counts(totals[inverse[a:b]]) for a, b in zip(cuts, cuts[1:])]
    own, none = (int(totals.sum()), int((totals > 0).sum())), [0] * (len(keys) - 1)
    columns = [table.column(c) for c in ("block", "gram", "part")]
    return pa.table([*columns, answers, [own[0], *none], [own[1], *none]], schema=_ANSWER)


class Automaton:
    """The part of the automaton that the texts of a block can reach.

    State 0 is the empty one; every other is an n-gram, shorter than the order, that training has seen.
    `arcs` leads from state * tokens + token to the arc's number, `target` and `worth` from there to the
    next state and the log10 probability; `shorter` and `loss` are the failure arcs' states and log10
    weights, and `unseen` is what a token without any arc is worth in state 0.
    """

    def __init__(self, grams: Grams, totals: list[np.ndarray], order: int, strength: float, tokens: int, distinct: int):
        self.n_tokens = len(totals[0])
        shorter, loss, states = [np.zeros(1, np.int64)], [np.zeros(1)], 1
        keys, target, worth = [], [], []
        which = state = counts = probability = None
        token_of = grams.which(0)[0]
        for k in range(order):
            own_which, first = grams.which(k)
            own = totals[k]
            seen = own > 0
            if k == 0:
                leads, follows = np.zeros(len(own), np.int64), np.zeros(len(own), np.int64)
                own_probability = (own + 1) / (tokens + distinct + 1)
            else:
                context, suffix = which[first - 1], which[first]
                leads, follows = state[context], state[suffix]
                own_probability = (own + strength * probability[suffix]) / (counts[context] + strength)
            own_state = np.zeros(len(own), np.int64)
            if k < order - 1:
                own_state[seen] = np.arange(states, states + int(seen.sum()))
                states += int(seen.sum())
                shorter.append(follows[seen])
                loss.append(np.log10(strength / (own[seen] + strength)))
            keys.append((leads * self.n_tokens + token_of[first])[seen])
            target.append((own_state if k < order - 1 else follows)[seen])
            worth.append(np.log10(own_probability[seen]))
            which, state, counts, probability = own_which, own_state, own, own_probability
        self.shorter, self.loss = np.concatenate(shorter).tolist(), np.concatenate(loss).tolist()
        self.arcs = {key: arc for arc, key in enumerate(np.concatenate(keys).tolist())}
        self.target, self.worth = np.concatenate(target).tolist(), np.concatenate(worth).tolist()
        self.unseen = -math.log10(tokens + distinct + 1)

    def score(self, tokens: list[int]) -> float:
        """log10 probability of a text: one pass over its tokens, the state carried along."""
        arcs, target, worth, n = self.arcs, self.target, self.worth, self.n_tokens
        shorter, loss = self.shorter, self.loss
        state, steps = 0, []
        for token in tokens:
            arc = arcs.get(state * n + token)
            while arc is None and state:
                steps.append(loss[state])
                state = shorter[state]
                arc = arcs.get(state * n + token)
            if arc is None:
                steps.append(self.unseen)
            else:
                steps.append(worth[arc])
                state = target[arc]
        return math.fsum(steps)


def _traverse(docs: pa.Table, answers: pa.Table, order: int, strength: float, tokens: int, distinct: int) -> pa.Table:
    grams = Grams(docs, order)
    replies: dict[int, list[tuple[int, bytes]]] = {k: [] for k in range(order)}
    for r in answers.select(["gram", "part", "totals"]).to_pylist():
        replies[r["gram"]].append((r["part"], r["totals"]))
    totals = [
        np.concatenate([np.zeros(0, np.int64), *(_unpacked_counts(t) for _, t in sorted(replies[k]))]) for k in range(order)
    ]
    automaton = Automaton(grams, totals, order, strength, tokens, distinct)
    which, _ = grams.which(0)
    seen = totals[0][which]
    base = np.add.reduceat(np.log10((seen + 1) / (tokens + distinct + 1)), grams.firsts)
    known = np.add.reduceat((seen > 0).astype(np.int64), grams.firsts)
    sums = [automaton.score(which[a : a + n].tolist()) for a, n in zip(grams.firsts.tolist(), grams.sizes.tolist())]
    n = len(docs)
    return pa.table(
        [docs.column("doc_id"), docs.column("held_out"), grams.sizes, known, np.full(n, tokens), base, np.array(sums)],
        names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    )


_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def scores(docs: DataFrame, order: int = ORDER, strength: float = STRENGTH) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: a row per row of `docs`
    (doc_id, text).

    Learned from rows whose crc32(doc_id) mod 7 is not 2. Null texts are empty: their one token is
    the end. Without training texts every token has probability one.
    """
    blocks = _blocks(docs)
    bits = max(0, math.ceil(math.log2(blocks / BLOCKS_PER_PART)))
    dealt = _dealt(docs, blocks)
    sent = dealt.groupBy("block").applyInArrow(
        lambda rows: _count(rows, order, bits), "block int, gram int, part int, keys binary, counts binary"
    )
    answers = written(sent.groupBy("gram", "part").applyInArrow(lambda rows: _add(rows), _ANSWER_DDL))
    sums = answers.where("gram = 0").agg(F.sum("tokens"), F.sum("distinct")).first()
    tokens, distinct = (int(s or 0) for s in sums)
    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        lambda texts, replies: _traverse(texts, replies, order, strength, tokens, distinct), _SCORES
    )


def rounded(score: Column) -> Column:
    """To a millionth: below that the order of adding shows."""
    return F.round(score, 6)
