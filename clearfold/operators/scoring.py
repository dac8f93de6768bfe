"""Cosines of one slice of questions against blocks of chunk vectors, and which pairs need them.

A block's terms have a greatest weight (tf / norm) each. Summed over a question's terms they bound
its scores in the block, so questions whose bound stays below their threshold skip the block. For the
others the block's frequent terms are added up first, exactly. What the remaining terms can still add
is at most the product of both sides' remaining norms (Cauchy-Schwarz), and only pairs that can reach
the threshold with it are finished. A threshold is a least score, or the k-th best score that the
question is sure to have; the exact scores of a task's first blocks set it for the later ones.

Dot products are sums of whole numbers below 2 ** 53, so a finished score is the same double that
`vectors.cosine` gives.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1024
# Questions whose pairs with a block are held at once.
ASKED = 128
# A block's terms in one of so many chunks are frequent, the commonest of them up to a limit.
FREQUENT_IN, MOST_FREQUENT = 16, 512
# Rounding of the bounds, always to the side of finishing a pair.
SLACK = 1e-9


class Questions:
    """A slice of question vectors, as sorted postings by term."""

    def __init__(self, rows: list):
        self.ids = [r["question_id"] for r in rows]
        self.norms = np.array([r["q_norm"] for r in rows], np.float64)
        terms = [t for r in rows for t in r["q_terms"]]
        places = {t: i for i, t in enumerate(dict.fromkeys(terms))}
        self.terms = list(places)
        question = np.repeat(np.arange(len(rows)), [len(r["q_terms"]) for r in rows])
        term = np.array([places[t] for t in terms], np.int64)
        tf = np.array([n for r in rows for n in r["q_counts"]], np.float64)
        order = np.argsort(term, kind="stable")
        self.question, self.term, self.tf = question[order], term[order], tf[order]
        self.starts = np.searchsorted(self.term, np.arange(len(self.terms) + 1))


class Block:
    """Postings of up to BLOCK chunks, of a slice's terms only."""

    def __init__(self, orders: np.ndarray, norms: np.ndarray, chunk: np.ndarray, term: np.ndarray, tf: np.ndarray):
        self.orders, self.norms = orders, norms
        order = np.argsort(term, kind="stable")
        self.chunk, self.term, self.tf = chunk[order], term[order], tf[order].astype(np.float64)


def _ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each of the lengths, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def scores(questions: Questions, block: Block, least: np.ndarray, k: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(question, chunk, score) of all pairs that share a term and, as far as bounds tell, can reach
    the question's least score or, with k, be among its k best here."""
    n_terms, n = len(questions.terms), len(block.orders)
    weight = np.zeros(n_terms)
    if len(block.term):
        np.maximum.at(weight, block.term, block.tf / block.norms[block.chunk])
    reach = np.bincount(questions.question, questions.tf * weight[questions.term], len(questions.ids))
    scale = np.where(questions.norms > 0, questions.norms, 1)
    asking = np.flatnonzero((reach > 0) & (reach / scale + SLACK >= least))
    if not len(asking):
        return asking, asking, np.zeros(0)
    holders = np.bincount(block.term, minlength=n_terms)
    frequent = np.flatnonzero(holders * FREQUENT_IN >= n)
    frequent = frequent[np.argsort(-holders[frequent], kind="stable")[:MOST_FREQUENT]]
    column = np.full(n_terms, -1)
    column[frequent] = np.arange(len(frequent))
    c_dense, in_c = np.zeros((len(frequent), n)), column[block.term] >= 0
    c_dense[column[block.term[in_c]], block.chunk[in_c]] = block.tf[in_c]
    c_rest = np.sqrt(np.bincount(block.chunk[~in_c], block.tf[~in_c] ** 2, n))

    def finished(asking: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        row = np.full(len(questions.ids), -1)
        row[asking] = np.arange(len(asking))
        own = row[questions.question] >= 0
        q_row, q_term, q_tf = row[questions.question[own]], questions.term[own], questions.tf[own]
        q_dense, in_q = np.zeros((len(asking), len(frequent))), column[q_term] >= 0
        q_dense[q_row[in_q], column[q_term[in_q]]] = q_tf[in_q]
        dots = q_dense @ c_dense
        both = scale[asking][:, None] * block.norms[None, :]

        held = ~in_q & (holders[q_term] > 0)
        q_rest = np.sqrt(np.bincount(q_row[held], q_tf[held] ** 2, len(asking)))
        # What a pair has already is a score that its question is sure to reach.
        sure = dots / both
        floor = least[asking]
        if k is not None and n >= k:
            floor = np.maximum(floor, np.partition(sure, n - k, axis=1)[:, n - k])
        alive = sure + q_rest[:, None] * c_rest[None, :] / both + SLACK >= floor[:, None]

        first, last = np.searchsorted(block.term, q_term[held]), np.searchsorted(block.term, q_term[held], "right")
        posting = _ragged(first, last - first)
        pair_row, pair_chunk = np.repeat(q_row[held], last - first), block.chunk[posting]
        wanted = alive[pair_row, pair_chunk]
        pair, more = pair_row * n + pair_chunk, np.repeat(q_tf[held], last - first) * block.tf[posting]
        dots += np.bincount(pair[wanted], more[wanted], dots.size).reshape(dots.shape)
        i, j = np.nonzero(alive & (dots > 0))
        return asking[i], j, dots[i, j] / both[i, j]

    parts = [finished(asking[at : at + ASKED]) for at in range(0, len(asking), ASKED)]
    return tuple(np.concatenate(x) for x in zip(*parts))


def blocks(batch: pa.RecordBatch, terms: pa.Array) -> Iterator[tuple[str, Block]]:
    """A batch of chunk vectors (store_id, chunk_order, norm, terms, counts) in blocks by store."""
    for at in range(0, len(batch), BLOCK):
        rows = batch.slice(at, BLOCK)
        for store in pc.unique(rows.column("store_id")).to_pylist():
            part = rows.filter(pc.equal(rows.column("store_id"), store))
            lists = part.column("terms")
            lengths = pc.list_value_length(lists).to_numpy()
            term = pc.index_in(lists.flatten(), terms).fill_null(-1).to_numpy()
            chunk, tf = np.repeat(np.arange(len(part)), lengths), part.column("counts").flatten().to_numpy()
            known = term >= 0
            orders, norms = part.column("chunk_order").to_numpy(), part.column("norm").to_numpy()
            yield store, Block(orders, np.where(norms > 0, norms, 1), chunk[known], term[known].astype(np.int64), tf[known])


def _result(questions: Questions, store: str, q: np.ndarray, order: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
    ids = pa.array(questions.ids).take(pa.array(q))
    arrays = [pa.array([store] * len(q), pa.string()), ids, pa.array(order.astype(np.int64)), pa.array(score)]
    return pa.RecordBatch.from_arrays(arrays, ["store_id", "question_id", "chunk_order", "score"])


def _first(q: np.ndarray, order: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of each question's k best, higher scores and then earlier chunks first."""
    by = np.lexsort((order, -score, q))
    rank = np.arange(len(by)) - np.searchsorted(q[by], q[by])
    return by[rank < k]


def best(questions: Questions, k: int) -> Callable:
    """For a task: its k best pairs per store and question, of chunk vectors."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = pa.array(questions.terms, pa.string())
        found: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        least: dict[str, np.ndarray] = {}
        for batch in batches:
            for store, block in blocks(batch, terms):
                floor = least.setdefault(store, np.zeros(len(questions.ids)))
                q, chunk, score = scores(questions, block, floor, k)
                new = (q, block.orders[chunk], score)
                if store in found:
                    new = tuple(np.concatenate(x) for x in zip(found[store], new))
                places = _first(*new, k)
                found[store] = tuple(x[places] for x in new)
                q, _, score = found[store]
                full = np.bincount(q, minlength=len(floor)) == k
                lowest = np.full(len(floor), np.inf)
                np.minimum.at(lowest, q, score)
                floor[full] = lowest[full]
        for store, of in found.items():
            yield _result(questions, store, *of)

    return find


def reaching(questions: Questions, min_score: float) -> Callable:
    """For a task: all pairs that share a term and have a cosine of at least min_score."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, floor = pa.array(questions.terms, pa.string()), np.full(len(questions.ids), min_score)
        for batch in batches:
            for store, block in blocks(batch, terms):
                q, chunk, score = scores(questions, block, floor, None)
                near = score >= min_score
                yield _result(questions, store, q[near], block.orders[chunk[near]], score[near])

    return find
