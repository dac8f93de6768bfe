"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton.

Texts are folded first: letters of other scripts that look Latin, digits and signs that stand for
letters, and letters spaced by zero-width marks become what they are read as. The lexicon holds
beginnings of words and whole words; its weights are log-odds learned from a bounded sample of
labelled documents. Exception phrases, given or learned, cancel the matches inside them. The sum of
weights, normalised by the text's length, becomes a probability by a logistic curve.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearfold.llm.common import id_and_bytes, remainder, ship, texts_of

# What looks like a Latin letter, in pairs.
HOMOGLYPHS = (
    "аa вb сc еe ёe нh іi їi јj кk мm оo рp ѕs тt уy хx ԁd ԛq ѡw һh ӏl ɡg ıi "
    "αa βb εe ηn ιi κk νv οo ρp τt υu χx"
)
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s"}
INVISIBLE = "­​‌‍⁠﻿"
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "pond scum")
PREFIXES = (4, 5, 6, 7, 8, 10)


@dataclass(frozen=True)
class Settings:
    """Bounds of what is learned: labelled rows of each class (about so many, chosen by hash), and
    entries of the lexicon. Entries need `min_documents` toxic documents of the sample, and
    `min_precision` among all labelled rows, for which those of the sample stand."""

    sample_per_class: int = 6000
    lexicon_size: int = 5000
    min_documents: int = 4
    min_precision: float = 0.85
    exceptions: tuple[str, ...] = EXCEPTIONS


@dataclass
class Model:
    """Lexicon and exceptions are strings with a space for each boundary of words."""

    lexicon: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    coefficients: tuple[float, float, float] = (-3.0, 0.0, 0.0)


def _folding() -> dict[int, str | None]:
    table: dict[int, str | None] = {}
    for point in range(33, 127):
        char = chr(point)
        if not char.isalpha():
            table[point] = SUBSTITUTES.get(char, " ")
        table[point + 0xFEE0] = table.get(point, char.lower())
    for pair in HOMOGLYPHS.split():
        table[ord(pair[0])] = pair[1]
    table.update(dict.fromkeys(map(ord, "\t\n\x0b\x0c\r   　"), " "))
    table.update(dict.fromkeys(map(ord, INVISIBLE)))
    return table


_FOLD = _folding()


def fold(text: str) -> str:
    """Words with one space on either side of each; empty if there is none."""
    words = text.lower().translate(_FOLD).split()
    return f" {' '.join(words)} " if words else ""


def _features(folded: str) -> set[str]:
    words = set(folded.split())
    found = {f" {w} " for w in words}
    for w in words:
        found.update(f" {w[:k]}" for k in PREFIXES if len(w) > k)
    return found


def _texts(batch: pa.RecordBatch) -> Iterator[str]:
    for raw in batch.column("text").to_pylist():
        yield raw.decode("utf-8", "replace")


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = (Counter(), Counter())
    for batch in batches:
        for text, toxic in zip(_texts(batch), batch.column("toxic").to_pylist()):
            counts[toxic].update(_features(fold(text)))
    names = list(counts[0].keys() | counts[1].keys())
    for at in range(0, len(names), 50_000):
        some = names[at : at + 50_000]
        arrays = [pa.array(some), *(pa.array([counts[k][n] for n in some], pa.int64()) for k in (1, 0))]
        yield pa.RecordBatch.from_arrays(arrays, ["feature", "toxic", "clean"])


class Matcher:
    def __init__(self, model: Model):
        self.model = model
        self.automaton = ahocorasick.Automaton()
        for entry, weight in model.lexicon.items():
            self.automaton.add_word(entry, (len(entry), weight))
        for phrase in model.exceptions:
            self.automaton.add_word(phrase, (len(phrase), None))
        if len(self.automaton):
            self.automaton.make_automaton()

    def matches(self, folded: str) -> list[tuple[int, float]]:
        """Word beginning and weight of each match outside exceptions; the best of one word."""
        if not len(self.automaton):
            return []
        best: dict[int, float] = {}
        cancelled: list[tuple[int, int]] = []
        for end, (length, weight) in self.automaton.iter(folded):
            begin = end + 1 - length
            if weight is None:
                cancelled.append((begin, end))
            else:
                best[begin] = max(weight, best.get(begin, -math.inf))
        cancelled.sort()
        found, at, until = [], 0, -1
        for begin in sorted(best):
            while at < len(cancelled) and cancelled[at][0] <= begin:
                until = max(until, cancelled[at][1])
                at += 1
            if begin >= until:
                found.append((begin, best[begin]))
        return found

    def measure(self, text: str) -> tuple[float, int]:
        """Sum of weights, and number of words."""
        folded = fold(text)
        return sum(w for _, w in self.matches(folded)), max(0, folded.count(" ") - 1)

    def score(self, text: str) -> float:
        total, n_words = self.measure(text)
        bias, by_rate, by_total = self.model.coefficients
        z = bias + sum(c * x for c, x in zip((by_rate, by_total), inputs(total, n_words)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def inputs(total: float, n_words: int) -> tuple[float, float]:
    """The sum of weights by the root of the length, and by the length's magnitude."""
    return total / math.sqrt(n_words + 1), total / (1 + math.log1p(n_words))


def _contexts(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """Two-word phrases around matches, counted once per document."""
    matcher, counts = Matcher(model), (Counter(), Counter())
    for batch in batches:
        for text, toxic in zip(_texts(batch), batch.column("toxic").to_pylist()):
            folded = fold(text)
            phrases = set()
            for begin, _ in matcher.matches(folded):
                middle = folded.index(" ", begin + 1)
                after = folded.find(" ", middle + 1)
                if after > 0:
                    phrases.add(folded[begin : after + 1])
                if begin > 0:
                    phrases.add(folded[folded.rindex(" ", 0, begin) : middle + 1])
            counts[toxic].update(phrases)
    names = [n for n in counts[0]]
    arrays = [pa.array(names, pa.string()), *(pa.array([counts[k][n] for n in names], pa.int64()) for k in (1, 0))]
    yield pa.RecordBatch.from_arrays(arrays, ["feature", "toxic", "clean"])


def _measures(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    matcher = Matcher(model)
    for batch in batches:
        totals, words = zip(*map(matcher.measure, _texts(batch))) if len(batch) else ((), ())
        yield pa.RecordBatch.from_arrays(
            [batch.column("toxic"), pa.array(totals, pa.float64()), pa.array(words, pa.int64())],
            ["toxic", "total", "n_words"],
        )


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Coefficients of a lightly regularised logistic regression, by Newton's method."""
    beta = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], 1e-2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (weight * (y - p)) - ridge * beta
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(ridge + 1e-6)
        step = np.linalg.solve(hessian, gradient)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return beta


def labelled_sample(docs: DataFrame, labels: DataFrame, settings: Settings) -> tuple[DataFrame, dict[int, float]]:
    """(doc_id, text, toxic) of the sample, and how many labelled rows each of its rows stands for.

    Only rows whose crc32(doc_id) mod 5 is not 0. A document with several labels is toxic if one of
    them says so; null labels say nothing.
    """
    known = labels.where(F.col("toxic").isin(0, 1) & (remainder(F.col("doc_id"), 5) != 0))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    share = {k: min(1.0, settings.sample_per_class / n) for k, n in sizes.items()}
    place = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(2)), F.lit(1_000_000))
    below = F.when(F.col("toxic") == 1, share.get(1, 0.0)).otherwise(share.get(0, 0.0)) * 1_000_000
    chosen = known.where(place < below)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return rows, {k: 1 / s for k, s in share.items()}


def learn(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """The model; without toxic or without clean labelled documents, one that finds nothing toxic."""
    rows, stands_for = labelled_sample(docs, labels, settings)
    if len(stands_for) < 2:
        return Model(exceptions=[fold(p) for p in settings.exceptions])
    sample = id_and_bytes(rows, F.col("toxic"))
    sums = [F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")]
    counted = sample.mapInArrow(_count_features, "feature string, toxic long, clean long")
    counted = counted.groupBy("feature").agg(*sums)
    n_toxic, n_clean = F.col("toxic") * stands_for[1], F.col("clean") * stands_for[0]
    precise = n_toxic / (n_toxic + n_clean + 0.5) >= settings.min_precision
    entries = counted.where((F.col("toxic") >= settings.min_documents) & precise)
    best = entries.orderBy(F.desc("toxic"), F.length("feature"), "feature").limit(settings.lexicon_size).collect()
    model = Model(exceptions=[fold(p) for p in settings.exceptions])
    for r in best:
        entry = r["feature"]
        if not any(entry[:k] in model.lexicon for k in range(2, len(entry))):
            odds = (r["toxic"] * stands_for[1] + 0.5) / (r["clean"] * stands_for[0] + 0.5)
            model.lexicon[entry] = math.log(odds)
    phrases = sample.mapInArrow(partial(_contexts, model=model), "feature string, toxic long, clean long")
    phrases = phrases.groupBy("feature").agg(*sums)
    innocent = (F.col("clean") >= settings.min_documents) & (n_clean >= 9 * n_toxic)
    found = phrases.where(innocent).orderBy(F.desc("clean"), "feature").limit(settings.lexicon_size)
    model.exceptions += [r["feature"] for r in found.collect()]
    points = sample.mapInArrow(partial(_measures, model=model), "toxic int, total double, n_words long")
    points = points.groupBy("toxic", "total", "n_words").count().collect()
    x = np.array([[1.0, *inputs(p["total"], p["n_words"])] for p in points]).reshape(-1, 3)
    y = np.array([float(p["toxic"]) for p in points])
    weight = np.array([p["count"] * stands_for[p["toxic"]] for p in points])
    if len(points):
        model.coefficients = tuple(map(float, _logistic(x, y, weight / weight.mean())))
    return model


def _scored(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    matcher = Matcher(model)
    for batch in batches:
        scores = pa.array(map(matcher.score, _texts(batch)), pa.float64())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), scores], ["doc_id", "score"])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score: one row per row of `docs`; null texts are scored as empty ones, bytes that are
    not UTF-8 as replacement characters."""
    return id_and_bytes(docs).mapInArrow(partial(_scored, model=model), "doc_id long, score double")


def judge(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of `docs`, learned from the others' labels.

    Rows that share an id are scored each by its own text, and all learned from if the id is labelled;
    a null id has no label.
    """
    scored = score(docs, learn(docs, labels, settings))
    return scored.select(
        "doc_id",
        (remainder(F.col("doc_id"), 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def _kept(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    matcher = Matcher(model)
    for batch in batches:
        clean = [matcher.score(text) < 0.5 for text in texts_of(batch.column("text"))]
        yield batch.filter(pa.array(clean, pa.bool_()))


def reject(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of `docs` that score below 0.5, as they are, one by one: nulls are scored as empty
    texts, bytes that are not UTF-8 as replacement characters, and ids are not looked at."""
    ship(docs.sparkSession)
    return docs.mapInArrow(partial(_kept, model=model), docs.schema)
