"""Phrase collocations by dynamic itemset counting.

The documents are dealt into shards that are scanned in turn, again and again. Words are counted
from the first scan on. After each scan, phrases whose two subphrases (all words but the last, all
but the first) have been seen often enough so far become active, and from the next scan on they are
counted next to the shorter ones, for one full cycle of the shards. Scanning ends when every active
phrase has had its cycle; since each scan covers one shard, that counts every occurrence once. A
phrase that is frequent has frequent subphrases, so none is missed.

Phrases are 64-bit hashes of their words and language until the end, when one more scan looks up the
words of those that are frequent. Counting tasks know active phrases from one array for each length,
of 2 ** FIELD_BITS bytes at any input size: at the place that a phrase's hash names, the scan from which it is
active. Phrases that share a place become active together; that lets more phrases be counted, each
still for exactly one cycle. Beyond some ten million frequent words nearly all phrases are
counted, which costs time and changes no result.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clearfold.llm.common import Words, list_of, mix, ship, written

SHARDS = 2
FIELD_BITS = 24
# Bytes of text whose counts are summed before they leave the task.
RUN = 2 << 20
NEVER = 255
UNKNOWN_LANGUAGE = "und"
LEAST, TOP, LONGEST = 10, 2000, 3
SUBSUMED_PERCENT = 50
# Characters that end a piece besides line breaks.
BREAKS = b".,;:!?"

_CLEAN = np.arange(256, dtype=np.uint8)
_CLEAN[65:91] += 32
_CLEAN[[*BREAKS, 10, 11, 12, 13]] = 10
# A bitmap's bits, as bitmap_construct_agg groups them.
_BITMAP = 32768


class Pieces:
    """Words of a run of texts, and the phrases within their pieces.

    `keys(n)`: hash of the n words from each word on, together with the text's language; `whole(n)`:
    whether these lie in one piece.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, languages: np.ndarray):
        self.data = _CLEAN[data]
        self.words = Words(self.data, offsets, lower=False)
        counts = np.diff(self.words.offsets)
        self.text = np.repeat(np.arange(len(counts)), counts)
        self.language = languages[self.text]
        breaks = np.cumsum(self.data == 10)[self.words.starts] if len(self.words.starts) else counts[:0]
        self._piece = breaks

    def keys(self, n: int) -> np.ndarray:
        return mix(self.words.windows(n)[0] + self.language)

    def whole(self, n: int) -> np.ndarray:
        fits, k = self.words.windows(n)[1], n - 1
        if k:
            same = np.zeros(len(fits), bool)
            same[:-k] = self._piece[:-k] == self._piece[k:]
            fits = fits & same
        return fits

    def phrase(self, i: int, n: int) -> bytes:
        raw = self.data[self.words.starts[i] : self.words.ends[i + n - 1]].tobytes()
        return b" ".join(raw.split())


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[Pieces, list[str]]]:
    """Runs of whole texts of about RUN bytes, with each text's language."""
    column = batch.column("text").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    languages = batch.column("lang").to_pylist()
    known = {x: xxhash.xxh64_intdigest(x) for x in set(languages)}
    salts = np.array([known[x] for x in languages], np.uint64)
    row = 0
    while row < len(column):
        end = min(len(column), max(row + 1, int(np.searchsorted(offsets, offsets[row] + RUN))))
        own = offsets[row : end + 1]
        yield Pieces(data[own[0] : own[-1]], own - own[0], salts[row:end]), languages[row:end]
        row = end


def _compressed(fields: dict[int, np.ndarray]) -> dict[int, bytes]:
    """Fields as they cross to the tasks; nearly all places hold one value until many are active."""
    return {size: zlib.compress(field.tobytes(), 1) for size, field in fields.items()}


def _restored(fields: dict[int, bytes], kind: type) -> dict[int, np.ndarray]:
    return {size: np.frombuffer(zlib.decompress(field), kind) for size, field in fields.items()}


def _looked_up(field: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """What the field, of a power of two of places, holds where the keys' first bits point."""
    return field[(keys >> np.uint64(65 - len(field).bit_length())).astype(np.int64)]


def cohort(size: int, since: int) -> int:
    """Phrases of a length that became active at a time; that of size 0 counts all words."""
    return 256 * size + since


def _counter(step: int, shards: int, longest: int, active: Broadcast) -> Callable:
    """Counts of one scan: words in the first cycle, and longer phrases in their own cycles."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = _restored(active.value, np.uint8)
        for batch in batches:
            for pieces, _ in _runs(batch):
                since = np.zeros(len(pieces.text), np.uint8)
                keys = pieces.keys(1)
                out = [(cohort(0, 0), *np.unique(pieces.language, return_counts=True))] if step < shards else []
                for size in range(1, longest + 1):
                    if size > 1:
                        # A phrase is active once both subphrases are.
                        sub = _looked_up(fields[size - 1], keys)
                        since = np.full(len(sub), NEVER, np.uint8)
                        since[:-1] = np.maximum(sub[:-1], sub[1:])
                        keys = pieces.keys(size)
                    whole = pieces.whole(size)
                    for at in range(max(0, step - shards + 1), step + 1):
                        chosen = keys[whole & (since == at)]
                        if len(chosen):
                            out.append((cohort(size, at), *np.unique(chosen, return_counts=True)))
                for kind, found, n in out:
                    arrays = [pa.array(np.full(len(n), kind, np.int32)), pa.array(found.view(np.int64)), pa.array(n)]
                    yield pa.RecordBatch.from_arrays(arrays, ["cohort", "key", "n"])

    return count


def _finder(longest: int, wanted: Broadcast) -> Callable:
    """Language and words of the phrases whose place is wanted, each once for a task."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = _restored(wanted.value, np.bool_)
        told = {size: np.zeros(0, np.uint64) for size in fields}
        for batch in batches:
            for pieces, languages in _runs(batch):
                for size in range(2, longest + 1):
                    keys = pieces.keys(size)
                    at = np.flatnonzero(pieces.whole(size) & _looked_up(fields[size], keys))
                    found, first = np.unique(keys[at], return_index=True)
                    new = ~np.isin(found, told[size], assume_unique=True)
                    told[size] = np.union1d(told[size], found[new])
                    at = at[first[new]]
                    arrays = [
                        pa.array(np.full(len(at), size, np.int32)), pa.array(keys[at].view(np.int64)),
                        pa.array([languages[t] for t in pieces.text[at].tolist()], pa.string()),
                        pa.array([pieces.phrase(i, size) for i in at.tolist()], pa.binary()),
                    ]
                    yield pa.RecordBatch.from_arrays(arrays, ["size", "key", "lang", "text"])

    return find


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Phrases with the hashes of their language and of what each cut leaves on both sides."""
    for batch in batches:
        row = 0
        for pieces, languages in _runs(batch):
            rows = batch.slice(row, len(languages))
            row += len(languages)
            sizes = rows.column("size").to_pylist()
            first, of_size = pieces.words.offsets[:-1].tolist(), {n: pieces.keys(n).view(np.int64) for n in range(1, max(sizes))}
            left = [[int(of_size[k][i]) for k in range(1, n)] for i, n in zip(first, sizes)]
            right = [[int(of_size[n - k][i + k]) for k in range(1, n)] for i, n in zip(first, sizes)]
            arrays = [
                *(rows.column(c) for c in ("size", "key", "a", "lang", "text")),
                pa.array(pieces.language[first].view(np.int64)), pa.array(left, pa.list_(pa.int64())), pa.array(right, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["size", "key", "a", "lang", "phrase", "language", "lefts", "rights"])


def _marked(rows: DataFrame) -> np.ndarray:
    """The places of the rows' keys, as a boolean array; as many bits cross to the driver at most."""
    place = F.shiftrightunsigned("key", 64 - FIELD_BITS)
    bits = rows.select((place / _BITMAP).cast("int").alias("block"), (place % _BITMAP).cast("int").alias("bit"))
    blocks = bits.groupBy("block").agg(F.bitmap_construct_agg(F.col("bit").cast("long")).alias("bits"))
    out = np.zeros(1 << FIELD_BITS, bool)
    for r in blocks.collect():
        own = np.unpackbits(np.frombuffer(r["bits"], np.uint8), bitorder="little")
        part = out[r["block"] * _BITMAP :][:_BITMAP]
        part[:] = own[: len(part)]
    return out


def _read(docs: DataFrame) -> DataFrame:
    """Language and whole text as UTF-8, for Python to read."""
    ship(docs.sparkSession)
    text = F.coalesce("text", F.lit("")).cast("binary").alias("text")
    return docs.select(F.coalesce("lang", F.lit(UNKNOWN_LANGUAGE)).alias("lang"), text)


def frequent(docs: DataFrame, least: int, longest: int, shards: int) -> DataFrame:
    """(size, key, n): all phrases of up to `longest` words that occur `least` times, exactly
    counted; and, as size 0, the number of words by language."""
    spark = docs.sparkSession
    shard = F.coalesce(F.pmod(F.xxhash64("doc_id"), F.lit(shards)), F.lit(0))
    fields = {size: np.full(1 << FIELD_BITS, NEVER, np.uint8) for size in range(1, longest)}
    running, done, step = None, [], 0
    # Cohorts whose cycle is not over, by the scan at which it began.
    open_cohorts = {cohort(0, 0): 0, cohort(1, 0): 0}
    while open_cohorts:
        active = spark.sparkContext.broadcast(_compressed(fields))
        own = _read(docs.where(shard == step % shards))
        counted = own.mapInArrow(_counter(step, shards, longest, active), "cohort int, key long, n long")
        if running is not None:
            counted = counted.unionByName(running)
        total = counted.groupBy("cohort", "key").agg(F.sum("n").alias("n"))
        over = [c for c, since in open_cohorts.items() if since + shards == step + 1]
        enough = (F.col("n") >= least) | (F.col("cohort") < cohort(1, 0))
        still = ~F.col("cohort").isin(over)
        total = written(total.where(enough | still))
        active.destroy()
        done.append(total.where(F.col("cohort").isin(over)))
        running = total.where(still)
        open_cohorts = {c: s for c, s in open_cohorts.items() if c not in over}
        for size in range(1, longest):
            often = total.where((F.col("n") >= least) & F.col("cohort").between(cohort(size, 0), cohort(size, 255)))
            new = _marked(often) & (fields[size] == NEVER)
            if new.any():
                fields[size][new] = step + 1
                open_cohorts[cohort(size + 1, step + 1)] = step + 1
        step += 1
    out = done[0]
    for rows in done[1:]:
        out = out.unionByName(rows)
    return written(out.select((F.col("cohort") / 256).cast("int").alias("size"), "key", "n"))


def _exact(count: str) -> Column:
    return F.col(count).cast("decimal(15,0)")


def _named(docs: DataFrame, counts: DataFrame, longest: int) -> DataFrame:
    """size, key, a, lang, phrase, language, lefts, rights of the frequent phrases.

    Most occur in the first quarter of the documents, where each task tells those it finds; the other
    documents are then asked for the missing ones alone.
    """
    missing = counts.where("size > 1").withColumnRenamed("n", "a")
    first = F.coalesce(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(4)) == 0, F.lit(True))
    told = None
    for part in (first, ~first):
        wanted = {size: _marked(missing.where(F.col("size") == size)) for size in range(2, longest + 1)}
        places = docs.sparkSession.sparkContext.broadcast(_compressed(wanted))
        found = _read(docs.where(part)).mapInArrow(_finder(longest, places), "size int, key long, lang string, text binary")
        # Who tells a phrase's words: any of the tasks that found it, all of them saying the same.
        once = found.groupBy("size", "key").agg(F.min(F.struct("lang", "text")).alias("told"))
        own = written(once.join(missing, ["size", "key"]).select("size", "key", "a", "told.*"))
        places.destroy()
        missing = written(missing.join(own, ["size", "key"], "left_anti"))
        told = own if told is None else told.unionByName(own)
    kind = "size int, key long, a long, lang string, phrase binary, language long, lefts array<long>, rights array<long>"
    return written(told.mapInArrow(_parts, kind))


def scored(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, shards: int = SHARDS) -> DataFrame:
    """lang, phrase, words, a, l, r, n, score of each candidate that no longer one stands for."""
    counts = frequent(docs, least, longest, shards)
    phrases = _named(docs, counts, longest)

    cut = F.posexplode(F.arrays_zip("lefts", "rights")).alias("at", "parts")
    cuts = phrases.select("size", "key", "a", cut).select(
        "size", "key", "a", (F.col("at") + 1).alias("k"), F.col("parts.lefts").alias("left"), F.col("parts.rights").alias("right")
    )
    left = counts.select(F.col("size").alias("k"), F.col("key").alias("left"), F.col("n").alias("l"))
    right = counts.select(F.col("size").alias("m"), F.col("key").alias("right"), F.col("n").alias("r"))
    cuts = cuts.withColumn("m", F.col("size") - F.col("k")).join(left, ["k", "left"]).join(right, ["m", "right"])
    cuts = cuts.withColumns({"a_": _exact("a"), "l_": _exact("l"), "r_": _exact("r")})
    score = F.expr("(a_ * a_ * 1000000BD) div (l_ * r_)")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r", "a")).alias("cut")
    rated = cuts.groupBy("size", "key").agg(lowest)

    # Every contiguous part of a longer phrase is a left part of a right part, lengths permitting.
    inside = _contained(phrases, longest)
    stands = inside.groupBy("size", "key").agg(F.max("longer").alias("longer"))
    subsumed = 100 * F.col("longer") >= SUBSUMED_PERCENT * F.col("a")
    kept = phrases.join(stands, ["size", "key"], "left").where(~F.coalesce(subsumed, F.lit(False)))
    n = counts.where("size = 0").select(F.col("key").alias("language"), "n")
    out = kept.join(rated, ["size", "key"]).join(n, "language")
    phrase, words = F.col("phrase").cast("string").alias("phrase"), F.col("size").alias("words")
    return out.select("lang", phrase, words, "cut.a", "cut.l", "cut.r", "n", "cut.score")


def _contained(phrases: DataFrame, longest: int) -> DataFrame:
    """(size, key, longer): candidates within longer ones, and how often the longer one occurs.

    Parts of all lengths follow from the next shorter ones, whose own parts are among the candidates.
    """
    steps = phrases.where("size > 2").select(
        (F.col("size") - 1).alias("size"),
        F.explode(F.array(F.element_at("lefts", -1), F.element_at("rights", 1))).alias("key"),
        F.col("a").alias("longer"),
    )
    out = steps
    parts = phrases.where("size > 2").select(
        "size", "key", F.array(F.element_at("lefts", -1), F.element_at("rights", 1)).alias("parts")
    )
    for _ in range(longest - 3):
        steps = steps.join(parts, ["size", "key"]).select(
            (F.col("size") - 1).alias("size"), F.explode("parts").alias("key"), "longer"
        )
        out = out.unionByName(steps)
    return out


def collocations(
    docs: DataFrame, top: int = TOP, least: int = LEAST, longest: int = LONGEST, shards: int = SHARDS
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's `top` phrases of `docs` (doc_id, text, lang).

    Null texts are empty, a null language is `und`; rows count as often as they occur, whatever
    their doc_id. Texts without a frequent phrase, and an empty table, give no row. Ties of score
    and count go to the lesser phrase in byte order.
    """
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored(docs, least, longest, shards).withColumn("rank", F.row_number().over(order).cast("long"))
    return ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
