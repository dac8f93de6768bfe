"""Substring deduplication, level by level: only what repeats at one length is looked at at the next.

The lower level has windows of about half the words. Of all that lie in one full window the least by
hash represents it (a minimizer), so that two texts with a full window in common have its
representative in common as well; about a quarter of all half windows ever move. Those that occur in
more than one text go, as bits, to every task: a field of at most 32 MB, in which a stray bit costs
work and never a result. The full windows over them are then grouped by hash. A window of every
document but the first that has it is removed; windows are judged on the texts as they came.

Two different windows share a hash with a probability of 2**-64.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearfold.llm.common import Words, id_and_bytes, word_blocks, written

WINDOW = 13
BLOCK_BITS = 32768
MAX_BLOCKS = 8192
BITS_PER_WINDOW = 12


def _half(window: int) -> int:
    return window // 2 + 1


def representatives(words: Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    """For each word: the least half window within the full window that begins there, and whether
    the text has so many words left."""
    half = _half(window)
    hashes, _ = words.windows(half)
    n = len(hashes)
    least = hashes.copy()
    for k in range(1, window - half + 1):
        np.minimum(least[: max(0, n - k)], hashes[k:], out=least[: max(0, n - k)])
    left = np.repeat(words.offsets[1:], np.diff(words.offsets)) - np.arange(n)
    return least, left >= window


def _text_numbers(words: Words) -> np.ndarray:
    return np.repeat(np.arange(len(words.offsets) - 1), np.diff(words.offsets))


def _distinct(values: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each value once per text."""
    order = np.lexsort((values, texts))
    values, texts = values[order], texts[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (texts[1:] != texts[:-1])
    return values[new], texts[new]


def _lower(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, words in word_blocks(batch, lower=False):
            least, valid = representatives(words, window)
            texts = _text_numbers(words)
            change = valid.copy()
            change[1:] &= (least[1:] != least[:-1]) | (texts[1:] != texts[:-1]) | ~valid[:-1]
            values, _ = _distinct(least[change], texts[change])
            yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64))], ["value"])


def repeated_field(values: DataFrame) -> np.ndarray:
    """Bits of the values that occur more than once: two in the block that the value's low bits name."""
    repeated = written(values.groupBy("value").count().where("count > 1").select("value"))
    blocks = 2 ** math.ceil(math.log2(max(1.0, repeated.count() * BITS_PER_WINDOW / BLOCK_BITS)))
    blocks = min(MAX_BLOCKS, blocks)
    bits = F.explode(F.array(*[F.shiftrightunsigned("value", k).bitwiseAND(F.lit(BLOCK_BITS - 1)) for k in (20, 40)]))
    marked = repeated.select(F.col("value").bitwiseAND(F.lit(blocks - 1)).alias("block"), bits.alias("bit"))
    field = np.zeros((blocks, BLOCK_BITS // 8), np.uint8)
    for row in marked.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits")).collect():
        field[row["block"]] = np.frombuffer(row["bits"], np.uint8)
    return field


def _in_field(values: np.ndarray, field: np.ndarray) -> np.ndarray:
    block = (values & np.uint64(len(field) - 1)).astype(np.int64)
    found = np.ones(len(values), bool)
    for shift in (20, 40):
        bit = (values >> np.uint64(shift) & np.uint64(BLOCK_BITS - 1)).astype(np.int64)
        found &= (field[block, bit >> 3] >> (bit & 7).astype(np.uint8) & 1).astype(bool)
    return found


def _upper(batches: Iterator[pa.RecordBatch], window: int, field) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        for row, end, words in word_blocks(batch, lower=False):
            least, valid = representatives(words, window)
            valid &= _in_field(least, field.value)
            hashes, _ = words.windows(window)
            values, texts = _distinct(hashes[valid], _text_numbers(words)[valid])
            arrays = [pa.array(values.view(np.int64)), pa.array(ids[row:end][texts].astype(np.int64))]
            yield pa.RecordBatch.from_arrays(arrays, ["value", "doc_id"])


def repeated_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, value): windows, by hash, that also start in a document with a smaller doc_id."""
    known = id_and_bytes(docs).where("doc_id IS NOT NULL")
    field = repeated_field(known.mapInArrow(partial(_lower, window=window), "value long"))
    shared = docs.sparkSession.sparkContext.broadcast(field)
    windows = known.mapInArrow(partial(_upper, window=window, field=shared), "value long, doc_id long")
    first = windows.groupBy("value").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    first = first.where("first < last").select("value", "first")
    return windows.join(first, "value").where("doc_id > first").select("doc_id", "value")


def _marked(hashes: np.ndarray, offsets: np.ndarray, k: int, window: int, found: np.ndarray) -> np.ndarray:
    """Which words of text k the found windows cover."""
    begin, end = offsets[k], offsets[k + 1]
    steps = np.zeros(end - begin + 1, np.int64)
    starts = np.flatnonzero(np.isin(hashes[begin : max(begin, end - window + 1)], found))
    steps[starts] += 1
    steps[starts + window] -= 1
    return np.cumsum(steps[:-1]) > 0


def _removed(batches: Iterator[pa.RecordBatch], window: int, one_space: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = batch.column("values")
        for row, end, words in word_blocks(batch, lower=False):
            hashes = words.windows(window)[0].view(np.int64)
            raw, counts, removed = [], [], []
            for k in range(end - row):
                begin, stop = words.offsets[k], words.offsets[k + 1]
                text = batch.column("text")[row + k].as_py()
                own = text.split() if one_space else None
                gone = 0
                if values[row + k].is_valid:
                    found = values[row + k].values.to_numpy()
                    covered = _marked(hashes, words.offsets, k, window, found)
                    gone = int(covered.sum())
                    if gone and one_space:
                        own = [w for w, c in zip(own, covered.tolist()) if not c]
                    elif gone:
                        text = _cut(words, begin, stop, covered)
                raw.append(b" ".join(own) if one_space else text)
                counts.append(int(stop - begin))
                removed.append(gone)
            arrays = [
                batch.column("doc_id").slice(row, end - row),
                pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(raw, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_words", "n_removed", "kept"])


def _cut(words: Words, begin: int, stop: int, covered: np.ndarray) -> bytes:
    """The uncovered words with the white space that followed each."""
    nexts = np.append(words.starts[begin + 1 : stop], words.ends[stop - 1])
    runs = [words.data[a:b] for a, b, c in zip(words.starts[begin:stop], nexts, covered) if not c]
    return b"".join(r.tobytes() for r in runs).rstrip()


def remove_repeats(docs: DataFrame, window: int = WINDOW, one_space: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept: one row per row of `docs` (doc_id, text).

    `kept` is UTF-8: the words that stay joined by one space, or, without `one_space`, the text as
    it was but for what is removed. Null texts have no words. Rows that share a doc_id are parts of
    one document; rows without one keep all their words.
    """
    found = repeated_windows(docs, window).groupBy("doc_id").agg(F.collect_set("value").alias("values"))
    joined = id_and_bytes(docs).join(found, "doc_id", "left")
    kind = "doc_id long, n_words long, n_removed long, kept binary"
    return joined.mapInArrow(partial(_removed, window=window, one_space=one_space), kind)


def digests(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    rows = remove_repeats(docs, window)
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def _rewritten(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        *columns, values = batch.columns
        place = batch.schema.get_field_index("text")
        same = columns[place].cast(pa.string())
        texts = pc.fill_null(same, "").cast(pa.binary())
        narrow = pa.RecordBatch.from_arrays([texts, texts, values], ["doc_id", "text", "values"])
        new = []
        for cut in _removed([narrow], window, False):
            pairs = zip(cut.column("n_removed").to_pylist(), cut.column("kept").to_pylist())
            new += [kept.decode("utf-8", "replace") if gone else None for gone, kept in pairs]
        columns[place] = pc.coalesce(pa.array(new, pa.string()), same)
        yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:-1])


def rewrite(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of `docs` with repeats cut out of `text`; everything else stays, white space too.

    Null texts stay null. Rows that share an id are one document; columns may have any names.
    """
    found = repeated_windows(docs, window).groupBy(F.col("doc_id").alias("repeated_in"))
    found = found.agg(F.collect_set("value").alias("repeated_values"))
    rows = docs.select(F.col("doc_id").alias("of"), F.struct("*").alias("row")).join(
        found, F.col("of") == F.col("repeated_in"), "left"
    )
    # The row's own columns and, last, the values: by place, as their names may be anything.
    taken = set(map(str.lower, docs.columns))
    last = next(n for n in (f"repeated{i}" for i in range(len(taken) + 1)) if n not in taken)
    rows = rows.select("row.*", F.col("repeated_values").alias(last))
    return rows.mapInArrow(partial(_rewritten, window=window), docs.schema)
