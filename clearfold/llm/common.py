"""Shared pieces: the folder for intermediate tables, splits of documents, word hashes of texts.

A word is a run of anything but the six white characters of ASCII; `bytes.split` and `bytes.lower`
use the same set and touch A-Z alone.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
WHITE = "\t\n\x0b\x0c\r "
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"


def scratch(spark: SparkSession) -> str:
    """A new path in the folder that spark.checkpoint.dir names.

    Where none is named, local mode gets a temporary folder; a cluster, whose machines could not
    all see that, gets an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        folder = tempfile.mkdtemp(prefix="checkpoint-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder}/{uuid.uuid4()}"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors' Python this package, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    path = Path(tempfile.mkdtemp(prefix="package-"), f"{package.name}.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    context.addPyFile(str(path))
    _shipped.add(context.applicationId)


def written(rows: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder: computed once, and safe from lost executors."""
    path = scratch(rows.sparkSession)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; 0 for a null id."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def id_and_bytes(docs: DataFrame, *more: Column) -> DataFrame:
    """(doc_id, text as UTF-8, empty for null) and further columns, for Python to read."""
    ship(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")
    return docs.select(F.col("doc_id").cast("long"), text, *more)


def texts_of(column: pa.Array) -> list[str]:
    """Texts of a column of texts or bytes; empty for null, bytes that are not UTF-8 replaced."""
    return [(raw or b"").decode("utf-8", "replace") for raw in column.cast(pa.binary()).to_pylist()]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit integers (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeds(n: int, of: int) -> np.ndarray:
    """n fixed 64-bit constants, another series for each `of`."""
    start = np.uint64((of * 0x9E3779B97F4A7C15) % 2**64)
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + start)


_BYTE = seeds(256, 1) | np.uint64(1)
_STEP = np.uint64(seeds(1, 2)[0] | np.uint64(5))
_IS_WHITE = np.zeros(256, bool)
_IS_WHITE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_AT_ONCE = 1 << 20


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _STEP)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_POWERS = _powers(64)


class Words:
    """Words of some texts: 64-bit hashes, first and end byte, and where each text's words begin.

    Two different words share a hash with a probability of about 2**-64.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool):
        if lower:
            data = _LOWER[data]
        self.data, n = data, len(data)
        white = _IS_WHITE[data]
        first = np.zeros(n + 1, bool)
        first[offsets] = True
        before = np.empty(n, bool)
        before[:1] = True
        before[1:] = white[:-1]
        starts = np.flatnonzero(~white & (before | first[:n]))
        after = np.empty(n, bool)
        after[-1:] = True
        after[:-1] = white[1:]
        ends = np.flatnonzero(~white & (after | first[1:])) + 1
        self.starts, self.ends = starts, ends
        self.offsets = np.searchsorted(starts, offsets)
        lengths = ends - starts
        if not len(starts):
            self.hashes = np.zeros(0, np.uint64)
            return
        place = np.zeros(n, np.int64)
        place[starts[0] :] = np.arange(starts[0], n) - np.repeat(starts, np.diff(np.append(starts, n)))
        longest = int(lengths.max())
        powers = _POWERS if longest <= len(_POWERS) else _powers(longest)
        worth = _BYTE[data] * powers[np.minimum(place, len(powers) - 1)]
        worth[white] = 0
        self.hashes = mix(np.add.reduceat(worth, starts) + lengths.astype(np.uint64))

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the `size` words from each word on, and whether the text has that many left."""
        hashes, n = self.hashes, len(self.hashes)
        out = np.zeros(n, np.uint64)
        for k, factor in enumerate(seeds(size, 3) | np.uint64(1)):
            out[: max(0, n - k)] += hashes[k:] * factor
        left = np.repeat(self.offsets[1:], np.diff(self.offsets)) - np.arange(n)
        return mix(out + np.uint64(size)), left >= size


def word_blocks(batch: pa.RecordBatch, lower: bool) -> Iterator[tuple[int, int, Words]]:
    """Words of the column `text`, for runs of rows of about a megabyte; a text is never cut."""
    column = batch.column("text").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + _AT_ONCE)))
        end = min(end, len(column))
        own = offsets[row : end + 1]
        yield row, end, Words(data[own[0] : own[-1]], own - own[0], lower)
        row = end


def list_of(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(values, kind)
    )
