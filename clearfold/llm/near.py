"""Near-duplicate documents by b-bit MinHash.

A document is the set of its shingles of five words. 128 minima of hashed shingles give 32 bands of
four, whose keys find candidates, and 128 times four low bits, packed into eight integers, which
estimate a candidate's similarity: equal nibbles are counted by bit counts and corrected for those
that agree by chance. What the estimate does not rule out is confirmed on the full sets.

Documents with equal sets are one node from the start. A bucket of a band first links its members
to its least one. Buckets that still hold several components are then worked through in blocks of
bounded size: two members are compared in the first band that they share, most similar first, and
only while nothing else has linked them, so that a group of copies never becomes all its pairs.

A pair at the threshold shares no band with a probability of 5e-6 (less above it), and is ruled out
by its estimate, six standard deviations off, with one of 1e-9.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearfold.llm.common import Words, id_and_bytes, list_of, mix, seeds, word_blocks, written
from clearfold.llm.graph import components

SHINGLE = 5
MINIMA, BANDS, BITS = 128, 32, 4
PACKED = MINIMA * BITS // 64
EVERY_NIBBLE = 0x1111111111111111
PERCENT = 75
LEAST_ESTIMATE = 0.5
# Buckets of up to SMALL members are compared by a join; larger ones in blocks of so many members
# or shingles, whichever is reached first.
SMALL = 32
BLOCK_MEMBERS, BLOCK_SHINGLES = 1024, 1 << 20

_FLIP = seeds(MINIMA, 11)
_TIMES = seeds(MINIMA, 12) | np.uint64(1)
_WITHIN = seeds(MINIMA // BANDS, 13) | np.uint64(1)
_BAND = seeds(BANDS, 14)
_PLACE = seeds(SHINGLE, 15) | np.uint64(1)


def shingle_sets(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, one text after the other; and their numbers.

    A text of one to four words has one shingle, the sequence of all; one without words has none.
    """
    hashes, whole = words.windows(SHINGLE)
    sets, sizes = [], []
    for begin, end in zip(words.offsets[:-1].tolist(), words.offsets[1:].tolist()):
        n = end - begin
        if n >= SHINGLE:
            own = np.unique(hashes[begin : end - SHINGLE + 1])
        elif n:
            own = mix((words.hashes[begin:end] * _PLACE[:n]).sum(keepdims=True) + np.uint64(n))
        else:
            own = hashes[:0]
        sets.append(own)
        sizes.append(len(own))
    return np.concatenate(sets) if sets else hashes[:0], np.array(sizes, np.int64)


def signatures(hashes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Band keys and packed low bits of non-empty sets, a row for each."""
    firsts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    minima = np.empty((len(sizes), MINIMA), np.uint64)
    for k in range(MINIMA):
        minima[:, k] = np.minimum.reduceat((hashes ^ _FLIP[k]) * _TIMES[k], firsts)
    grouped = minima.reshape(len(sizes), BANDS, MINIMA // BANDS)
    keys = mix((grouped * _WITHIN).sum(axis=2) ^ _BAND)
    low = (minima >> np.uint64(7)) & np.uint64(2**BITS - 1)
    shifts = np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS)
    packed = (low.reshape(len(sizes), PACKED, 64 // BITS) << shifts).sum(axis=2)
    return keys, packed


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, end, words in word_blocks(batch, lower=True):
            hashes, sizes = shingle_sets(words)
            n = end - row
            some = sizes > 0
            keys, packed = np.zeros((n, BANDS), np.uint64), np.zeros((n, PACKED), np.uint64)
            sums = np.zeros((2, n), np.uint64)
            if some.any():
                keys[some], packed[some] = signatures(hashes, sizes[some])
                firsts = np.concatenate([[0], np.cumsum(sizes[some])[:-1]])
                sums[0, some] = np.add.reduceat(mix(hashes ^ _FLIP[0]), firsts)
                sums[1, some] = np.add.reduceat(mix(hashes ^ _FLIP[1]), firsts)
            keys, packed, sums = keys.view(np.int64), packed.view(np.int64), sums.view(np.int64)
            arrays = [
                batch.column("doc_id").slice(row, n), pa.array(sizes), pa.array(sums[0]), pa.array(sums[1]),
                list_of(keys.reshape(-1), np.full(n, BANDS), pa.int64()),
                list_of(packed.reshape(-1), np.full(n, PACKED), pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_shingles", "sum_a", "sum_b", "bands", "packed"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, end, words in word_blocks(batch, lower=True):
            hashes, sizes = shingle_sets(words)
            raw, cuts = hashes.tobytes(), np.concatenate([[0], np.cumsum(sizes)]) * 8
            sets = [raw[a:b] for a, b in zip(cuts.tolist(), cuts[1:].tolist())]
            arrays = [batch.column("doc_id").slice(row, end - row), pa.array(sets, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "shingles"])


def linked(a: bytes, b: bytes) -> bool:
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    both = np.concatenate([x, y])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= PERCENT * (len(both) - common)


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(batch.column("shingles_a").to_pylist(), batch.column("shingles_b").to_pylist())
        keep = pa.array([linked(a, b) for a, b in pairs], pa.bool_())
        yield batch.select(["a", "b"]).filter(keep)


def estimate(packed_a: Column, packed_b: Column) -> Column:
    """Similarity from equal nibbles, less those that are equal by chance."""
    differing = F.lit(0)
    for k in range(PACKED):
        x = packed_a[k].bitwiseXOR(packed_b[k])
        folded = x
        for shift in range(1, BITS):
            folded = folded.bitwiseOR(F.shiftrightunsigned(x, shift))
        differing = differing + F.bit_count(folded.bitwiseAND(F.lit(EVERY_NIBBLE)))
    equal = 1 - differing / MINIMA
    return (equal - 2.0**-BITS) / (1 - 2.0**-BITS)


def _links_in_block(group: pd.DataFrame) -> pd.DataFrame:
    """Confirmed links between components within a bucket's block, no more than connect them."""
    group = group.reset_index(drop=True)
    labels = group["label"].tolist()
    packed = np.array(group["packed"].tolist()).view(np.uint64)
    bands = np.array(group["bands"].tolist())
    sizes, sides = group["n_shingles"].to_numpy(), group["side"].to_numpy()
    column = int(group["band"].iloc[0])
    roots: dict[int, int] = {}

    def root(x: int) -> int:
        while x in roots:
            x = roots[x]
        return x

    cross = (sides == 2).any()
    candidates = []
    for i in range(len(group)):
        js = np.arange(i + 1, len(group))
        if cross:
            js = js[sides[js] != sides[i]]
        x = packed[js] ^ packed[i]
        folded = (x | x >> np.uint64(1) | x >> np.uint64(2) | x >> np.uint64(3)) & np.uint64(EVERY_NIBBLE)
        equal = 1 - np.bitwise_count(folded).sum(axis=1) / MINIMA
        near = (equal - 2.0**-BITS) / (1 - 2.0**-BITS)
        less, more = np.minimum(sizes[js], sizes[i]), np.maximum(sizes[js], sizes[i])
        earlier = (bands[js, :column] == bands[i, :column]).any(axis=1)
        keep = (near >= LEAST_ESTIMATE) & (100 * less >= PERCENT * more) & ~earlier
        candidates += [(-e, i, j) for e, j in zip(near[keep].tolist(), js[keep].tolist())]
    found = []
    for _, i, j in sorted(candidates):
        a, b = root(labels[i]), root(labels[j])
        if a != b and linked(group.at[i, "shingles"], group.at[j, "shingles"]):
            roots[max(a, b)] = min(a, b)
            found.append((group.at[i, "doc_id"], group.at[j, "doc_id"]))
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def _confirm(pairs: DataFrame, light: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are links: first by sizes and estimate, then on the full sets."""
    left, right = (light.select(*[F.col(c).alias(f"{c}_{k}") for c in light.columns]) for k in "ab")
    rated = pairs.join(left, F.col("a") == F.col("doc_id_a")).join(right, F.col("b") == F.col("doc_id_b"))
    less, more = F.least("n_shingles_a", "n_shingles_b"), F.greatest("n_shingles_a", "n_shingles_b")
    likely = (100 * less >= PERCENT * more) & (estimate(F.col("packed_a"), F.col("packed_b")) >= LEAST_ESTIMATE)
    full = rated.where(likely).select("a", "b")
    full = full.join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("shingles_b")), "b")
    full = full.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("shingles_a")), "a")
    return full.mapInArrow(_confirmed, "a long, b long").distinct()


def _within_small(rows: DataFrame) -> DataFrame:
    """Pairs of different components in buckets of at most SMALL members; the least member, the
    hub, has been compared already."""
    own = rows.where(F.col("n") <= SMALL).where("doc_id <> hub").select("key", "doc_id", "label")
    left, right = (own.select("key", *[F.col(c).alias(f"{c}_{k}") for c in ("doc_id", "label")]) for k in "ab")
    pairs = left.join(right, "key").where("doc_id_a < doc_id_b AND label_a <> label_b")
    return pairs.select(F.col("doc_id_a").alias("a"), F.col("doc_id_b").alias("b")).distinct()


def _within_large(rows: DataFrame, signed: DataFrame, sets: DataFrame) -> DataFrame:
    """Links that join components in larger buckets. Blocks meet in pairs, and each with itself."""
    rows = rows.where(F.col("n") > SMALL)
    own = F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = rows.withColumn("own", own).withColumn("other", other)
    rows = rows.withColumns({
        "first": F.least("own", "other"),
        "second": F.greatest("own", "other"),
        "side": F.when(F.col("own") <= F.col("other"), 1).otherwise(2),
    })
    rows = rows.drop("n_shingles").join(signed.select("doc_id", "n_shingles", "bands", "packed"), "doc_id")
    rows = rows.join(sets, "doc_id")
    columns = ["doc_id", "label", "band", "side", "n_shingles", "bands", "packed", "shingles"]
    return rows.groupBy("key", "first", "second").applyInPandas(
        lambda group: _links_in_block(group[columns]), "a long, b long"
    )


def _mixed(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of the buckets that hold more than one component: with label, members and blocks."""
    labelled = buckets.join(labels.select(F.col("node").alias("doc_id"), "label"), "doc_id", "left")
    labelled = labelled.withColumn("label", F.coalesce("label", "doc_id"))
    mixed = labelled.groupBy("key").agg(
        F.min("label").alias("least"), F.max("label").alias("most"),
        F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("size"),
    )
    blocks = F.ceil(F.greatest(F.col("n") / BLOCK_MEMBERS, F.col("size") / BLOCK_SHINGLES)).cast("int")
    return labelled.join(mixed.where("least <> most").select("key", "n", blocks.alias("blocks")), "key")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of `docs` (doc_id, text).

    Null and empty texts, and those of white space, are linked with nothing. Rows that share a
    doc_id are one node with the links of all their texts; a null doc_id is not linked.
    """
    kind = "doc_id long, n_shingles long, sum_a long, sum_b long, bands array<long>, packed array<long>"
    signed = written(id_and_bytes(docs).mapInArrow(_signed, kind))
    linkable = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    same = ["n_shingles", "sum_a", "sum_b"]
    nodes = linkable.groupBy(same).agg(F.min("doc_id").alias("node"))
    joined = linkable.select("doc_id", *same).join(nodes, same)
    equal = written(joined.select(F.col("doc_id").alias("b"), F.col("node").alias("a")).where("a <> b").distinct())
    first = linkable.join(nodes.select(F.col("node").alias("doc_id")).distinct(), "doc_id", "left_semi")
    first = written(first.dropDuplicates(["doc_id", *same]))
    exploded = first.select("doc_id", "n_shingles", F.posexplode("bands").alias("band", "key"))
    hubs = exploded.groupBy("key").agg(F.min("doc_id").alias("hub"), F.max("doc_id").alias("last"))
    hubs = hubs.where("hub <> last").drop("last")
    buckets = written(exploded.join(hubs, "key"))
    needed = buckets.select("doc_id").distinct()
    texts = docs.select("doc_id", "text").join(needed, "doc_id", "left_semi")
    sets = written(id_and_bytes(texts).mapInArrow(_sets, "doc_id long, shingles binary").distinct())

    light = first.select("doc_id", "n_shingles", "packed")
    pairs = buckets.where("hub <> doc_id").select(F.col("hub").alias("a"), F.col("doc_id").alias("b")).distinct()
    stars = written(_confirm(pairs, light, sets))
    mixed = written(_mixed(buckets, components(stars)))
    small = _confirm(_within_small(mixed), light, sets)
    more_links = written(small.unionByName(_within_large(mixed, first, sets)))
    links = stars.unionByName(more_links).unionByName(equal.select("a", "b"))
    labels = components(links).select(F.col("node").alias("doc_id"), F.col("label").alias("component_id"))
    result = signed.select("doc_id", "n_shingles").join(labels, "doc_id", "left")
    result = result.withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return result.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of `docs` but those of near-duplicates of a document with a smaller doc_id."""
    gone = near_duplicates(docs).where("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)
