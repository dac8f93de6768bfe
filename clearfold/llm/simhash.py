"""Near-duplicate documents by SimHash, found through blocks of the fingerprints.

A fingerprint has 64 bits, the majority votes of the 64-bit hashes of a text's shingles of three
words. Fingerprints that differ in three bits or fewer, cut into six parts, agree in three parts at
least (pigeonhole), so for each of the twenty choices of three parts the fingerprints are joined on
these, and only what meets there is verified by Hamming distance.

Equal fingerprints are one node from the start. A bucket of up to BUCKET nodes is compared in one
row, which hands on no more links than connect its nodes. A larger bucket is never compared whole:
the bits that it does not share are cut into six parts again, and close nodes agree in three of
those too. Each such step halves the free bits, so at the latest the one that leaves eight of them
ends in buckets of at most 256 nodes, however many documents there are. No link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearfold.llm.common import id_and_bytes, written
from clearfold.llm.graph import components

SHINGLE, SEED = 3, 42
DISTANCE = 3
PARTS = 6
# No less than 2 ** (PARTS - 1): down to PARTS free bits, every step leaves fewer.
BUCKET = 256
_VOTES_AT_ONCE = 1 << 16


def fingerprint(text: bytes) -> int:
    """Majority bits of the hashes of all shingles; of the whole sequence where words are fewer."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts, ends = [0, *(spaces + 1).tolist()], [*spaces.tolist(), len(joined)]
    digest = xxhash.xxh64_intdigest
    pairs = zip(starts, ends[SHINGLE - 1 :] or ends[-1:])
    hashes = np.array([digest(joined[a:b], SEED) for a, b in pairs], "<u8")
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _VOTES_AT_ONCE):
        own = hashes[at : at + _VOTES_AT_ONCE].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(own, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = np.array([fingerprint(t) for t in batch.column("text").to_pylist()], np.uint64)
        arrays = [batch.column("doc_id"), pa.array(prints.view(np.int64))]
        yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "print"])


@lru_cache(maxsize=None)
def masks(shared: int = 0) -> list[int]:
    """What close fingerprints agree in, given the bits that they share already: one mask for each
    choice of PARTS - DISTANCE of the PARTS that the other bits are cut into."""
    free = [i for i in range(64) if not shared >> i & 1]
    cuts = [len(free) * k // PARTS for k in range(PARTS + 1)]
    parts = [sum(1 << i for i in free[a:b]) for a, b in zip(cuts, cuts[1:])]
    return [shared | sum(chosen) for chosen in combinations(parts, PARTS - DISTANCE)]


def _masked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each node under every mask that follows from the one it had."""
    for batch in batches:
        had = batch.column("mask").to_numpy().view(np.uint64)
        for mask in np.unique(had).tolist():
            rows = batch.filter(pa.array(had == mask))
            prints = rows.column("print").to_numpy().view(np.uint64)
            for finer in masks(mask):
                arrays = [
                    rows.column("node"), rows.column("print"),
                    pa.array(np.full(len(prints), finer, np.uint64).view(np.int64)),
                    pa.array((prints & np.uint64(finer)).view(np.int64)),
                ]
                yield pa.RecordBatch.from_arrays(arrays, ["node", "print", "mask", "key"])


def close_links(nodes: list[int], prints: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what is connected among some fingerprints, at most one fewer than these."""
    apart = np.bitwise_count(prints[:, None] ^ prints[None, :])
    root = list(range(len(nodes)))

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    links = []
    for i, j in zip(*(x.tolist() for x in np.nonzero(np.triu(apart <= DISTANCE, 1)))):
        a, b = find(i), find(j)
        if a != b:
            root[max(a, b)] = min(a, b)
            links.append((nodes[i], nodes[j]))
    return links


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        links = []
        for bucket in batch.column("bucket").to_pylist():
            prints = np.array([x["print"] for x in bucket], np.int64).view(np.uint64)
            links += close_links([x["node"] for x in bucket], prints)
        a, b = np.array(links, np.int64).reshape(-1, 2).T
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def links(nodes: DataFrame) -> DataFrame:
    """(a, b) of distinct (node, print) rows: enough of the links to connect what they connect."""
    entries = nodes.select("node", "print", F.lit(0).cast("long").alias("mask"))
    found = None
    while found is None or not entries.isEmpty():
        masked = entries.mapInArrow(_masked, "node long, print long, mask long, key long")
        sizes = masked.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        met = written(masked.join(sizes, ["mask", "key"]))
        member = F.struct("node", "print")
        buckets = met.where(F.col("n") <= BUCKET).groupBy("mask", "key").agg(F.collect_list(member).alias("bucket"))
        own = buckets.select("bucket").mapInArrow(_verified, "a long, b long")
        found = own if found is None else found.unionByName(own)
        entries = met.where(F.col("n") > BUCKET).select("node", "print", "mask")
    return found


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint, component_id: one row per row of `docs` (doc_id, text).

    Null and empty texts, and those of white space, have fingerprint zero and are linked like any
    other. Rows that repeat a doc_id are one node with the links of all their texts. A null doc_id
    names no component: its row gets that of the rows with an equal fingerprint, null without such,
    and links nothing else.
    """
    prints = written(id_and_bytes(docs).mapInArrow(_fingerprints, "doc_id long, print long"))
    known = prints.where("doc_id IS NOT NULL")
    nodes = written(known.groupBy("print").agg(F.min("doc_id").alias("node")))
    between = links(nodes)
    # A doc_id with several texts belongs to the nodes of all.
    several = known.groupBy("doc_id").agg(F.min("print").alias("low"), F.max("print").alias("high")).where("low <> high")
    repeated = known.join(several, "doc_id").join(nodes, "print").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    labels = components(between.unionByName(repeated))
    labelled = nodes.join(labels, "node", "left").select("print", F.coalesce("label", "node").alias("component_id"))
    return prints.join(labelled, "print", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )
