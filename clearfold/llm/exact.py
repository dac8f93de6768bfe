"""Exact deduplication by two-pass Bloom filtering, in DataFrame functions alone.

The first pass digests each text into a narrow table and marks two places of a bit field per
digest. A bit is set where a place was marked twice. In the second pass rows with both bits set may
be repeated and are grouped; every other row passes straight through. The field has about 16 bits
per row, 16 MB at most; a fuller field lets more single rows into the grouping and changes no
result. Groups of a thousandth of all rows or more, at most a thousand, are joined back by
broadcast, so that no key gathers its rows in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearfold.llm.common import WHITE, written

BLOCK_BITS = 32768
MAX_BLOCKS = 4096
BITS_PER_ROW = 16
HOT_SHARE = 1000


def normalised(text: Column) -> Column:
    """The text without white space; empty for null."""
    out = F.coalesce(text, F.lit(""))
    for c in WHITE:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(normalised(text).cast("binary"), 256))


def _block(digest: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(digest), F.lit(blocks))


def _bits(digest: Column) -> list[Column]:
    """Two places in the digest's block."""
    return [F.pmod(F.xxhash64(digest, F.lit(k)), F.lit(BLOCK_BITS)) for k in (1, 2)]


def repeated_bits(digests: DataFrame, blocks: int) -> DataFrame:
    """(block, bits): the places that two digests or more have marked."""
    places = F.explode(F.array_distinct(F.array(*_bits(F.col("digest")))))
    marked = digests.select(_block(F.col("digest"), blocks).alias("block"), places.alias("place"))
    twice = marked.groupBy("block", "place").count().where("count > 1")
    return twice.groupBy("block").agg(F.bitmap_construct_agg("place").alias("bits"))


def _is_set(bits: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (place / 8).cast("int") + 1, F.lit(1))), 16, 10)
    return byte.cast("int").bitwiseAND(F.pow(F.lit(2), place % 8).cast("int")) != 0


def with_maybe(rows: DataFrame, field: DataFrame, blocks: int) -> DataFrame:
    """Adds `maybe`: whether another row may have the same `digest`. Moves no row."""
    first, second = _bits(F.col("digest"))
    near = rows.withColumn("block", _block(F.col("digest"), blocks))
    near = near.join(F.broadcast(field), "block", "left")
    found = _is_set(F.col("bits"), first) & _is_set(F.col("bits"), second)
    return near.withColumn("maybe", F.coalesce(found, F.lit(False))).drop("block", "bits")


def block_count(n_rows: int) -> int:
    need = max(1, n_rows * BITS_PER_ROW / BLOCK_BITS)
    return min(MAX_BLOCKS, 2 ** math.ceil(math.log2(need)))


class ExactDuplicates:
    """Groups of equal texts of `docs` (doc_id, text; further columns are ignored).

    Null texts equal empty ones, and all of these form a group. Rows that repeat a doc_id stay apart
    rows; if theirs is the id that stays, `kept` holds for each. A null id loses every tie.
    """

    def __init__(self, docs: DataFrame):
        own = docs.select(
            F.col("doc_id"),
            F.length(F.coalesce("text", F.lit(""))).alias("n_chars"),
            digest(F.col("text")).alias("digest"),
        )
        self.digests = written(own)
        self.n_rows = self.digests.count()
        self.blocks = block_count(self.n_rows)
        self.field = written(repeated_bits(self.digests, self.blocks))

    def groups(self, maybe: DataFrame) -> DataFrame:
        best = F.min(F.struct(-F.col("n_chars"), F.col("doc_id").isNull(), F.col("doc_id")))
        return maybe.groupBy("digest").agg(
            best["doc_id"].alias("keep_id"), F.max("n_chars").alias("n_chars"), F.count(F.lit(1)).alias("group_size")
        )

    def result(self) -> DataFrame:
        """doc_id, keep_id, group_size, kept, text_sha256: one row per row of the input."""
        rows = with_maybe(self.digests, self.field, self.blocks)
        alone = rows.where(~F.col("maybe")).select(
            "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "digest"
        )
        maybe = rows.where("maybe").select("doc_id", "n_chars", "digest")
        groups = self.groups(maybe)
        is_hot = F.col("group_size") * HOT_SHARE >= self.n_rows
        hot = maybe.select("doc_id", "digest").join(
            F.broadcast(groups.where(is_hot).drop("n_chars").withColumn("hot", F.lit(True))), "digest", "left"
        )
        rest = hot.where(F.col("hot").isNull()).select("doc_id", "digest")
        columns = ["doc_id", "keep_id", "group_size", "digest"]
        rest = rest.join(groups.where(~is_hot).drop("n_chars"), "digest").select(columns)
        both = alone.unionByName(hot.where("hot").select(columns)).unionByName(rest)
        return both.select(
            "doc_id", "keep_id", "group_size",
            F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )

    def distinct(self, docs: DataFrame) -> DataFrame:
        """The rows of `docs` that stay, one for each group, with all their columns.

        Rows that have no copy are not moved; of the others only those that stay are. Of rows that
        share the id that stays, the longest text does, of equally long ones any.
        """
        n_chars = F.length(F.coalesce("text", F.lit("")))
        whole = docs.select(
            "doc_id", n_chars.alias("n_chars"), digest(F.col("text")).alias("digest"), F.struct("*").alias("row")
        )
        rows = with_maybe(whole, self.field, self.blocks)
        narrow = with_maybe(self.digests, self.field, self.blocks).where("maybe")
        stays = self.groups(narrow).select("digest", F.col("keep_id").alias("doc_id"), "n_chars")
        maybe = rows.where("maybe")
        same = maybe["digest"].eqNullSafe(stays["digest"]) & maybe["doc_id"].eqNullSafe(stays["doc_id"])
        same = same & (maybe["n_chars"] == stays["n_chars"])
        copies = maybe.join(stays, same, "left_semi").dropDuplicates(["doc_id", "digest"])
        return rows.where(~F.col("maybe")).select("row.*").unionByName(copies.select("row.*"))
