"""Records that span pieces of a file, found by many tasks.

A file is read as text cut at a separator, in splits as Spark makes them. Whether a piece begins a
record depends on all that stands before it, so each split is first summed up for both states it may
begin in (inside or outside a quoted text), the few sums are composed in file order, and with its
true state every split numbers its own records. Pieces then meet by record, so that a record may
cross any number of split edges. Texts are shuffled twice, the sums hold one row per split.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_OF_SPLIT = ["_file", "_split"]
_UP_TO_HERE = (Window.unboundedPreceding, Window.currentRow)
_BEFORE = (Window.unboundedPreceding, -1)


def _in_split():
    return Window.partitionBy(*_OF_SPLIT).orderBy("_at")


def _in_file():
    return Window.partitionBy("_file").orderBy("_split")


@dataclass(frozen=True)
class Marks:
    """What a piece does, for both states (0 outside a quoted text, 1 inside) it may begin in: the
    state it ends in and by how much it changes the depth. `piece` is the column read."""

    separator: str
    ends: tuple[Column, Column]
    deepens: tuple[Column, Column]


def csv_marks() -> Marks:
    """Lines. A run of quotes changes the state if it is odd; outside, only where a cell begins, since
    quotes in a cell that does not begin with one are plain text."""
    runs = F.regexp_extract_all(F.concat(F.lit(","), "piece"), F.lit(',?"+'), 0)
    odd = F.filter(runs, lambda r: F.length(F.replace(r, F.lit(","), F.lit(""))) % 2 == 1)

    def end(state: int) -> Column:
        step = lambda s, r: F.when((s == 0) & r.startswith(","), 1).otherwise(0)
        return F.when(F.col("piece").contains('"'), F.aggregate(odd, F.lit(state), step)).otherwise(state)

    return Marks("\n", (end(0), end(1)), (F.lit(0), F.lit(0)))


def json_marks() -> Marks:
    """Texts up to a closing brace. Escapes never reach over a piece's end, as \\} is none."""
    plain = F.regexp_replace("piece", r"(?s)\\.", "")
    parts = F.split(plain, '"', -1)
    odd = (F.size(parts) - 1) % 2

    def deepen(state: int) -> Column:
        outside = F.array_join(F.filter(parts, lambda _, i: i % 2 == state), "")
        opened = F.length(outside) - F.length(F.replace(outside, F.lit("{"), F.lit("")))
        return opened - F.when((odd + state) % 2 == 0, 1).otherwise(0)

    return Marks("}", (odd, 1 - odd), (deepen(0), deepen(1)))


def _states(rows: DataFrame, window, f: tuple[str, str]) -> DataFrame:
    """Adds the state before and after each row, for both states at the window's begin: `before0`,
    `before1`, `after0`, `after1`. f names the states a row turns 0 and 1 into.

    A row leaves the state, flips it, or sets it whatever it was; what counts is the last one that
    sets it and the number of flips since.
    """
    f0, f1 = F.col(f[0]), F.col(f[1])
    flips = F.sum(F.when((f0 == 1) & (f1 == 0), 1).otherwise(0))
    rows = rows.withColumn("_p", flips.over(window.rowsBetween(*_UP_TO_HERE)))
    rows = rows.withColumn("_k", F.when(f0 == f1, (f0 + F.col("_p")) % 2))
    last = F.last("_k", ignorenulls=True)
    rows = rows.select(
        "*",
        last.over(window.rowsBetween(*_UP_TO_HERE)).alias("_k_after"),
        last.over(window.rowsBetween(*_BEFORE)).alias("_k_before"),
        F.coalesce(F.lag("_p").over(window), F.lit(0)).alias("_p_before"),
    )
    states = {
        f"{when}{s}": ((F.coalesce(k, F.lit(s)) + p) % 2).cast("int")
        for when, k, p in (("before", "_k_before", F.col("_p_before")), ("after", "_k_after", F.col("_p")))
        for s in (0, 1)
    }
    return rows.withColumns(states).drop("_p", "_k", "_k_after", "_k_before", "_p_before")


def _marked(pieces: DataFrame, marks: Marks) -> DataFrame:
    """Adds to each piece, for both states of its split's begin, the state and depth before it."""
    sized = pieces.withColumns({"_e0": marks.ends[0], "_e1": marks.ends[1], "_d0": marks.deepens[0], "_d1": marks.deepens[1]})
    placed = _states(sized, _in_split(), ("_e0", "_e1"))
    here = {f"_here{s}": F.when(F.col(f"before{s}") == 0, F.col("_d0")).otherwise(F.col("_d1")) for s in (0, 1)}
    depth = {
        f"depth{s}": F.coalesce(F.sum(f"_here{s}").over(_in_split().rowsBetween(*_BEFORE)), F.lit(0)) for s in (0, 1)
    }
    return placed.withColumns(here).withColumns(depth).drop("_e0", "_e1", "_d0", "_d1")


def _splits(marked: DataFrame) -> DataFrame:
    """One row per split: its state, its depth and the number of records begun before it, its file's
    rank, and its file's last piece.

    Depth never falls below none, so where records begin in a split, they do at its least depth.
    """
    whole = Window.partitionBy(*_OF_SPLIT)
    outside = {s: F.when(F.col(f"before{s}") == 0, F.col(f"depth{s}")) for s in (0, 1)}
    least = marked.withColumns({f"_least{s}": F.min(outside[s]).over(whole) for s in (0, 1)})
    sums = []
    for s in (0, 1):
        sums += [
            F.max_by(f"after{s}", "_at").alias(f"end{s}"),
            F.sum(f"_here{s}").alias(f"deepens{s}"),
            F.min(f"_least{s}").alias(f"least{s}"),
            F.count_if(outside[s] == F.col(f"_least{s}")).alias(f"begun{s}"),
        ]
    by_split = least.groupBy(*_OF_SPLIT).agg(*sums, F.max_by("piece", "_at").alias("_last"))
    placed = _states(by_split, _in_file(), ("end0", "end1"))

    def true(name: str) -> Column:
        return F.when(F.col("before0") == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1"))

    before = _in_file().rowsBetween(*_BEFORE)
    known = placed.select(
        *_OF_SPLIT, F.col("before0").alias("_state"), true("deepens").alias("_deepens"),
        true("least").alias("_least"), true("begun").alias("_begun"),
        F.last("_last").over(_in_file().rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing)).alias("_end"),
    )
    deep = known.withColumn("_depth", F.coalesce(F.sum("_deepens").over(before), F.lit(0)))
    begun = F.when(F.col("_least") + F.col("_depth") == 0, F.col("_begun")).otherwise(0)
    counted = deep.withColumn("_offset", F.coalesce(F.sum(begun).over(before), F.lit(0)))
    ranked = counted.withColumn("_rank", F.dense_rank().over(Window.orderBy("_file")) - 1)
    return ranked.select(*_OF_SPLIT, "_state", "_depth", "_offset", "_rank", "_end")


def records(spark: SparkSession, path: str | list[str], marks: Marks) -> DataFrame:
    """(rank, number, record, end): a file's rank by path, a record's number in it from 1, the record's
    pieces joined by the separator, and the file's last piece.

    Bytes that are not UTF-8 become replacement characters, a leading byte order mark goes. An empty
    file holds no record. A compressed file is one split.
    """
    text = F.make_valid_utf8("value")
    pieces = spark.read.text(path, lineSep=marks.separator).select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_at"),
        F.when(F.col("_metadata.file_block_start") == 0, F.regexp_replace(text, "^﻿", "")).otherwise(text).alias("piece"),
    )
    marked = _marked(pieces, marks)
    known = marked.join(_splits(marked), _OF_SPLIT)
    outside = F.when(F.col("_state") == 0, F.col("before0")).otherwise(F.col("before1")) == 0
    depth = F.col("_depth") + F.when(F.col("_state") == 0, F.col("depth0")).otherwise(F.col("depth1"))
    begins = F.sum((outside & (depth == 0)).cast("int")).over(_in_split().rowsBetween(*_UP_TO_HERE))
    numbered = known.withColumn("_number", F.col("_offset") + begins)
    parts = F.array_sort(F.collect_list(F.struct("_split", "_at", "piece")))
    together = numbered.groupBy("_rank", "_number").agg(parts.alias("parts"), F.first("_end").alias("end"))
    return together.select(
        F.col("_rank").cast("bigint").alias("rank"),
        F.col("_number").cast("bigint").alias("number"),
        F.array_join(F.col("parts.piece"), marks.separator).alias("record"),
        "end",
    )
