"""Hard negatives by a vertical scan of the vectors (BOND).

Rows are packed into blocks that hold each dimension as a column. An anchor reads a block's
dimensions in descending order of its own magnitudes. What the dimensions not yet read can still add
to a row's inner product lies between sums of the products with their least and greatest values in
the block, so after every few dimensions the bitmap of rows that can still matter shrinks: for the
positives, rows that can reach the last place of the best found; for the negatives, rows that can
lie in a window of one of the anchor's positives and reach the last place found there. Once few
rows are left, their remaining dimensions are read at once. Rows dropped are those that bounds
exclude; scores are exact integers.

Anchors are packed too, and every block of anchors meets every block of rows: pairs of blocks, of
bounded size, are what Spark distributes. Each run of row blocks hands on the best few for each
anchor, and these are ranked together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clearfold.llm.common import ship, written

SCALE = 256
ANCHOR_EVERY = 50
POSITIVES, NEGATIVES = 5, 3
LEAST_PERCENT, MOST_PERCENT = 50, 95
# Rows and anchors of a block, and row blocks that one task goes through for a block of anchors.
BLOCK_ROWS, BLOCK_ANCHORS, RUN = 4096, 512, 16
# Dimensions read between two looks at the bounds, and rows that are finished without further looks.
STEP, FEW = 16, 64
# Scaled components are held within these limits, so that 95 times the sum of 2,048 products fits 64 bits.
LARGEST = 1 << 22


def vectors(rows: DataFrame) -> DataFrame:
    """(vec_id, label, vector): the rows that take part, with scaled whole components."""
    x = F.col("embedding")
    whole = F.forall(x, lambda v: v.isNotNull() & (F.abs(v) < float("inf")) & ~F.isnan(v))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    scaled = F.transform(
        x, lambda v: F.floor(F.greatest(F.least(v.cast("double") * SCALE, F.lit(float(LARGEST))), F.lit(-float(LARGEST))))
    )
    taking = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & whole)
    return taking.select(F.col("vec_id").cast("long"), label.cast("long").alias("label"), scaled.alias("vector"))


def _packed(rows: DataFrame, size: int, run: int) -> DataFrame:
    """(block, run, ids, labels, vectors): rows in blocks of about `size`, dealt by hash."""
    blocks = max(1, -(-rows.count() // size))
    block = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(blocks)).cast("int")
    own = rows.withColumn("block", block).groupBy("block").agg(F.collect_list(F.struct("vec_id", "label", "vector")).alias("rows"))
    return own.select("block", (F.col("block") / run).cast("int").alias("run"), "rows")


class Block:
    """Rows by column, in ascending order of their ids. Shorter vectors end in zeros."""

    def __init__(self, rows: list[dict], width: int):
        rows = sorted(rows, key=lambda r: r["vec_id"])
        self.ids = np.array([r["vec_id"] for r in rows], np.int64)
        self.labels = np.array([r["label"] for r in rows], np.int64)
        self.columns = np.zeros((width, len(rows)), np.int64)
        for i, r in enumerate(rows):
            self.columns[: len(r["vector"]), i] = r["vector"][:width]
        self.least, self.most = self.columns.min(axis=1), self.columns.max(axis=1)
        # Sums below 2 ** 53 are exact in floating point too, which multiplies faster.
        self.doubles = self.columns.astype(np.float64)
        self.greatest = int(np.abs(self.columns).max(initial=0))

    def products(self, weights: np.ndarray, dimensions: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """What some dimensions add to the scores of some rows."""
        exact = int(np.abs(weights).sum()) * self.greatest < 1 << 53
        columns = self.doubles if exact else self.columns
        own = columns[dimensions] if len(rows) == len(self.ids) else columns[dimensions[:, None], rows]
        return (weights.astype(own.dtype) @ own).astype(np.int64)

    def scan(self, anchor: np.ndarray, bitmap: np.ndarray, can_matter) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the bitmap that `can_matter(lower, upper)`, bounds of their scores, leaves, and
        their exact scores."""
        order = np.argsort(-np.abs(anchor), kind="stable")
        order = order[: np.count_nonzero(anchor)]
        weights = anchor[order]
        low, high = weights * self.least[order], weights * self.most[order]
        # What the dimensions from each on can add at least and at most.
        rest_least = np.append(np.cumsum(np.minimum(low, high)[::-1])[::-1], 0)
        rest_most = np.append(np.cumsum(np.maximum(low, high)[::-1])[::-1], 0)
        rows = np.flatnonzero(bitmap)
        scores = np.zeros(len(rows), np.int64)
        read = 0
        while read < len(order) and len(rows):
            until = len(order) if len(rows) <= FEW else min(len(order), read + STEP)
            scores += self.products(weights[read:until], order[read:until], rows)
            read = until
            stays = can_matter(scores + rest_least[read], scores + rest_most[read])
            rows, scores = rows[stays], scores[stays]
        if not len(order):
            stays = can_matter(scores, scores)
            rows, scores = rows[stays], scores[stays]
        return rows, scores


def _best(found: list[tuple[int, int]], n: int) -> list[tuple[int, int]]:
    """The n first of (score, id), higher scores and then smaller ids first."""
    return sorted(found, key=lambda x: (-x[0], x[1]))[:n]


def _nth(lower: np.ndarray, n: int) -> int | None:
    return int(np.partition(lower, len(lower) - n)[len(lower) - n]) if len(lower) >= n else None


def positives_in(block: Block, anchor: dict, width: int, best: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The best POSITIVES of those known and the block's other rows of the anchor's label."""
    bitmap = (block.labels == anchor["label"]) & (block.ids != anchor["vec_id"])
    floor = best[-1][0] if len(best) == POSITIVES else None

    def can_matter(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        bounds = [x for x in (floor, _nth(lower, POSITIVES)) if x is not None]
        return upper >= max(bounds) if bounds else np.ones(len(upper), bool)

    rows, scores = block.scan(_dense(anchor["vector"], width), bitmap, can_matter)
    return _best(best + list(zip(scores.tolist(), block.ids[rows].tolist())), POSITIVES)


def window(positive: int) -> tuple[int, int]:
    """The least and the greatest negative score that goes with a positive's; empty below zero."""
    return -(-LEAST_PERCENT * positive // 100), MOST_PERCENT * positive // 100


def negatives_in(
    block: Block, anchor: dict, width: int, best: dict[tuple[int, int], list[tuple[int, int]]]
) -> dict[tuple[int, int], list[tuple[int, int]]]:
    """For each window the best NEGATIVES of those known and the block's rows of other labels."""

    def can_matter(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        out = np.zeros(len(upper), bool)
        for (least, most), known in best.items():
            floor = max(least, known[-1][0]) if len(known) == NEGATIVES else least
            sure = lower[(lower >= least) & (upper <= most)]
            if len(sure) >= NEGATIVES:
                floor = max(floor, _nth(sure, NEGATIVES))
            out |= (upper >= floor) & (lower <= most)
        return out

    rows, scores = block.scan(_dense(anchor["vector"], width), block.labels != anchor["label"], can_matter)
    found = list(zip(scores.tolist(), block.ids[rows].tolist()))
    return {w: _best(known + [x for x in found if w[0] <= x[0] <= w[1]], NEGATIVES) for w, known in best.items()}


def _dense(vector: list[int], width: int) -> np.ndarray:
    out = np.zeros(width, np.int64)
    out[: len(vector)] = vector[:width]
    return out


def _meetings(anchors: DataFrame, blocks: DataFrame) -> DataFrame:
    """Every block of anchors beside every run of row blocks."""
    n_runs = blocks.agg(F.max("run")).first()[0]
    runs = F.explode(F.sequence(F.lit(0), F.lit(n_runs or 0))).alias("run")
    return anchors.select(F.col("block").alias("anchor_block"), F.col("rows").alias("anchors"), runs)


def _pairs(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[list[dict], Block]]:
    for batch in batches:
        for i in range(len(batch)):
            yield batch.column("anchors")[i].as_py(), Block(batch.column("rows")[i].as_py(), width)


def _positives(width: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list] = {}
        for own, block in _pairs(batches, width):
            for anchor in own:
                key = anchor["anchor"]
                best[key] = positives_in(block, anchor, width, best.get(key, []))
        rows = [(k, i, s) for k, found in best.items() for s, i in found]
        a, i, s = np.array(rows, np.int64).reshape(-1, 3).T
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(i), pa.array(s)], ["anchor", "positive_id", "positive_score"])

    return find


def _negatives(width: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, dict] = {}
        for own, block in _pairs(batches, width):
            for anchor in own:
                key = anchor["anchor"]
                known = best.get(key) or {window(s): [] for s in anchor["positive_scores"] if s >= 0}
                best[key] = negatives_in(block, anchor, width, known)
        rows = [(k, *w, i, s) for k, of in best.items() for w, found in of.items() for s, i in found]
        columns = np.array(rows, np.int64).reshape(-1, 5).T
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor", "least", "most", "negative_id", "negative_score"])

    return find


def _met(anchors: DataFrame, blocks: DataFrame) -> DataFrame:
    """Pairs of blocks, those of one block of anchors and one run of rows in one partition."""
    met = _meetings(anchors, blocks).join(blocks.select("run", "block", "rows"), "run")
    return met.repartition("anchor_block", "run").select("anchors", "rows")


def _packed_anchors(anchors: DataFrame) -> DataFrame:
    blocks = max(1, -(-anchors.count() // BLOCK_ANCHORS))
    block = F.pmod(F.xxhash64("anchor"), F.lit(blocks)).cast("int").alias("block")
    return anchors.withColumn("block", block).groupBy("block").agg(F.collect_list(F.struct(*anchors.columns)).alias("rows"))


def hard_negatives(rows: DataFrame, every: int = ANCHOR_EVERY) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of `rows`
    (vec_id, embedding, label); anchors are those whose vec_id is divisible by `every`.

    Rows with a null id, label or vector, or a component that is null or not finite, take no part.
    Vectors of different lengths are compared as if the shorter one ended in zeros; components
    beyond 2 ** 22 / 256 count as that. Rows that repeat an id take part one by one, but are no other
    rows to one another's anchors; equal anchors count once. Ties go to smaller ids. An anchor without
    positives, and one without negatives in a positive's window, has no row for these.
    """
    ship(rows.sparkSession)
    taking = written(vectors(rows))
    width = taking.agg(F.max(F.size("vector"))).first()[0] or 0
    blocks = written(_packed(taking, BLOCK_ROWS, RUN))
    chosen = taking.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "label", "vector"])
    # Anchors that share an id stay apart by a name of their own.
    anchors = written(chosen.withColumn("anchor", F.monotonically_increasing_id()))
    found = _met(_packed_anchors(anchors), blocks).mapInArrow(
        _positives(width), "anchor long, positive_id long, positive_score long"
    )
    order = Window.partitionBy("anchor").orderBy(F.desc("positive_score"), "positive_id")
    positives = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= POSITIVES)
    positives = written(positives)
    scores = positives.groupBy("anchor").agg(F.collect_set("positive_score").alias("positive_scores"))
    windows = _met(_packed_anchors(anchors.join(scores, "anchor")), blocks).mapInArrow(
        _negatives(width), "anchor long, least long, most long, negative_id long, negative_score long"
    )
    order = Window.partitionBy("anchor", "least", "most").orderBy(F.desc("negative_score"), "negative_id")
    windows = windows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= NEGATIVES)
    named = positives.where("positive_score >= 0").withColumns({
        "least": F.expr(f"({LEAST_PERCENT} * positive_score + 99) div 100"),
        "most": F.expr(f"{MOST_PERCENT} * positive_score div 100"),
    })
    ids = anchors.select("anchor", F.col("vec_id").alias("anchor_id"))
    return named.join(windows, ["anchor", "least", "most"]).join(ids, "anchor").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
