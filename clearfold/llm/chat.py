"""Preference formatting of conversations.

A chosen and a rejected conversation are compared turn by turn. The turns before the first that
differs are the prompt, rendered once; what follows on either side is a completion. A part of a pair
is a series of segments, one row per turn, with its place in the part's text: a conversation of any
length stays spread over rows. `train_from` and `train_to` bound the characters that a loss may
count: the text and closing mark of assistant turns of completions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clearfold.llm.common import written

# Marks around a turn.
OPENING, CLOSING = "<|im_start|>", "<|im_end|>\n"
TURNS_PER_BLOCK = 512


def turns_of(conversations: DataFrame) -> DataFrame:
    """One row per (conv_id, turn): of several the least by role, then text; nulls become empty.

    Rows without conv_id or turn belong to no conversation.
    """
    said = F.min(F.struct(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")))
    known = conversations.where("conv_id IS NOT NULL AND turn IS NOT NULL")
    return known.groupBy("conv_id", "turn").agg(said.alias("said")).select("conv_id", "turn", "said.*")


def with_other_end(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chosen and rejected conversations (pair_id, turn, role, text) made of ordinary ones.

    Chosen is each whole conversation. Rejected is the same up to its pivot, an assistant turn, and
    from there on what conversation `conv_id xor 1` says from its own pivot to its end; if there is no
    such, it ends before. The pivot is the first assistant turn where conv_id / 2 is even, else the
    last. A conversation without an assistant turn is rejected as it is chosen, hence prompt only.
    """
    answers = turns.where("role = 'assistant'").groupBy("conv_id")
    is_first = F.expr("conv_id div 2 % 2 = 0")
    pivots = answers.agg(F.min("turn").alias("first"), F.max("turn").alias("last")).select(
        "conv_id", F.when(is_first, F.col("first")).otherwise(F.col("last")).alias("pivot")
    )
    placed = turns.join(pivots, "conv_id", "left")
    pair = F.col("conv_id").alias("pair_id")
    before = placed.where("pivot IS NULL OR turn < pivot").select(pair, "turn", "role", "text")
    ends = placed.where("turn >= pivot").select(
        F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"), (F.col("turn") - F.col("pivot")).alias("ahead"), "role", "text"
    )
    other = ends.join(pivots, "conv_id").select(pair, (F.col("pivot") + F.col("ahead")).alias("turn"), "role", "text")
    return turns.select(pair, "turn", "role", "text"), before.unionByName(other)


def _placed(segments: DataFrame) -> DataFrame:
    """Adds `start`: characters of the part before the segment, summed over blocks of turns."""
    block = F.floor(F.col("turn") / TURNS_PER_BLOCK)
    rows = segments.withColumn("block", block)
    before = Window.partitionBy("pair_id", "part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("pair_id", "part", "block").agg(F.sum("length").alias("size"))
    blocks = blocks.withColumn("earlier", F.coalesce(F.sum("size").over(before), F.lit(0))).drop("size")
    within = Window.partitionBy("pair_id", "part", "block").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("own", F.coalesce(F.sum("length").over(within), F.lit(0)))
    joined = rows.join(blocks, ["pair_id", "part", "block"])
    return joined.withColumn("start", F.col("earlier") + F.col("own")).drop("earlier", "own", "block")


def format_preferences(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """pair_id, part (prompt, chosen, rejected), turn, role, rendered, start, length, train_from,
    train_to: the segments of each pair's prompt and completions.

    Both inputs have one row per (pair_id, turn). Conversations that do not differ are prompt only.
    A side that ends first has an empty completion.
    """
    left = chosen.select("pair_id", "turn", F.struct("role", "text").alias("chosen"))
    right = rejected.select("pair_id", "turn", F.struct("role", "text").alias("rejected"))
    both = written(left.join(right, ["pair_id", "turn"], "full"))
    differs = ~F.col("chosen").eqNullSafe(F.col("rejected"))
    ends = both.where(differs).groupBy("pair_id").agg(F.min("turn").alias("prompt_end"))
    both = both.join(ends, "pair_id", "left")
    in_prompt = F.col("prompt_end").isNull() | (F.col("turn") < F.col("prompt_end"))

    def part(name: str, said: Column, where: Column) -> Column:
        return F.when(where & said.isNotNull(), F.struct(F.lit(name).alias("part"), said["role"].alias("role"), said["text"].alias("text")))

    parts = F.array_compact(F.array(
        part("prompt", F.col("chosen"), in_prompt),
        part("chosen", F.col("chosen"), ~in_prompt),
        part("rejected", F.col("rejected"), ~in_prompt),
    ))
    rows = both.select("pair_id", "turn", F.explode(parts).alias("p")).select("pair_id", "turn", "p.*")
    head = F.concat(F.lit(OPENING), F.col("role"), F.lit("\n"))
    rows = rows.withColumn("rendered", F.concat(head, F.col("text"), F.lit(CLOSING)))
    rows = rows.withColumn("length", F.length("rendered").cast("long"))
    trained = (F.col("part") != "prompt") & (F.col("role") == "assistant")
    placed = _placed(rows)
    return placed.select(
        "pair_id", "part", "turn", "role", "rendered", "start", "length",
        F.when(trained, F.col("start") + F.length(head)).alias("train_from"),
        F.when(trained, F.col("start") + F.col("length") - 1).alias("train_to"),
    )
