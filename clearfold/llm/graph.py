"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearfold.llm.common import written


def _replaced(rows: DataFrame, column: str, by: DataFrame) -> DataFrame:
    """`column` with (node, parent) of `by` applied; nodes that it lacks stay."""
    names = [F.coalesce("parent", column).alias(column) if c == column else F.col(c) for c in rows.columns]
    return rows.join(by.withColumnRenamed("node", column), column, "left").select(names)


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node of `links` (a, b): the least node that it reaches.

    Each round, a node takes its least neighbour as parent if that is less than itself, parents are
    followed to their roots, and the links between roots are what the next round works on. Every
    root but the least of its component vanishes in some round; tables shrink and stay in Spark.
    """
    links = written(links.where("a <> b").distinct())
    out = links.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("label", F.col("node"))
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
        parents = written(least.select("node", F.least("node", "least").alias("parent")))
        while True:
            above = parents.select(F.col("node").alias("parent"), F.col("parent").alias("root"))
            jumped = parents.join(above, "parent", "left").select("node", "parent", F.coalesce("root", "parent").alias("root"))
            jumped = written(jumped)
            parents = jumped.select("node", F.col("root").alias("parent"))
            if jumped.where("root <> parent").isEmpty():
                break
        out = written(_replaced(out, "label", parents))
        links = _replaced(_replaced(links, "a", parents), "b", parents).where("a <> b")
        links = written(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    return out
