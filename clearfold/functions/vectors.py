"""Sparse term-frequency vectors held in the row they describe.

A vector is two parallel arrays, its terms in ascending order and their counts. It is built from
the row's own tokens (sort, then run lengths), so vectorising a corpus needs no shuffle at all;
exploding the tokens and grouping by (row, term) would move every distinct term of every text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clearfold.functions.text import tokens


def _let(value: Column, body) -> Column:
    """Bind a column to a lambda variable so that it is evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _runs(words: Column) -> Column:
    starts = F.array_compact(
        F.transform(words, lambda w, i: F.when((i == 0) | (w != F.get(words, i - 1)), i))
    )
    return _let(
        starts,
        lambda at: F.struct(
            F.transform(at, lambda p: F.get(words, p)).alias("terms"),
            F.transform(
                at,
                lambda p, j: (F.coalesce(F.get(at, j + 1), F.size(words)) - p).cast("bigint"),
            ).alias("counts"),
        ),
    )


def term_vector(text: Column) -> Column:
    """struct<terms array<string>, counts array<bigint>>; both empty for a text without tokens."""
    return _let(F.sort_array(tokens(text)), _runs)


def norm(counts: Column) -> Column:
    squares = F.aggregate(counts, F.lit(0).cast("bigint"), lambda acc, n: acc + n * n)
    return F.sqrt(squares.cast("double"))


def cosine(dot_product: Column, a_norm: Column, b_norm: Column) -> Column:
    """One fixed expression, so that equal vectors give equal scores; 0 for an empty vector."""
    scale = a_norm * b_norm
    return F.when(scale > 0, dot_product.cast("double") / scale).otherwise(F.lit(0.0))
