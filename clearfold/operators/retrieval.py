"""Term-vector knowledge store and exact cosine top-k search.

Questions are a stated set, the store grows. A search reads the store's vectors where they lie and
moves none of them: each task scores its chunks against a slice of the questions, block by block (see
`scoring`), and hands on no more than the k best per question, which one shuffle ranks. Questions go
to the tasks in slices of SLICE, so what is broadcast has a bound; more questions are more passes.

`postings` is the store's inverted index, to be kept as a table: sorted by term, with the chunks of
each run of 1,024 positions in one row, their places as differences, and the greatest weight among
them. A search over it reads only the rows of the asked terms.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clearfold.functions import vectors
from clearfold.functions.shipping import ship
from clearfold.operators import scoring
from clearfold.schema import ORDER_COLUMN
from clearfold.settings import NO_ANSWER_DOC, NO_ANSWER_TEXT

# Questions that are broadcast at once, and asked terms of which a scan is told one by one.
SLICE = 1024
LISTED_TERMS = 20_000
# Positions of an index row; the least power of two that a row's chunks cannot exceed.
RUN_BITS = 10

_CHUNK = ["store_id", "chunk_order"]
_ASKED = ["store_id", "question_id"]


def build_store(records: DataFrame, store_id: str | Column = "kb") -> DataFrame:
    """One chunk per record, in input order. Written out, it serves any number of searches."""
    name = F.lit(store_id) if isinstance(store_id, str) else store_id
    text = F.coalesce("content", F.lit(""))
    embedded = records.withColumn("_vector", vectors.term_vector(text))
    return embedded.select(
        name.alias("store_id"),
        F.col(ORDER_COLUMN).alias("chunk_order"),
        "doc_id",
        "version",
        "effective_date",
        "source_uri",
        text.alias("text"),
        F.col("_vector.terms").alias("terms"),
        F.col("_vector.counts").alias("counts"),
        vectors.norm(F.col("_vector.counts")).alias("norm"),
    )


def term_frequencies(store: DataFrame) -> DataFrame:
    """The vectors in long form, one row per chunk and term."""
    zipped = store.select(*_CHUNK, F.inline(F.arrays_zip("terms", "counts")))
    return zipped.select(*_CHUNK, F.col("terms").alias("term"), F.col("counts").alias("tf"))


def embed_questions(questions: DataFrame) -> DataFrame:
    """Questions (question_id, question, ...) with their vectors."""
    embedded = questions.withColumn("_q", vectors.term_vector(F.col("question")))
    return embedded.select(
        "question_id",
        F.col("_q.terms").alias("q_terms"),
        F.col("_q.counts").alias("q_counts"),
        vectors.norm(F.col("_q.counts")).alias("q_norm"),
    )


def _index_run(of: pa.Table) -> pa.Table:
    """The index rows of one run of positions, from its chunks' vectors."""
    chunks = of.sort_by("place").combine_chunks()
    terms, counts = (chunks.column(c).combine_chunks() for c in ("terms", "counts"))
    lengths = pc.list_value_length(terms).to_numpy()
    tf = counts.flatten().to_numpy()
    sums, ends = np.concatenate([[0], np.cumsum(tf * tf)]), np.cumsum(lengths)
    squares = (sums[ends] - sums[ends - lengths]).astype(np.int64)
    encoded = pc.dictionary_encode(terms.flatten())
    term = encoded.indices.to_numpy()
    order = np.argsort(term, kind="stable")
    chunk, tf = np.repeat(np.arange(len(lengths)), lengths)[order], tf[order]
    starts = np.searchsorted(term[order], np.arange(len(encoded.dictionary) + 1))
    place = chunks.column("place").to_numpy()[chunk]
    gaps = np.diff(place, prepend=0)
    gaps[starts[:-1]] = place[starts[:-1]]
    weight = tf / np.sqrt(squares[chunk].astype(np.float64))
    n, edges = len(starts) - 1, pa.array(starts, pa.int32())
    return pa.table({
        "store_id": chunks.column("store_id").slice(0, 1).combine_chunks().take(pa.array(np.zeros(n, np.int64))),
        "term": encoded.dictionary,
        "run": chunks.column("run").slice(0, 1).combine_chunks().take(pa.array(np.zeros(n, np.int64))),
        "most": np.maximum.reduceat(weight, starts[:-1]) if n else weight,
        "places": pa.ListArray.from_arrays(edges, pa.array(gaps, pa.int16())),
        "tfs": pa.ListArray.from_arrays(edges, pa.array(tf, pa.int32())),
        "squares": pa.ListArray.from_arrays(edges, pa.array(squares[chunk], pa.int64())),
    })


def postings(store: DataFrame) -> DataFrame:
    """The inverted index: store_id, term, run, most, places, tfs, norms, sorted by term.

    A row has a term's chunks within a run of positions, so at most 1,024 of them; `places` are the
    differences of their positions and `most` is the greatest weight (tf / norm). The vectors meet by
    run, so that no row per chunk and term is ever moved or sorted; numbers travel as small whole ones.
    """
    ship(store.sparkSession)
    run = F.shiftright("chunk_order", RUN_BITS).alias("run")
    place = F.col("chunk_order").bitwiseAND((1 << RUN_BITS) - 1).cast("int").alias("place")
    kind = "store_id string, term string, run bigint, most double, places array<smallint>, tfs array<int>, squares array<bigint>"
    rows = store.select("store_id", run, place, "terms", "counts").groupBy("store_id", "run").applyInArrow(_index_run, kind)
    in_order = rows.repartitionByRange("term", "store_id", "run").sortWithinPartitions("term", "store_id", "run")
    norms = F.transform("squares", lambda n: F.sqrt(n.cast("double"))).alias("norms")
    wide = [F.col("places").cast("array<int>").alias("places"), F.col("tfs").cast("array<bigint>").alias("tfs")]
    return in_order.select("store_id", "term", "run", "most", *wide, norms)


def vectors_of(index: DataFrame, terms: list[str]) -> DataFrame:
    """Chunk vectors reduced to some terms, from the index alone."""
    if len(terms) <= LISTED_TERMS:
        rows = index.where(F.col("term").isin(terms))
    else:
        listed = index.sparkSession.createDataFrame([(t,) for t in terms], "term string")
        rows = index.where(F.col("term").between(min(terms), max(terms))).join(listed, "term", "left_semi")
    sums = F.transform("places", lambda _, i: F.aggregate(F.slice("places", 1, i + 1), F.lit(0), lambda a, x: a + x))
    zipped = F.arrays_zip(sums.alias("place"), F.col("tfs"), F.col("norms"))
    held = rows.select("store_id", "term", "run", F.inline(zipped).alias("place", "tf", "norm"))
    order = (F.shiftleft("run", RUN_BITS) + F.col("place")).alias("chunk_order")
    member = F.struct("term", "tf")
    by_chunk = held.groupBy("store_id", order).agg(F.max("norm").alias("norm"), F.collect_list(member).alias("m"))
    return by_chunk.select(*_CHUNK, "norm", F.col("m.term").alias("terms"), F.col("m.tf").alias("counts"))


def _slices(questions: DataFrame) -> Iterator[scoring.Questions]:
    """The questions' vectors, dealt into slices that are collected one at a time."""
    embedded = embed_questions(questions)
    n = -(-questions.count() // SLICE)
    slice_of = F.pmod(F.xxhash64("question_id"), F.lit(max(n, 1)))
    for i in range(n):
        rows = (embedded if n == 1 else embedded.where(slice_of == i)).collect()
        if rows:
            yield scoring.Questions(rows)


def _scan(store: DataFrame, questions: DataFrame, scorer: Callable) -> DataFrame:
    """What `scorer` finds for each slice of questions in the store, or in its index."""
    spark = store.sparkSession
    ship(spark)
    kind = f"store_id string, question_id {questions.schema['question_id'].dataType.simpleString()}, chunk_order bigint, score double"
    indexed = "tfs" in store.columns
    found = None
    for asked in _slices(questions):
        chunks = vectors_of(store, asked.terms) if indexed else store
        part = chunks.select(*_CHUNK, "norm", "terms", "counts").mapInArrow(scorer(asked), kind)
        found = part if found is None else found.unionByName(part)
    return spark.createDataFrame([], kind) if found is None else found


def _best(scored: DataFrame, k: int) -> DataFrame:
    """The k best per store and question, higher scores and then earlier chunks first."""
    order = W.partitionBy(*_ASKED).orderBy(F.desc("score"), "chunk_order")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def similar(store: DataFrame, questions: DataFrame, min_score: float) -> DataFrame:
    """All (question, chunk) pairs sharing a term and with a cosine of at least min_score."""
    return _scan(store, questions, lambda asked: scoring.reaching(asked, min_score))


def matches(store: DataFrame, questions: DataFrame, k: int) -> DataFrame:
    """The k best chunks per store and question among those that share a term with it."""
    return _best(_scan(store, questions, lambda asked: scoring.best(asked, k)), k)


def search(
    store: DataFrame, questions: DataFrame, k: int = 1
) -> DataFrame:
    """Top k per store and question: (store_id, question_id, rank, chunk_order, score).

    When fewer than k chunks match, the store's first chunks follow with score 0.
    """
    found = matches(store, questions, k)
    in_order = W.partitionBy("store_id").orderBy("chunk_order")
    head = (
        store.select(*_CHUNK)
        .withColumn("place", F.row_number().over(in_order))
        .where(F.col("place") <= k)
    )
    places = questions.select("question_id", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("place"))
    padding = places.join(F.broadcast(head), "place").select(
        *_ASKED, "chunk_order", F.lit(0.0).alias("score")
    )
    both = found.select(*_ASKED, "chunk_order", "score").unionByName(padding)
    once = both.groupBy(*_ASKED, "chunk_order").agg(F.max("score").alias("score"))
    return _best(once, k).select(*_ASKED, "rank", "chunk_order", "score")


def cited_matches(store: DataFrame, questions: DataFrame, k: int) -> DataFrame:
    """Matches with their chunk's text and metadata. The matches are k per store and question, which
    Spark broadcasts if they turn out small."""
    chunk = store.select(*_CHUNK, "doc_id", "version", "effective_date", "source_uri", "text")
    return chunk.join(matches(store, questions, k), _CHUNK)


def answer(
    store: DataFrame, questions: DataFrame, stores=("kb",)
) -> DataFrame:
    """Best chunk's text with its citation; the fallback where nothing shares a term."""
    cited = cited_matches(store, questions, 1)
    asked = questions.withColumn("store_id", F.explode(F.array(*[F.lit(s) for s in stores])))
    return asked.join(cited, _ASKED, "left").select(
        *_ASKED,
        F.coalesce("text", F.lit(NO_ANSWER_TEXT)).alias("answer"),
        F.coalesce("doc_id", F.lit(NO_ANSWER_DOC)).alias("cited_doc"),
        F.col("version").alias("cited_version"),
        F.col("effective_date").alias("cited_date"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def hit_at_k(
    store: DataFrame, questions: DataFrame, expected: DataFrame, k: int
) -> DataFrame:
    """Per question with an expected doc (question_id, expect_doc): is it among its k best?"""
    found = cited_matches(store, questions, k).select(
        "question_id", F.col("doc_id").alias("expect_doc")
    )
    marked = found.distinct().withColumn("hit", F.lit(True))
    return expected.join(marked, ["question_id", "expect_doc"], "left").select(
        "question_id", "expect_doc", F.coalesce("hit", F.lit(False)).alias("hit")
    )


def citation_age_days(answers: DataFrame, today: Column) -> DataFrame:
    """Age of each citation that has a readable date."""
    date = F.try_to_date("cited_date", "yyyy-MM-dd")
    aged = answers.withColumn("age_days", F.datediff(today, date).cast("bigint"))
    return aged.where(F.col("age_days").isNotNull())


def age_p95(ages: DataFrame) -> DataFrame:
    return ages.agg(
        F.count(F.lit(1)).alias("n_citations"),
        F.percentile("age_days", 0.95).alias("age_days_p95"),
    )
