"""How cleaning changes the answers to a fixed set of questions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearfold.operators.retrieval import answer
from clearfold.schema import EVALUATION_COLUMNS

BEFORE, AFTER = "before", "after"


def is_correct(text: Column, keywords: Column, stale_marker: Column) -> Column:
    """All keywords occur as substrings, in any case, and the stale marker does not."""
    lowered = F.lower(text)
    complete = F.forall(keywords, lambda k: F.contains(lowered, F.lower(k)))
    stale = F.coalesce(F.contains(lowered, F.lower(stale_marker)), F.lit(False))
    return complete & ~stale


def judge(questions: DataFrame, answers: DataFrame) -> DataFrame:
    """Answers with `correct`, by the questions' expect_keywords and stale_marker."""
    marks = questions.select("question_id", "question", "expect_keywords", "stale_marker")
    judged = marks.join(answers, "question_id")
    verdict = is_correct(F.col("answer"), F.col("expect_keywords"), F.col("stale_marker"))
    return judged.withColumn("correct", verdict).drop("expect_keywords", "stale_marker")


def both_stores(raw: DataFrame, cleaned: DataFrame) -> DataFrame:
    """The stores of both phases as one table, searched in one pass."""
    before = raw.withColumn("store_id", F.lit(BEFORE))
    return before.unionByName(cleaned.withColumn("store_id", F.lit(AFTER)))


def before_after(stores: DataFrame, questions: DataFrame, run_id: str) -> DataFrame:
    """One row per question: the answer from raw and from cleaned records, and whether each is right."""
    answers = answer(stores, questions.select("question_id", "question"), (BEFORE, AFTER))
    judged = judge(questions, answers)

    def of(phase: str, column: str) -> Column:
        return F.max(F.when(F.col("store_id") == phase, F.col(column)))

    return judged.groupBy("question_id", "question").agg(
        F.lit(run_id).alias("run_id"),
        of(BEFORE, "answer").alias("before_answer"),
        of(BEFORE, "cited_doc").alias("before_doc"),
        of(BEFORE, "correct").alias("before_correct"),
        of(AFTER, "answer").alias("after_answer"),
        of(AFTER, "cited_doc").alias("after_doc"),
        of(AFTER, "cited_version").alias("after_version"),
        of(AFTER, "cited_date").alias("after_effective_date"),
        of(AFTER, "correct").alias("after_correct"),
    ).select(EVALUATION_COLUMNS)
