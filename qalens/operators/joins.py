"""Equi-joins of the job: questions with tags (J1) and questions with answers (J2).

Both joins are inner (a question without a tag, or without an answer, leaves the report).
Neither join ever pairs raw rows of a hot key with each other:

* tags are pre-aggregated to ``(question_id, tag) -> cnt`` with a map-side partial
  aggregate, so a question carrying a third of all tag rows reaches the join as at most one
  row per distinct tag; question copies are counted per id the same way;
* answers are attached through the nearest-answer scan (``operators.nearest``), which is
  range-partitioned and never forms question x answer pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qalens.model import QAData


def tag_multiset(tags: DataFrame) -> DataFrame:
    """``id, tag, cnt``: how often each tag row occurs for a question (duplicates are kept as a count)."""
    return tags.groupBy(F.col("question_id").alias("id"), "tag").agg(F.count(F.lit(1)).alias("cnt"))


def question_copies(questions: DataFrame) -> DataFrame:
    """``id, copies``: how many question rows carry each id."""
    return questions.groupBy("id").agg(F.count(F.lit(1)).alias("copies"))


def questions_with_tags(data: QAData) -> DataFrame:
    """J1 — ``id, tag, n`` with ``n`` = copies x tag rows (the rows the inner join would yield)."""
    return (tag_multiset(data.tags)
            .join(question_copies(data.questions), "id")
            .select("id", "tag", (F.col("copies") * F.col("cnt")).alias("n")))


def with_tags(per_question: DataFrame, tags: DataFrame) -> DataFrame:
    """Attach the tag multiset to a one-row-per-id frame that has a ``copies`` column.

    Returns the frame's columns plus ``tag`` and the weight ``n`` = copies x tag rows.
    """
    return (per_question.join(tag_multiset(tags), "id")
            .withColumn("n", F.col("copies") * F.col("cnt"))
            .drop("cnt"))


def tagged_ids(tags: DataFrame) -> DataFrame:
    """Distinct ids having at least one tag."""
    return tags.select(F.col("question_id").alias("id")).distinct()
