"""The two reports (Q1 ``mean_time_answer``, Q2 ``top_tags``) on one per-tag aggregate.

Plan::

    scan    = nearest-answer scan over questions + answers     (range exchange, window exchange)
    R       = scan groupBy id -> copies, minutes               (partial agg, exchange by id)
    T       = tags groupBy (id, tag) -> cnt                    (partial agg, exchange by id, tag)
    per_tag = (R join T on id) groupBy tag -> answered, fast, fast_minutes
                                                               (partial agg, exchange by tag)
    Q1 = per_tag where fast > 0 -> tag, fast_minutes div fast, fast / answered
    Q2 = per_tag -> tag, answered   ordered by answered desc, tag asc

The three conditional sums replace the reference's three aggregations and three joins;
in the job both reports read the same ``per_tag`` frame. Q2 alone needs no latency: its answered
questions come from a join with the answered links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qalens.functions.timing import DAY_MINUTES, int_div
from qalens.model import QAData
from qalens.operators.aggregates import answered_pairs, answered_tags, tag_counts
from qalens.operators.sort import sort_by_count


def per_tag_summary(data: QAData, threshold: int = DAY_MINUTES, partitions: int | None = None) -> DataFrame:
    """``tag, answered, fast, fast_minutes`` over answered (question, tag) pairs, weighted."""
    pairs = answered_pairs(data, partitions)
    is_fast = F.col("minutes") < F.lit(threshold)
    return pairs.groupBy("tag").agg(
        F.sum("n").alias("answered"),
        F.coalesce(F.sum(F.when(is_fast, F.col("n"))), F.lit(0)).alias("fast"),
        F.coalesce(F.sum(F.when(is_fast, F.col("n") * F.col("minutes"))), F.lit(0)).alias("fast_minutes"))


def mean_time_answer_from(summary: DataFrame) -> DataFrame:
    """Q1 from the summary: ``tag, mean_minutes, probability`` for tags with a fast answer."""
    return (summary.where(F.col("fast") > 0)
            .select("tag",
                    int_div(F.col("fast_minutes"), F.col("fast")).alias("mean_minutes"),
                    (F.col("fast").cast("double") / F.col("answered").cast("double")).alias("probability")))


def top_tags_from(summary: DataFrame) -> DataFrame:
    """Q2 from the summary: ``tag, n`` = answered questions per tag, count desc, tag asc."""
    return sort_by_count(summary.select("tag", F.col("answered").alias("n")), "n", "tag")


def mean_time_answer(data: QAData, threshold: int = DAY_MINUTES, partitions: int | None = None) -> DataFrame:
    return mean_time_answer_from(per_tag_summary(data, threshold, partitions))


def top_tags(data: QAData) -> DataFrame:
    """Q2 alone: counts need no latency, so no scan is run."""
    return sort_by_count(tag_counts(answered_tags(data)), "n", "tag")
