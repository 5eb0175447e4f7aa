"""Per-question and per-tag aggregates (A1-A12).

Every aggregate runs as a partial (map-side) plus final hash aggregate, so a hot tag or a
hot question id is combined inside each task before it is shuffled. Lists are only built
per question over *distinct* tags (a multiset ``tag -> n``), never over raw rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qalens.functions.timing import DAY_MINUTES, epoch_micros, int_div, whole_minutes
from qalens.model import QAData
from qalens.operators.joins import question_copies, tag_multiset, tagged_ids, with_tags
from qalens.operators.nearest import answer_scan


def _scan(data: QAData, partitions: int | None) -> DataFrame:
    return answer_scan(data.questions, data.answers, partitions, data.materialize_scan, data.scan_rows, data.scratch)


# --- per question ---------------------------------------------------------------------------

def question_weights(questions: DataFrame) -> DataFrame:
    """A3 — ``id, copies, creation_us``: copies per id and the earliest creation instant."""
    return questions.groupBy("id").agg(
        F.count(F.lit(1)).alias("copies"),
        F.min(epoch_micros(F.col("creation_ts"))).alias("creation_us"))


def first_answer_minutes(data: QAData, partitions: int | None = None) -> DataFrame:
    """A5 — ``id, copies, minutes`` for answered questions.

    ``minutes`` = whole minutes between the question and its nearest answer (before or after);
    the question of a repeated id is its earliest copy (C10).
    """
    scan = _scan(data, partitions)
    return (scan.groupBy("id")
            .agg(F.count(F.lit(1)).alias("copies"), whole_minutes(F.min_by("nearest_us", "q_us")).alias("minutes"))
            .where(F.col("minutes").isNotNull()))


def _usable_questions(data: QAData) -> DataFrame:
    return data.questions.where(F.col("creation_ts").isNotNull()).select("id", "link")


def answers_by_link(data: QAData) -> DataFrame:
    """``link, n_answers, first_us, last_us``: a hot link is combined inside each task first."""
    us = epoch_micros(F.col("creation_ts"))
    return data.answers.where(F.col("creation_ts").isNotNull() & F.col("link").isNotNull()).groupBy("link").agg(
        F.count(F.lit(1)).alias("n_answers"), F.min(us).alias("first_us"), F.max(us).alias("last_us"))


def answers_per_question(data: QAData) -> DataFrame:
    """A2 — ``id, n_answers, first_us, last_us`` for questions with at least one answer.

    The answers of an id are the answers of its link (the same for all its copies). No latency is
    asked for, so answers are aggregated by link and joined: no window, no question x answer pairs.
    """
    return (_usable_questions(data).distinct().join(answers_by_link(data), "link").groupBy("id")
            .agg(F.sum("n_answers").alias("n_answers"), F.min("first_us").alias("first_us"),
                 F.max("last_us").alias("last_us")))


def answered_ids(data: QAData) -> DataFrame:
    """``id, copies`` of questions with an answer; ``copies`` counts all copies of the id."""
    links = answers_by_link(data).select("link", F.lit(True).alias("hit"))
    per_link = _usable_questions(data).groupBy("id", "link").agg(F.count(F.lit(1)).alias("copies"))
    return (per_link.join(links, "link", "left").groupBy("id")
            .agg(F.sum("copies").alias("copies"), F.max("hit").alias("hit"))
            .where(F.col("hit")).select("id", "copies"))


def answered_questions(data: QAData) -> DataFrame:
    """J2 — ``id`` of questions with at least one tag and at least one answer."""
    return answered_ids(data).select("id").join(tagged_ids(data.tags), "id", "left_semi")


def tags_per_question(data: QAData) -> DataFrame:
    """A1 — nested ``id, tags ARRAY<STRUCT<tag, n>>`` sorted by tag, duplicates kept as ``n``.

    ``n`` = copies x tag rows. The list holds distinct tags only, so its length is bounded by
    the tag vocabulary, not by how many rows a question has.
    """
    weighted = with_tags(question_copies(data.questions), data.tags)
    return weighted.groupBy("id").agg(
        F.array_sort(F.collect_list(F.struct("tag", "n"))).alias("tags"))


def render_tag_list(nested: DataFrame) -> DataFrame:
    """``id, tag_list``: ``tag:n`` entries joined with ``|`` (a flat text form of A1)."""
    return nested.select(
        "id",
        F.array_join(F.transform("tags", lambda t: F.concat(t["tag"], F.lit(":"), t["n"].cast("string"))), "|")
        .alias("tag_list"))


def full_questions(data: QAData, partitions: int | None = None) -> DataFrame:
    """Nested answered + tagged questions: ``id, copies, minutes, n_answers, tags``.

    The answer list of each question is summarised (count, nearest minutes); the lists themselves are
    rows of bounded segments (``operators.nested``), so no question needs all of its answers in one row.
    """
    scan = _scan(data, partitions)
    per_question = (scan.groupBy("id")
                    .agg(F.count(F.lit(1)).alias("copies"), whole_minutes(F.min_by("nearest_us", "q_us")).alias("minutes"),
                         F.max("n_answers").alias("n_answers"))
                    .where(F.col("minutes").isNotNull()))
    tags = tag_multiset(data.tags).groupBy("id").agg(F.array_sort(F.collect_list(F.struct("tag", "cnt"))).alias("cnts"))
    weighted = F.transform("cnts", lambda t: F.struct(t["tag"].alias("tag"), (t["cnt"] * F.col("copies")).alias("n")))
    return per_question.join(tags, "id").select("id", "copies", "minutes", "n_answers", weighted.alias("tags"))


def explode_tags(nested: DataFrame) -> DataFrame:
    """A4 on a nested frame: un-nest ``tags`` to one row per (question, tag) with its weight ``n``."""
    return nested.select("id", F.inline("tags"))


def answered_tags(data: QAData) -> DataFrame:
    """A4 — ``id, tag, n``: one row per (answered question, tag), without building the nested lists first."""
    return with_tags(answered_ids(data), data.tags).select("id", "tag", "n")


# --- per (question, tag) pair and per tag ------------------------------------------------------

def answered_pairs(data: QAData, partitions: int | None = None) -> DataFrame:
    """``id, tag, n, minutes``: answered questions with their tags; ``n`` = weight of the pair."""
    return (with_tags(first_answer_minutes(data, partitions), data.tags)
            .select("id", "tag", "n", "minutes"))


def _fast(threshold: int) -> F.Column:
    return F.col("minutes") < F.lit(threshold)


def answered_by_tag(pairs: DataFrame) -> DataFrame:
    """A6 — ``tag, answered``: weighted count of answered (question, tag) pairs (``id, tag, n``)."""
    return pairs.groupBy("tag").agg(F.sum("n").alias("answered"))


def fast_answers(pairs: DataFrame, threshold: int = DAY_MINUTES) -> DataFrame:
    """A7 — pairs answered strictly within ``threshold`` minutes."""
    return pairs.where(_fast(threshold))


def fast_minutes_by_tag(pairs: DataFrame, threshold: int = DAY_MINUTES) -> DataFrame:
    """A8 — ``tag, fast_minutes``: weighted sum of fast minutes (tags with a fast pair only)."""
    return fast_answers(pairs, threshold).groupBy("tag").agg(
        F.sum(F.col("n") * F.col("minutes")).alias("fast_minutes"))


def fast_count_by_tag(pairs: DataFrame, threshold: int = DAY_MINUTES) -> DataFrame:
    """A9 — ``tag, fast``: weighted count of fast pairs (tags with a fast pair only)."""
    return fast_answers(pairs, threshold).groupBy("tag").agg(F.sum("n").alias("fast"))


def mean_fast_minutes(pairs: DataFrame, threshold: int = DAY_MINUTES) -> DataFrame:
    """A10 — ``tag, mean_minutes``: integer mean of fast minutes."""
    return fast_answers(pairs, threshold).groupBy("tag").agg(
        int_div(F.sum(F.col("n") * F.col("minutes")), F.sum("n")).alias("mean_minutes"))


def fast_answer_probability(pairs: DataFrame, threshold: int = DAY_MINUTES) -> DataFrame:
    """A11 — ``tag, probability``: fast pairs / answered pairs (tags with a fast pair only)."""
    fast_n = F.sum(F.when(_fast(threshold), F.col("n")))
    return (pairs.groupBy("tag")
            .agg((fast_n.cast("double") / F.sum("n").cast("double")).alias("probability"))
            .where(F.col("probability").isNotNull()))


def tag_counts(pairs: DataFrame) -> DataFrame:
    """A12 — ``tag, n``: the same count under the report's column name."""
    return answered_by_tag(pairs).withColumnRenamed("answered", "n")
