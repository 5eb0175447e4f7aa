"""Nested question view: answers as arrays of bounded segments (A2, A5 on arrays), tags as an array that is un-nested (A4).

The answers of a link (in the dump layout: of a question) are numbered by time and cut into segments of ``SEGMENT``; a
row holds one segment, so a question of any number of answers is many rows and no array is unbounded.

The numbers come from a range partitioning by ``(link, ts, ...)`` with a tiebreaker, written with its partition number
like the nearest-answer scan's input: a link that holds a third of all answers is cut into many ranges, and what the
ranges before one hold of its first link is carried in a frame of at most two rows a range.

Questions lie in the same order, so each knows how many answers come before it, and with that the one or two segments
that hold its neighbours. The nested latency joins a question with just those: never all pairs of a link, which in the
events view (one user's purchases answer all of the user's views) would be quadratic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qalens.functions.timing import epoch_micros, int_div, whole_minutes
from qalens.model import QAData
from qalens.operators.aggregates import explode_tags, full_questions
from qalens.operators.joins import tag_multiset
from qalens.operators.nearest import boundary_summary, materialize, partition_count

#: Answers in one array.
SEGMENT = 256


def numbered_answers(data: QAData, partitions: int | None = None) -> DataFrame:
    """``link, ts, is_q, id, score, before``: all usable questions and answers, ``before`` = answers of the link before the row.

    Answers are in order of (ts, score); those at the instant of a question come before it. Runs one job when called,
    which writes the ranges (two where the inputs are dear to read).
    """
    id_type = data.questions.schema["id"].dataType
    questions = data.questions.select("id", "link", "creation_ts", F.lit(True).alias("is_q"), F.lit(None).cast("int").alias("score"))
    answers = data.answers.select(F.lit(None).cast(id_type).alias("id"), "link", "creation_ts", F.lit(False).alias("is_q"), F.col("score").cast("int").alias("score"))
    narrow = questions.unionByName(answers).where(F.col("creation_ts").isNotNull() & F.col("link").isNotNull()) \
        .select("link", epoch_micros(F.col("creation_ts")).alias("ts"), "is_q", "id", "score")
    if data.materialize_scan:
        narrow = materialize(narrow, "nested-input", data.scratch)
    n_parts = partition_count(narrow, partitions)
    ranged = narrow.withColumn("tb", F.monotonically_increasing_id()).repartitionByRange(n_parts, "link", "ts", "is_q", "score", "id", "tb") \
        .withColumn("pid", F.spark_partition_id()).drop("tb")
    ranged = materialize(ranged, "nested-ranges", data.scratch)

    is_answer = F.when(~F.col("is_q"), F.lit(1))
    in_order = Window.partitionBy("pid", "link").orderBy("ts", "is_q", "score", "id")
    within = ranged.repartition(n_parts, "pid", "link").withColumn(
        "within", F.coalesce(F.count(is_answer).over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    earlier = Window.partitionBy("link").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    carried = boundary_summary(ranged).select("pid", "link", F.sum("n").over(earlier).alias("carried")).where("carried > 0")
    return within.join(F.broadcast(carried), ["pid", "link"], "left") \
        .select("link", "ts", "is_q", "id", "score", (F.col("within") + F.coalesce("carried", F.lit(0))).alias("before"))


def answer_segments(numbered: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """``link, segment, answers ARRAY<STRUCT<ts, score>>``: at most ``segment`` answers a row, in order of (ts, score)."""
    return numbered.where(~F.col("is_q")).groupBy("link", int_div(F.col("before"), segment).alias("segment")).agg(
        F.array_sort(F.collect_list(F.struct("ts", "score"))).alias("answers"))


def answers_nested(data: QAData, segment: int = SEGMENT, partitions: int | None = None) -> DataFrame:
    """A2 — ``link, segment, answers`` of the links that have a question (in the dump layout a link is the question's id)."""
    numbered = numbered_answers(data, partitions)
    asked = numbered.where("is_q").select("link").distinct()
    return answer_segments(numbered, segment).join(asked, "link", "left_semi")


def _answer_list() -> Column:
    entry = F.transform("answers", lambda a: F.concat(a["ts"].cast("string"), F.lit(":"), F.coalesce(a["score"].cast("string"), F.lit(""))))
    return F.array_join(entry, "|").alias("answer_list")


def render_answers(nested: DataFrame) -> DataFrame:
    """``link, segment, answer_list``: ``epoch micros:score`` entries joined with ``|`` (a flat text form of A2)."""
    return nested.select("link", "segment", _answer_list())


def first_answer_minutes_nested(data: QAData, segment: int = SEGMENT, partitions: int | None = None) -> DataFrame:
    """A5 on arrays — ``id, copies, minutes``: the least distance to an answer in the arrays around the question.

    The same rows as ``first_answer_minutes``: an id's earliest copy is its question, and weighs as many as it has copies.
    """
    numbered = numbered_answers(data, partitions)
    questions = numbered.where("is_q").groupBy("id").agg(
        F.count(F.lit(1)).alias("copies"), F.min("ts").alias("q_ts"), F.min_by("before", "ts").alias("before"), F.min_by("link", "ts").alias("link"))
    last, following = (int_div(c, segment) for c in (F.greatest(F.col("before") - 1, F.lit(0)), F.col("before")))
    around = questions.withColumn("segment", F.explode(F.array_distinct(F.array(last, following))))
    nearest = F.array_min(F.transform("answers", lambda a: F.abs(a["ts"] - F.col("q_ts"))))
    # A segment after the last answer doesn't exist: the inner join drops it, and with it questions without answers.
    return around.join(answer_segments(numbered, segment), ["link", "segment"]).select("id", "copies", nearest.alias("nearest")) \
        .groupBy("id").agg(F.max("copies").alias("copies"), whole_minutes(F.min("nearest")).alias("minutes"))


def whole_questions(data: QAData, segment: int = SEGMENT, partitions: int | None = None) -> DataFrame:
    """The nested question — ``id, segment, copies, creation_us, answers, tags``, for answered and tagged questions.

    A question is its rows in order of ``segment``: each holds the next ``segment`` answers, the first one also the tags
    (``ARRAY<STRUCT<tag, n>>``, each tag once with its weight) and the date. Only for tables whose answers carry the question's id
    (link = id): where questions share a link, repeating its answers under each of them would be all pairs.
    """
    questions = data.questions.where(F.col("creation_ts").isNotNull()).groupBy("id", "link").agg(
        F.count(F.lit(1)).alias("copies"), F.min(epoch_micros(F.col("creation_ts"))).alias("creation_us")).where(F.col("id") == F.col("link"))
    tags = tag_multiset(data.tags).groupBy("id").agg(F.array_sort(F.collect_list(F.struct("tag", "cnt"))).alias("counts"))
    heads = questions.join(tags, "id").select(
        F.col("id").alias("link"), "copies", "creation_us",
        F.transform("counts", lambda t: F.struct(t["tag"].alias("tag"), (t["cnt"] * F.col("copies")).alias("n"))).alias("tags"))
    first = F.col("segment") == 0
    return answers_nested(data, segment, partitions).join(heads, "link").select(
        F.col("link").alias("id"), "segment", "copies", F.when(first, F.col("creation_us")).alias("creation_us"), "answers",
        F.when(first, F.col("tags")).alias("tags"))


def render_questions(questions: DataFrame) -> DataFrame:
    """The rows of ``whole_questions`` with both lists as text (``tag:n`` and ``epoch micros:score``, joined with ``|``)."""
    tag = F.transform("tags", lambda t: F.concat(t["tag"], F.lit(":"), t["n"].cast("string")))
    return questions.select("id", "segment", "copies", "creation_us", _answer_list(), F.array_join(tag, "|").alias("tag_list"))


def unnested_tags(data: QAData, partitions: int | None = None) -> DataFrame:
    """A4 on the nested view — ``id, tag, n``: the tag array of every answered question, one row an entry with its weight."""
    return explode_tags(full_questions(data, partitions))
