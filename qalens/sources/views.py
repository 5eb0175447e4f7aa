"""Q&A-shaped views over the driver's parquet tables.

``events_view``: view events are questions; a user's purchases answer every view event of
that user (linked by ``user_id``, never expanded into pairs); two tags per view event come
from the ``k`` property: ``'k' || (k % 10)`` and ``'k' || (k div 10)``.

``orders_view``: orders are questions, their line items are answers (shipped date), and
each line item tags its order with the brand of its part.

``customers_view``: the orders view with every order asked by its customer, so question ids repeat
(C10): a customer is one question, dated by the first order and weighing as many as there are orders.

All views are column scans of parquet, which the nearest-answer scan re-reads for its
range sampling instead of copying them (``materialize_scan=False``). The events view also
hands the scan its questions and answers as one frame read in one pass (``scan_rows``).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qalens.model import QAData, instant

# Latency thresholds used with each view (minutes).
EVENTS_THRESHOLD = 1440
ORDERS_THRESHOLD = 43200


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def view_k(events: DataFrame) -> DataFrame:
    """``event_id, k`` of the view events."""
    return (events.where(F.col("event_type") == "view")
            .select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k")))


def events_questions(events: DataFrame) -> DataFrame:
    return (events.where(F.col("event_type") == "view")
            .select(F.col("event_id").alias("id"), instant("ts").alias("creation_ts"), F.col("user_id").alias("link")))


def events_answers(events: DataFrame) -> DataFrame:
    return (events.where(F.col("event_type") == "purchase")
            .select(F.col("user_id").alias("link"), instant("ts").alias("creation_ts"),
                    F.floor("value").cast("int").alias("score")))


def events_scan_rows(events: DataFrame) -> DataFrame:
    """Questions and answers of the events view as one narrow frame, from one scan."""
    is_q = F.col("event_type") == "view"
    return (events.where(F.col("event_type").isin("view", "purchase"))
            .select(F.when(is_q, F.col("event_id")).alias("id"), F.col("user_id").alias("link"),
                    instant("ts").alias("creation_ts"), is_q.alias("is_q")))


def events_tags(events: DataFrame) -> DataFrame:
    """Both tags of every view event from one scan (a two-element array, exploded)."""
    ones = F.concat(F.lit("k"), (F.col("k") % 10).cast("string"))
    tens = F.concat(F.lit("k"), F.call_function("div", F.col("k"), F.lit(10)).cast("string"))
    return view_k(events).select(F.col("event_id").alias("question_id"), F.explode(F.array(ones, tens)).alias("tag"))


def events_view(spark: SparkSession, sf_dir: str) -> QAData:
    events = table(spark, sf_dir, "events")
    return QAData(events_questions(events), events_answers(events), events_tags(events), materialize_scan=False,
                  scan_rows=events_scan_rows(events))


def orders_view(spark: SparkSession, sf_dir: str) -> QAData:
    orders = table(spark, sf_dir, "orders")
    lineitem = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part")
    questions = orders.select(F.col("o_orderkey").alias("id"), instant("o_orderdate").alias("creation_ts"),
                              F.col("o_orderkey").alias("link"))
    answers = lineitem.select(F.col("l_orderkey").alias("link"), instant("l_shipdate").alias("creation_ts"),
                              F.col("l_quantity").cast("int").alias("score"))
    tags = (lineitem.select("l_orderkey", "l_partkey")
            .join(part.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
            .select(F.col("l_orderkey").alias("question_id"), F.col("p_brand").alias("tag")))
    return QAData(questions, answers, tags, materialize_scan=False)


def customers_view(spark: SparkSession, sf_dir: str) -> QAData:
    """Question ids that repeat: orders, line items and brands under their customer's key."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("id"), "o_orderdate")
    lineitem = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part")
    of_customer = lineitem.select("l_orderkey", "l_partkey", "l_shipdate", "l_quantity").join(
        orders.select("o_orderkey", "id"), F.col("l_orderkey") == F.col("o_orderkey"))
    questions = orders.select("id", instant("o_orderdate").alias("creation_ts"), F.col("id").alias("link"))
    answers = of_customer.select(F.col("id").alias("link"), instant("l_shipdate").alias("creation_ts"), F.col("l_quantity").cast("int").alias("score"))
    tags = of_customer.select("id", "l_partkey").join(part.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey")) \
        .select(F.col("id").alias("question_id"), F.col("p_brand").alias("tag"))
    return QAData(questions, answers, tags, materialize_scan=False)
