"""Registered queries: each operator of the job run alone on a view of the driver tables,
next to a DuckDB statement computing the same rows the literal way (question x answer pairs,
question x tag rows), which only the small check data can afford.

Every query reads whole tables; no key subsets, samples or row caps.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qalens.functions.render import count_line, mean_time_line, parse_mean_time_line
from qalens.operators import aggregates as agg
from qalens.operators import nested
from qalens.operators.joins import questions_with_tags
from qalens.plans import reports
from qalens.plans.oracle import (CUSTOMER_ANSWERS_SQL, CUSTOMERS_SQL, EVENT_ANSWERS_SQL, EVENTS_SQL, ORDER_ANSWERS_SQL, ORDERS_SQL, TOP_TAGS_SQL,
                                 answers_nested_sql, mean_time_sql, whole_questions_sql)
from qalens.plans.oracle import with_views as _with
from qalens.sources import ingest_views, views

Query = Callable[[SparkSession, str], DataFrame]

#: Answers an array holds in the registered nested queries, so that also small tables have questions of several arrays.
REGISTERED_SEGMENT = 4

# --- Spark side ----------------------------------------------------------------------------

def _events(spark: SparkSession, sf_dir: str):
    return views.events_view(spark, sf_dir)


def _orders(spark: SparkSession, sf_dir: str):
    return views.orders_view(spark, sf_dir)


def _mean_time(view, threshold: int) -> Query:
    return lambda spark, sf: reports.mean_time_answer(view(spark, sf), threshold)


def _top_tags(view) -> Query:
    return lambda spark, sf: reports.top_tags(view(spark, sf))


def _render_mean_time(spark: SparkSession, sf: str) -> DataFrame:
    # The sink's own line function, its whole line parsed back: engines print doubles unlike.
    report = reports.mean_time_answer(_events(spark, sf), views.EVENTS_THRESHOLD)
    return parse_mean_time_line(report.select(mean_time_line(F.col("tag"), F.col("mean_minutes"), F.col("probability")).alias("line")))


def _render_top_tags(spark: SparkSession, sf: str) -> DataFrame:
    report = reports.top_tags(_events(spark, sf))
    return report.select(count_line(F.col("tag"), F.col("n")).alias("line"))


def _pairs(view):
    return lambda spark, sf: agg.answered_pairs(view(spark, sf))


def queries() -> dict[str, Query]:
    ev = _events
    T = views.EVENTS_THRESHOLD
    q: dict[str, Query] = {
        # composite reports
        "mean_time_answer": _mean_time(ev, T),
        "mean_time_answer_orders": _mean_time(_orders, views.ORDERS_THRESHOLD),
        "top_tags": _top_tags(ev),
        "top_tags_orders": _top_tags(_orders),
        # joins
        "questions_with_tags": lambda spark, sf: questions_with_tags(ev(spark, sf)),
        "answered_questions": lambda spark, sf: agg.answered_questions(ev(spark, sf)),
        # per question
        "question_weights": lambda spark, sf: agg.question_weights(ev(spark, sf).questions),
        "first_answer_minutes": lambda spark, sf: agg.first_answer_minutes(ev(spark, sf)),
        "first_answer_minutes_orders": lambda spark, sf: agg.first_answer_minutes(_orders(spark, sf)),
        "answers_per_question": lambda spark, sf: agg.answers_per_question(ev(spark, sf)),
        "tags_per_question": lambda spark, sf: agg.render_tag_list(agg.tags_per_question(ev(spark, sf))),
        "explode_tags": lambda spark, sf: agg.answered_tags(ev(spark, sf)),
        # per tag
        "answered_by_tag": lambda spark, sf: agg.answered_by_tag(agg.answered_tags(ev(spark, sf))),
        "fast_answers": lambda spark, sf: agg.fast_answers(_pairs(ev)(spark, sf), T),
        "fast_minutes_by_tag": lambda spark, sf: agg.fast_minutes_by_tag(_pairs(ev)(spark, sf), T),
        "fast_count_by_tag": lambda spark, sf: agg.fast_count_by_tag(_pairs(ev)(spark, sf), T),
        "mean_fast_minutes": lambda spark, sf: agg.mean_fast_minutes(_pairs(ev)(spark, sf), T),
        "fast_answer_probability": lambda spark, sf: agg.fast_answer_probability(_pairs(ev)(spark, sf), T),
        "tag_counts": lambda spark, sf: agg.tag_counts(agg.answered_tags(ev(spark, sf))),
        # sinks (rendered lines)
        "render_mean_time_answer": _render_mean_time,
        "render_top_tags": _render_top_tags,
    }
    od = _orders
    q.update({
        # the same operators on the orders view (answers hang off their question id)
        "questions_with_tags_orders": lambda spark, sf: questions_with_tags(od(spark, sf)),
        "answered_questions_orders": lambda spark, sf: agg.answered_questions(od(spark, sf)),
        "question_weights_orders": lambda spark, sf: agg.question_weights(od(spark, sf).questions),
        "answers_per_question_orders": lambda spark, sf: agg.answers_per_question(od(spark, sf)),
        "tags_per_question_orders": lambda spark, sf: agg.render_tag_list(agg.tags_per_question(od(spark, sf))),
        "explode_tags_orders": lambda spark, sf: agg.answered_tags(od(spark, sf)),
        "fast_answers_orders": lambda spark, sf: agg.fast_answers(_pairs(od)(spark, sf), views.ORDERS_THRESHOLD),
    })
    seg, cu = REGISTERED_SEGMENT, views.customers_view
    q.update({
        # the nested view: answers as arrays of bounded segments, tags as an array that is un-nested
        "answers_nested": lambda spark, sf: nested.render_answers(nested.answers_nested(ev(spark, sf), seg)),
        "answers_nested_orders": lambda spark, sf: nested.render_answers(nested.answers_nested(od(spark, sf), seg)),
        "first_answer_minutes_nested": lambda spark, sf: nested.first_answer_minutes_nested(ev(spark, sf), seg),
        "first_answer_minutes_nested_orders": lambda spark, sf: nested.first_answer_minutes_nested(od(spark, sf), seg),
        "explode_tags_nested": lambda spark, sf: nested.unnested_tags(ev(spark, sf)),
        "whole_questions_orders": lambda spark, sf: nested.render_questions(nested.whole_questions(od(spark, sf), seg)),
        # question ids that repeat (C10)
        "question_weights_customers": lambda spark, sf: agg.question_weights(cu(spark, sf).questions),
        "first_answer_minutes_customers": lambda spark, sf: agg.first_answer_minutes(cu(spark, sf)),
        "first_answer_minutes_nested_customers": lambda spark, sf: nested.first_answer_minutes_nested(cu(spark, sf), seg),
        "answers_nested_customers": lambda spark, sf: nested.render_answers(nested.answers_nested(cu(spark, sf), seg)),
        "explode_tags_nested_customers": lambda spark, sf: nested.unnested_tags(cu(spark, sf)),
        "whole_questions_customers": lambda spark, sf: nested.render_questions(nested.whole_questions(cu(spark, sf), seg)),
        "mean_time_answer_customers": _mean_time(cu, views.ORDERS_THRESHOLD),
    })
    q.update(ingest_views.queries())
    return q


def oracle_sql() -> dict[str, str]:
    ev, od = EVENTS_SQL, ORDERS_SQL
    fast = "minutes < 1440"
    sql = {
        "mean_time_answer": _with(ev, mean_time_sql(1440)),
        "mean_time_answer_orders": _with(od, mean_time_sql(43200)),
        "top_tags": _with(ev, TOP_TAGS_SQL),
        "top_tags_orders": _with(od, TOP_TAGS_SQL),
        "questions_with_tags": _with(ev, "SELECT id, tag, count(*) AS n FROM qt GROUP BY id, tag"),
        "answered_questions": _with(ev, "SELECT DISTINCT id FROM pairs"),
        "question_weights": _with(ev, "SELECT id, count(*) AS copies, min(epoch_us(creation_ts)) AS creation_us "
                                      "FROM q GROUP BY id"),
        "first_answer_minutes": _with(ev, "SELECT m.id, c.copies, m.minutes FROM m JOIN "
                                          "(SELECT id, count(*) AS copies FROM q GROUP BY id) c ON c.id = m.id"),
        "first_answer_minutes_orders": _with(od, "SELECT m.id, c.copies, m.minutes FROM m JOIN "
                                                 "(SELECT id, count(*) AS copies FROM q GROUP BY id) c ON c.id = m.id"),
        "answers_per_question": _with(ev, "SELECT question_id AS id, count(*) AS n_answers, "
                                          "min(epoch_us(creation_ts)) AS first_us, max(epoch_us(creation_ts)) AS last_us "
                                          "FROM a WHERE question_id IN (SELECT id FROM q) GROUP BY question_id"),
        "tags_per_question": _with(ev, "SELECT id, string_agg(tag || ':' || n, '|' ORDER BY tag) AS tag_list FROM "
                                       "(SELECT id, tag, count(*) AS n FROM qt GROUP BY id, tag) GROUP BY id"),
        "explode_tags": _with(ev, "SELECT id, tag, count(*) AS n FROM pairs GROUP BY id, tag"),
        "answered_by_tag": _with(ev, "SELECT tag, count(*) AS answered FROM pairs GROUP BY tag"),
        "fast_answers": _with(ev, f"SELECT id, tag, count(*) AS n, minutes FROM pairs WHERE {fast} "
                                  "GROUP BY id, tag, minutes"),
        "fast_minutes_by_tag": _with(ev, f"SELECT tag, CAST(sum(minutes) AS BIGINT) AS fast_minutes FROM pairs "
                                         f"WHERE {fast} GROUP BY tag"),
        "fast_count_by_tag": _with(ev, f"SELECT tag, count(*) AS fast FROM pairs WHERE {fast} GROUP BY tag"),
        "mean_fast_minutes": _with(ev, f"SELECT tag, CAST(sum(minutes) AS BIGINT) // count(*) AS mean_minutes "
                                       f"FROM pairs WHERE {fast} GROUP BY tag"),
        "fast_answer_probability": _with(ev, f"SELECT tag, (count(*) FILTER (WHERE {fast}))::DOUBLE / count(*) "
                                             f"AS probability FROM pairs GROUP BY tag "
                                             f"HAVING count(*) FILTER (WHERE {fast}) > 0"),
        "tag_counts": _with(ev, "SELECT tag, count(*) AS n FROM pairs GROUP BY tag"),
        "render_mean_time_answer": _with(ev, mean_time_sql(1440)),
        "render_top_tags": _with(ev, "SELECT '(' || tag || ',' || n || ')' AS line FROM (" + TOP_TAGS_SQL + ")"),
    }
    for name in ("questions_with_tags", "answered_questions", "question_weights", "answers_per_question",
                 "tags_per_question", "explode_tags"):
        sql[f"{name}_orders"] = sql[name].replace(ev, od, 1)
    sql["fast_answers_orders"] = _with(od, "SELECT id, tag, count(*) AS n, minutes FROM pairs WHERE minutes < 43200 "
                                           "GROUP BY id, tag, minutes")
    cu, seg = CUSTOMERS_SQL, REGISTERED_SEGMENT
    for name in ("question_weights", "first_answer_minutes"):
        sql[f"{name}_customers"] = sql[name].replace(ev, cu, 1)
    for view, body, answers in (("", ev, EVENT_ANSWERS_SQL), ("_orders", od, ORDER_ANSWERS_SQL), ("_customers", cu, CUSTOMER_ANSWERS_SQL)):
        sql[f"answers_nested{view}"] = answers_nested_sql(answers, seg)
        sql[f"first_answer_minutes_nested{view}"] = sql["first_answer_minutes"].replace(ev, body, 1)
    sql["whole_questions_orders"] = _with(od, whole_questions_sql(ORDER_ANSWERS_SQL, seg))
    sql["whole_questions_customers"] = _with(cu, whole_questions_sql(CUSTOMER_ANSWERS_SQL, seg))
    sql["explode_tags_nested"] = sql["explode_tags"]
    sql["explode_tags_nested_customers"] = sql["explode_tags"].replace(ev, cu, 1)
    sql["mean_time_answer_customers"] = _with(cu, mean_time_sql(43200))
    sql.update(ingest_views.oracle_sql())
    return sql
