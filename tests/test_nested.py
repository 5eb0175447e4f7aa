"""Nested answer view: bounded arrays in order, hot links over many ranges, latency from arrays, un-nesting in the plan."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from qalens.model import QAData
from qalens.operators.aggregates import first_answer_minutes
from qalens.operators.nested import answers_nested, first_answer_minutes_nested, numbered_answers, render_answers, unnested_tags, whole_questions
from qalens.sources.views import customers_view, events_view, orders_view

BASE = 1_600_000_000_000_000


def frames(spark, questions, answers):
    q = spark.createDataFrame(questions, "id long, us long, link long").selectExpr("id", "timestamp_micros(us) AS creation_ts", "link")
    a = spark.createDataFrame(answers, "link long, us long, score int").selectExpr("link", "timestamp_micros(us) AS creation_ts", "score")
    return QAData(q, a, spark.createDataFrame([(0, "x")], "question_id long, tag string"))


def random_rows(seed, n=3000):
    rnd = random.Random(seed)
    link = lambda: 0 if rnd.random() < 0.4 else rnd.randrange(1, 40)
    questions = [(i, BASE + rnd.randrange(5000) * 1_000_000, link()) for i in range(n // 3)]
    answers = [(link(), BASE + rnd.randrange(5000) * 1_000_000, rnd.choice([None, *range(-3, 9)])) for _ in range(n)]
    return questions, answers + [(0, BASE + 7, 5)] * 500 + [(77, BASE, 1)]  # a burst at one instant; a link without a question


@pytest.mark.parametrize("segment, partitions", [(1, 5), (16, 1), (7, 24), (10_000, 8)])
def test_segments_hold_all_answers_in_order(spark, segment, partitions):
    questions, answers = random_rows(segment)
    asked = {q[2] for q in questions}
    expected = defaultdict(list)
    for link, us, score in answers:
        if link in asked:
            expected[link].append((us, score))
    key = lambda a: (a[0], a[1] is not None, a[1] or 0)
    got = defaultdict(dict)
    for r in answers_nested(frames(spark, questions, answers), segment, partitions).collect():
        assert r.segment not in got[r.link] and 0 < len(r.answers) <= segment
        got[r.link][r.segment] = [tuple(a) for a in r.answers]
    for link, all_answers in expected.items():
        ordered = sorted(all_answers, key=key)
        assert got.pop(link) == {i // segment: ordered[i:i + segment] for i in range(0, len(ordered), segment)}
    assert not got


@pytest.mark.parametrize("segment", [1, 4, 256])
def test_latency_from_arrays_equals_the_flat_form(spark, segment):
    questions, answers = random_rows(segment + 100)
    data = frames(spark, questions, answers)
    flat = sorted(tuple(r) for r in first_answer_minutes(data, 9).collect())
    assert flat and sorted(tuple(r) for r in first_answer_minutes_nested(data, segment, 9).collect()) == flat


@pytest.mark.parametrize("view", [events_view, orders_view, customers_view])
def test_latency_from_arrays_on_the_views(spark, view):
    data = view(spark, SF_SMALL)
    flat = sorted(tuple(r) for r in first_answer_minutes(data).collect())
    assert flat and sorted(tuple(r) for r in first_answer_minutes_nested(data, 3).collect()) == flat


def test_hot_question_is_many_rows_and_meets_two_arrays_only(spark):
    """One link with 20,000 answers and as many questions: nested rows and joined rows stay linear."""
    rnd = random.Random(2)
    questions = [(i, BASE + rnd.randrange(10**11), 5) for i in range(20_000)]
    answers = [(5, BASE + rnd.randrange(10**11), 1) for _ in range(20_000)]
    data = frames(spark, questions, answers)
    numbered = numbered_answers(data, 8)
    assert numbered.where("is_q").select(F.max("before")).first()[0] <= 20_000
    assert answers_nested(data, 64, 8).count() == -(-20_000 // 64)
    nested = first_answer_minutes_nested(data, 64, 8)
    assert nested.count() == 20_000
    plan = nested._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert sorted(map(tuple, nested.collect())) == sorted(map(tuple, first_answer_minutes(data, 8).collect()))


def test_nulls_and_empty_tables(spark):
    rows = frames(spark, [(1, None, 5), (2, BASE, None), (3, BASE, 5)], [(None, BASE, 1), (5, None, 1), (5, BASE + 60_000_000, None)])
    assert [tuple(r) for r in render_answers(answers_nested(rows, 2, 3)).collect()] == [(5, 0, f"{BASE + 60_000_000}:")]
    assert [tuple(r) for r in first_answer_minutes_nested(rows, 2, 3).collect()] == [(3, 1, 1)]
    none = frames(spark, [], [])
    assert answers_nested(none).count() == 0 and first_answer_minutes_nested(none).count() == 0


def test_tags_are_unnested_by_a_generate_over_the_array(spark):
    df = unnested_tags(orders_view(spark, SF_SMALL))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Generate inline(tags" in plan
    assert df.columns == ["id", "tag", "n"] and df.count() > 0


def test_numbered_rows_do_not_depend_on_the_partition_count(spark):
    questions, answers = random_rows(8)
    data = frames(spark, questions, answers)
    one = sorted(map(tuple, numbered_answers(data, 1).where("NOT is_q").select("link", "ts", "before").collect()))
    assert one == sorted(map(tuple, numbered_answers(data, 30).where("NOT is_q").select("link", "ts", "before").collect()))


def test_a_whole_question_is_its_rows_in_order(spark):
    answers = [(1, BASE + i, i) for i in range(5)] + [(2, BASE, 1), (3, BASE, 1)]
    q = [(1, BASE + 9, 1), (1, BASE + 4, 1), (2, BASE, 2), (4, BASE, 4), (6, BASE, 7)]  # 2 has no tag, 4 no answer, 6 another link
    data = frames(spark, q, answers)
    tags = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (3, "x"), (4, "x"), (6, "x")], "question_id long, tag string")
    rows = whole_questions(QAData(data.questions, data.answers, tags), 2, 3).orderBy("id", "segment").collect()
    assert [(r.id, r.segment, r.copies, r.creation_us) for r in rows] == [(1, 0, 2, BASE + 4), (1, 1, 2, None), (1, 2, 2, None)]
    assert [tuple(a) for r in rows for a in r.answers] == [(BASE + i, i) for i in range(5)]
    assert [tuple(t) for t in rows[0].tags] == [("a", 2), ("b", 4)] and rows[1].tags is None
