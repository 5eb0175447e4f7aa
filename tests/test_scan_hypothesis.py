"""Generated edge cases for the nearest-answer scan against brute force: equal instants,
links without answers, answers without questions, repeated ids, tiny and many partitions."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from qalens.operators.nearest import answer_scan

BASE = 1_600_000_000_000_000
MINUTE = 60_000_000

questions_st = st.lists(st.tuples(st.integers(0, 8), st.integers(0, 30), st.integers(0, 3)), min_size=1, max_size=25)
answers_st = st.lists(st.tuples(st.integers(0, 4), st.integers(0, 30)), max_size=40)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(questions=questions_st, answers=answers_st, partitions=st.sampled_from([1, 2, 5, 13]))
def test_scan_matches_brute_force(spark, questions, answers, partitions):
    q_rows = [(qid, BASE + t * MINUTE, link) for qid, t, link in questions]
    a_rows = [(link, BASE + t * MINUTE) for link, t in answers]
    qdf = spark.createDataFrame(q_rows, "id long, us long, link long") \
        .selectExpr("id", "link", "timestamp_micros(us) AS creation_ts")
    adf = spark.createDataFrame(a_rows, "link long, us long") \
        .selectExpr("link", "timestamp_micros(us) AS creation_ts")
    got = sorted((r.id, r.link, r.q_us, r.nearest_us, r.n_answers)
                 for r in answer_scan(qdf, adf, partitions, materialize_input=False).collect())
    expected = []
    for qid, ts, link in q_rows:
        mine = [a for lk, a in a_rows if lk == link]
        expected.append((qid, link, ts, min((abs(a - ts) for a in mine), default=None), len(mine)))
    assert got == sorted(expected)


@pytest.mark.parametrize("setting", ["spark.sql.exchange.reuse", "spark.sql.adaptive.enabled"])
def test_scan_does_not_depend_on_optimizer_settings(spark, setting):
    # half of the questions and answers on one link, the input above a shuffle and not written before the exchange
    q_rows = [(i, BASE + (i * 7919 % 5000) * MINUTE, 0 if i % 2 else i % 50) for i in range(4000)]
    a_rows = [(0 if i % 2 else i % 50, BASE + (i * 104729 % 5000) * MINUTE) for i in range(600)]
    qdf = spark.createDataFrame(q_rows, "id long, us long, link long").repartition(5, "us").selectExpr("id", "link", "timestamp_micros(us) AS creation_ts")
    adf = spark.createDataFrame(a_rows, "link long, us long").repartition(3, "us").selectExpr("link", "timestamp_micros(us) AS creation_ts")
    by_link = {}
    for link, ts in a_rows:
        by_link.setdefault(link, []).append(ts)
    expected = sorted((i, min((abs(a - ts) for a in by_link.get(link, [])), default=-1), len(by_link.get(link, []))) for i, ts, link in q_rows)
    spark.conf.set(setting, "false")
    try:
        got = sorted((r.id, -1 if r.nearest_us is None else r.nearest_us, r.n_answers)
                     for r in answer_scan(qdf, adf, 24, materialize_input=False).collect())
    finally:
        spark.conf.set(setting, "true")
    assert got == expected
