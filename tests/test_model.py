"""The scan and the reports against a plain-Python model of the contract, on random data with
hot keys: one link holding a large share of all rows, repeated question ids, equal instants,
answers before their question, links without answers."""

import random
from collections import defaultdict

import pytest

from qalens.model import QAData
from qalens.operators.aggregates import answers_per_question, first_answer_minutes, question_weights
from qalens.operators.nearest import answer_scan
from qalens.operators.nested import first_answer_minutes_nested
from qalens.plans.reports import mean_time_answer, top_tags

BASE = 1_600_000_000_000_000  # epoch micros


def random_tables(seed, n_q=400, n_a=900, n_links=25, hot_share=0.4):
    rnd = random.Random(seed)

    def link():
        return 0 if rnd.random() < hot_share else rnd.randrange(1, n_links)

    def ts():
        # coarse grid so equal instants occur; spread over ~3 days
        return BASE + rnd.randrange(0, 4000) * 60_000_000 + rnd.choice([0, 0, 1, 59_999_999])

    questions, link_of = [], defaultdict(link)
    for _ in range(n_q):
        qid = rnd.randrange(0, n_q // 2)  # repeated ids; all copies of an id have one link
        questions.append((qid, ts(), link_of[qid]))
    answers = [(link(), ts()) for _ in range(n_a)]
    answers = [a for a in answers if a[0] != n_links - 1]  # one link never answered
    tags = [(rnd.randrange(0, n_q // 2 + 5), rnd.choice("abcdefg")) for _ in range(n_q)]
    tags += [(0, "hot")] * 200  # one question with many tag rows
    return questions, answers, tags


def model(questions, answers, tags, threshold):
    by_link = defaultdict(list)
    for lk, ts in answers:
        by_link[lk].append(ts)
    copies = defaultdict(int)
    nearest = {}
    links = defaultdict(set)
    for qid, ts, lk in sorted(questions, key=lambda q: -q[1]):  # the earliest copy comes last and stays
        copies[qid] += 1
        links[qid].add(lk)
        if by_link.get(lk):
            nearest[qid] = min(abs(a - ts) for a in by_link[lk])
    minutes = {q: d // 60_000_000 for q, d in nearest.items()}
    answered, fast, fast_min = defaultdict(int), defaultdict(int), defaultdict(int)
    for qid, tag in tags:
        if qid in minutes:
            w = copies[qid]
            answered[tag] += w
            if minutes[qid] < threshold:
                fast[tag] += w
                fast_min[tag] += w * minutes[qid]
    mean = {t: (fast_min[t] // fast[t], fast[t] / answered[t]) for t in fast}
    n_ans = {q: sum(len(by_link.get(lk, [])) for lk in ls) for q, ls in links.items()}
    return copies, minutes, mean, dict(answered), {q: n for q, n in n_ans.items() if n}


def frames(spark, questions, answers, tags):
    q = spark.createDataFrame(questions, "id long, us long, link long") \
        .selectExpr("id", "timestamp_micros(us) AS creation_ts", "link")
    a = spark.createDataFrame(answers, "link long, us long").selectExpr("link", "timestamp_micros(us) AS creation_ts",
                                                                        "0 AS score")
    t = spark.createDataFrame(tags, "question_id long, tag string")
    return QAData(q, a, t)


@pytest.mark.parametrize("seed,partitions", [(1, 1), (2, 3), (3, 17), (4, 64)])
def test_scan_and_reports_match_model(spark, seed, partitions):
    questions, answers, tags = random_tables(seed)
    copies, minutes, mean, answered, n_ans = model(questions, answers, tags, 1440)
    data = frames(spark, questions, answers, tags)

    got = {r.id: (r.copies, r.minutes) for r in first_answer_minutes(data, partitions).collect()}
    assert got == {q: (copies[q], m) for q, m in minutes.items()}

    nested = {r.id: (r.copies, r.minutes) for r in first_answer_minutes_nested(data, 3, partitions).collect()}
    assert nested == got

    got_n = {r.id: r.n_answers for r in answers_per_question(data).collect()}
    assert got_n == n_ans

    got_mean = {r.tag: (r.mean_minutes, r.probability)
                for r in mean_time_answer(data, 1440, partitions).collect()}
    assert got_mean.keys() == mean.keys()
    for tag, (m, p) in mean.items():
        assert got_mean[tag][0] == m and got_mean[tag][1] == pytest.approx(p, rel=0, abs=1e-15)

    rows = top_tags(data).collect()
    assert {r.tag: r.n for r in rows} == answered
    assert [r.n for r in rows] == sorted((r.n for r in rows), reverse=True)


def test_hot_link_is_split_across_range_partitions(spark):
    questions, answers, _ = random_tables(7, n_q=2000, n_a=4000, hot_share=0.6)
    data = frames(spark, questions, answers, [(0, "x")])
    scan = answer_scan(data.questions, data.answers, partitions=16)
    # the hot link (0) reaches many partitions; the bounded carry frame keeps it exact
    from pyspark.sql import functions as F
    q = data.questions.unionByName(data.answers.select("link", "creation_ts").withColumn("id", F.lit(None)),
                                   allowMissingColumns=True)
    spread = (q.repartitionByRange(16, "link", "creation_ts").withColumn("pid", F.spark_partition_id())
              .where("link = 0").select("pid").distinct().count())
    assert spread >= 8
    _, minutes, *_ = model(questions, answers, [], 1440)
    got = {r.id: r.nearest_us for r in sorted(scan.collect(), key=lambda r: -r.q_us) if r.nearest_us is not None}
    assert {k: v // 60_000_000 for k, v in got.items()} == minutes


def test_an_id_is_dated_by_its_earliest_copy(spark):
    # C10: the later copies of id 1 weigh, but their dates (nearer to an answer) don't count
    questions = [(1, BASE, 10), (1, BASE + 12 * 60_000_000, 10), (1, BASE + 90 * 60_000_000, 10), (2, BASE, 12)]
    answers = [(10, BASE + 100 * 60_000_000), (10, BASE + 13 * 60_000_000)]
    data = frames(spark, questions, answers, [(1, "a"), (2, "b")])
    for frame in (first_answer_minutes(data), first_answer_minutes_nested(data, 1)):
        assert [(r.id, r.copies, r.minutes) for r in frame.collect()] == [(1, 3, 13)]
    assert [(r.id, r.copies, r.creation_us) for r in question_weights(data.questions).orderBy("id").collect()] == [(1, 3, BASE), (2, 1, BASE)]
    assert {r.id: r.n_answers for r in answers_per_question(data).collect()} == {1: 2}
    assert [(r.tag, r.mean_minutes) for r in mean_time_answer(data).collect()] == [("a", 13)]


def test_hot_link_balance_and_exactness_at_larger_size(spark):
    """A third of all rows on one link: range partitions stay balanced, results stay exact."""
    import numpy as np
    from pyspark.sql import functions as F

    rng = np.random.default_rng(11)
    n_q, n_a, parts = 60_000, 120_000, 32
    q_link = np.where(rng.random(n_q) < 1 / 3, 0, rng.integers(1, 5_000, n_q))
    a_link = np.where(rng.random(n_a) < 1 / 3, 0, rng.integers(1, 5_000, n_a))
    q_ts = BASE + rng.integers(0, 10**12, n_q)
    a_ts = BASE + rng.integers(0, 10**12, n_a)

    # brute force per link with sorted arrays (no pairs)
    expected = {}
    order = np.argsort(a_link, kind="stable")
    links_sorted = a_link[order]
    for lk in np.unique(q_link):
        lo, hi = np.searchsorted(links_sorted, lk), np.searchsorted(links_sorted, lk, side="right")
        ts = np.sort(a_ts[order[lo:hi]])
        idx = np.nonzero(q_link == lk)[0]
        if len(ts) == 0:
            continue
        pos = np.searchsorted(ts, q_ts[idx])
        before = np.where(pos > 0, q_ts[idx] - ts[np.maximum(pos - 1, 0)], np.iinfo(np.int64).max)
        after = np.where(pos < len(ts), ts[np.minimum(pos, len(ts) - 1)] - q_ts[idx], np.iinfo(np.int64).max)
        for i, d in zip(idx, np.minimum(before, after)):
            expected[int(i)] = int(d)

    questions = spark.createDataFrame(
        [(i, int(l), int(t)) for i, (l, t) in enumerate(zip(q_link, q_ts))], "id long, link long, us long") \
        .selectExpr("id", "link", "timestamp_micros(us) AS creation_ts")
    answers = spark.createDataFrame([(int(l), int(t)) for l, t in zip(a_link, a_ts)], "link long, us long") \
        .selectExpr("link", "timestamp_micros(us) AS creation_ts")
    got = {r.id: r.nearest_us for r in answer_scan(questions, answers, parts, materialize_input=False).collect()
           if r.nearest_us is not None}
    assert got == expected

    sizes = [r["count"] for r in questions.select("link", "creation_ts")
             .unionByName(answers.select("link", "creation_ts"))
             .repartitionByRange(parts, "link", "creation_ts").groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 2 * (n_q + n_a) / parts


def test_one_big_group_is_linear(spark):
    """100k rows of one link in one partition: every window frame must be incremental
    (an unbounded-following frame re-aggregates per row and would take minutes here)."""
    import time

    import numpy as np

    rng = np.random.default_rng(5)
    n = 100_000
    is_q = rng.random(n) < 0.5
    ts = BASE + rng.integers(0, 10**11, n)
    questions = spark.createDataFrame([(i, int(t)) for i, t in enumerate(ts[is_q])], "id long, us long") \
        .selectExpr("id", "7 AS link", "timestamp_micros(us) AS creation_ts")
    answers = spark.createDataFrame([(int(t),) for t in ts[~is_q]], "us long") \
        .selectExpr("7 AS link", "timestamp_micros(us) AS creation_ts")
    started = time.time()
    got = {r.id: r.nearest_us for r in answer_scan(questions, answers, 1, materialize_input=False).collect()}
    assert time.time() - started < 60
    a = np.sort(ts[~is_q])
    q = ts[is_q]
    pos = np.searchsorted(a, q)
    before = np.where(pos > 0, q - a[np.maximum(pos - 1, 0)], np.iinfo(np.int64).max)
    after = np.where(pos < len(a), a[np.minimum(pos, len(a) - 1)] - q, np.iinfo(np.int64).max)
    assert got == {i: int(d) for i, d in enumerate(np.minimum(before, after))}


def test_carry_frame_is_bounded_by_two_rows_per_partition(spark):
    from qalens.operators.nearest import carry_frame, ranged_input
    from qalens.sources.views import events_view
    from conftest import SF_CHECK

    questions, answers, _ = random_tables(9, n_q=3000, n_a=6000, hot_share=0.6)
    synthetic = frames(spark, questions, answers, [(0, "x")])
    for data, parts in ((synthetic, 16), (synthetic, 64), (events_view(spark, SF_CHECK), 32)):
        carries = carry_frame(ranged_input(data.questions, data.answers, parts, False)[0])
        n = carries.count()
        assert n <= 2 * parts
        per_pid = carries.groupBy("pid").count().agg({"count": "max"}).first()[0]
        assert per_pid is None or per_pid <= 2


def test_burst_at_one_instant_is_split_and_exact(spark):
    """40k answers of one link at the same instant (identical range keys) plus questions around it."""
    from pyspark.sql import functions as F

    from qalens.operators.nearest import ranged_input

    burst = [(5, BASE)] * 40_000 + [(5, BASE + 7 * 60_000_000), (6, BASE)]
    questions = [(i, BASE + (i - 50) * 60_000_000, 5) for i in range(100)] + [(1000, BASE, 6)]
    data = frames(spark, questions, burst, [(0, "x")])
    sizes = [r["count"] for r in ranged_input(data.questions, data.answers, 8, False)[0]
             .groupBy("pid").count().collect()]
    assert max(sizes) < 2 * sum(sizes) / 8
    got = {r.id: r.nearest_us for r in answer_scan(data.questions, data.answers, 8, False).collect()}
    for i in range(100):
        q_ts = BASE + (i - 50) * 60_000_000
        assert got[i] == min(abs(q_ts - BASE), abs(q_ts - (BASE + 7 * 60_000_000)))
    assert got[1000] == 0
    assert {r.id: r.n_answers for r in answer_scan(data.questions, data.answers, 8, False).collect()}[0] == 40_001
