"""Plan shape: no Python in the hot path, pushed-down scans, bounded broadcasts, no pair joins."""

import re

import pytest

from conftest import SF_SMALL
from qalens.plans import registry
from qalens.plans.reports import mean_time_answer
from qalens.sources.views import events_view, orders_view


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString() + "\n" + \
        df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_no_python_udf_no_pair_join(spark, name):
    text = plan_text(registry.queries()[name](spark, SF_SMALL))
    for banned in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert banned not in text, banned


def test_scan_reads_only_needed_columns(spark):
    df = mean_time_answer(orders_view(spark, SF_SMALL))
    plan = df._jdf.queryExecution().executedPlan().toString()
    formatted = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", formatted)
    assert schemas, plan
    for schema in schemas:
        assert "o_totalprice" not in schema and "l_extendedprice" not in schema and "p_name" not in schema


def test_only_bounded_frames_are_broadcast_explicitly(spark):
    # the only explicit broadcast hints are on the boundary links and the carry frame (<= 2 rows per range partition)
    df = mean_time_answer(events_view(spark, SF_SMALL))
    hints = df._jdf.queryExecution().analyzed().toString().count("ResolvedHint (strategy=broadcast)")
    assert hints == 2


def test_window_exchange_has_the_scan_partition_count(spark):
    df = mean_time_answer(orders_view(spark, SF_SMALL), 43200, partitions=24)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert re.findall(r"hashpartitioning\(pid#\d+, link#\d+L?, 24\)", text)
    assert not re.findall(r"hashpartitioning\(pid#\d+, link#\d+L?, 8\).*REPARTITION", text)


def test_views_derive_the_partition_count_from_file_sizes(spark):
    from qalens.operators.nearest import PARTITIONS_PER_SPLIT, ranged_input
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        data = orders_view(spark, SF_SMALL)
        _, n = ranged_input(data.questions, data.answers, None, False)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert n > 8 and n % PARTITIONS_PER_SPLIT == 0


def test_rows_entering_the_carry_window_are_bounded(spark):
    from qalens.operators.nearest import boundary_summary, ranged_input
    data = orders_view(spark, SF_SMALL)
    ranged, n = ranged_input(data.questions, data.answers, 24, False)
    assert n == 24 and boundary_summary(ranged).count() <= 2 * n


@pytest.mark.parametrize("name", ["top_tags", "top_tags_orders", "answered_questions", "answered_questions_orders", "answered_by_tag", "tag_counts",
                                  "answers_per_question", "answers_per_question_orders", "explode_tags", "explode_tags_orders"])
def test_no_window_where_no_latency_is_needed(spark, name):
    assert "Window" not in plan_text(registry.queries()[name](spark, SF_SMALL))


def test_one_exchange_by_tag_for_the_mean_time_report(spark):
    df = mean_time_answer(orders_view(spark, SF_SMALL), 43200)
    initial = df._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"hashpartitioning\(tag#\d+,", initial)) == 1


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_no_frame_is_reaggregated_per_row(spark, name):
    # Spark re-aggregates "<x> .. UNBOUNDED FOLLOWING" frames for every row (quadratic per group);
    # only the whole-partition frame may end there.
    text = plan_text(registry.queries()[name](spark, SF_SMALL))
    bad = re.findall(r"specifiedwindowframe\((?:RowFrame|RangeFrame), (?!unboundedpreceding)[^,()]+(?:\(\))?, "
                     r"unboundedfollowing", text)
    assert not bad, bad
