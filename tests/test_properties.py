"""Properties of the reports on the driver tables: invariance under input order and session
time zone, linearity in the tag rows, value ranges, and consistency between the two reports."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from qalens.model import QAData
from qalens.plans.reports import mean_time_answer, per_tag_summary, top_tags
from qalens.sources.views import events_view, orders_view


def as_dict(df, key="tag"):
    return {r[key]: tuple(r)[1:] for r in df.collect()}


def test_input_order_and_partitioning_do_not_matter(spark):
    data = orders_view(spark, SF_SMALL)
    shuffled = QAData(data.questions.repartition(7).orderBy(F.rand(3)), data.answers.repartition(5),
                      data.tags.repartition(3).orderBy(F.rand(4)), materialize_scan=False)
    assert as_dict(mean_time_answer(data, 43200)) == as_dict(mean_time_answer(shuffled, 43200))
    assert as_dict(mean_time_answer(data, 43200, partitions=3)) == as_dict(mean_time_answer(data, 43200, partitions=29))


def test_doubling_tag_rows_doubles_counts_and_keeps_means(spark):
    data = events_view(spark, SF_SMALL)
    doubled = QAData(data.questions, data.answers, data.tags.unionByName(data.tags), materialize_scan=False)
    base, twice = as_dict(top_tags(data)), as_dict(top_tags(doubled))
    assert twice == {t: (2 * n,) for t, (n,) in base.items()}
    assert as_dict(mean_time_answer(data)) == as_dict(mean_time_answer(doubled))


def test_probability_range_and_report_consistency(spark):
    data = events_view(spark, SF_SMALL)
    summary = per_tag_summary(data).collect()
    mean = as_dict(mean_time_answer(data))
    top = as_dict(top_tags(data))
    assert set(mean) <= set(top)
    for tag, (minutes, p) in mean.items():
        assert 0 < p <= 1 and 0 <= minutes < 1440
    for r in summary:
        assert 0 <= r.fast <= r.answered and r.fast_minutes < 1440 * max(r.fast, 1)


def test_session_time_zone_does_not_change_results(spark):
    """Same instants, different session zones (orders span years, so daylight-saving shifts occur)."""
    tables = {name: spark.read.parquet(f"{SF_SMALL}/{name}.parquet") for name in ("orders", "lineitem", "part")}
    q = tables["orders"].select(F.col("o_orderkey").alias("id"),
                                F.unix_micros(F.col("o_orderdate").cast("timestamp")).alias("us")).toPandas()
    a = tables["lineitem"].select(F.col("l_orderkey").alias("link"),
                                  F.unix_micros(F.col("l_shipdate").cast("timestamp")).alias("us")).toPandas()
    t = (tables["lineitem"].join(tables["part"], F.col("l_partkey") == F.col("p_partkey"))
         .select(F.col("l_orderkey").alias("question_id"), F.col("p_brand").alias("tag")).toPandas())

    def report():
        questions = spark.createDataFrame(q).select("id", F.timestamp_micros("us").alias("creation_ts"),
                                                    F.col("id").alias("link"))
        answers = spark.createDataFrame(a).select("link", F.timestamp_micros("us").alias("creation_ts"),
                                                  F.lit(0).alias("score"))
        return as_dict(mean_time_answer(QAData(questions, answers, spark.createDataFrame(t),
                                               materialize_scan=False), 43200))

    in_utc = report()
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        in_ny = report()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert in_ny == in_utc and len(in_utc) > 0
