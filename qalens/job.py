"""Batch job: three Q&A dumps in, two per-tag text reports out (K5, K6).

    spark-submit qalens/job.py OUT --questions Q --answers A --tags T [--threshold 1440]
                 [--questions-header H ...] [--single-file] [--scan-partitions N]
                                                                   (or: python -m qalens.job ...)

writes ``OUT/mean_time_answer`` and ``OUT/top_tags``. Both replace earlier output together, once both are complete.
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import DataFrame, SparkSession

from qalens.functions.timing import DAY_MINUTES
from qalens.model import QAData
from qalens.plans.reports import mean_time_answer_from, per_tag_summary, top_tags_from
from qalens.session import apply_conf, build_session, fresh_path, run_scratch
from qalens.sinks.text import count_lines, mean_time_lines, write_reports
from qalens.sources.ingest import read_dump


def shared_summary(spark: SparkSession, data: QAData, threshold: int = DAY_MINUTES,
                   partitions: int | None = None) -> DataFrame:
    """The per-tag aggregate both reports read, written once to the shared scratch folder.

    Writing it cuts the lineage: the second report neither recomputes the scan nor depends
    on cached blocks of a lost executor. Its size is the tag vocabulary.
    """
    path = fresh_path(spark, "per_tag_summary", data.scratch)
    per_tag_summary(data, threshold, partitions).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def run(spark: SparkSession, questions: str, answers: str, tags: str, out: str, threshold: int = DAY_MINUTES,
        headers: tuple[str | None, str | None, str | None] = (None, None, None),
        single_file: bool = False, scan_partitions: int | None = None) -> tuple[str, str]:
    """Read the dumps, compute both reports from one shared aggregate, write them as text, replacing an old pair together.

    ``scan_partitions`` sets the range partitions of the nearest-answer scan. By default it is
    ``spark.sql.shuffle.partitions``, raised to twice the split count of the scan's narrow
    input (about 30 bytes per question or answer), i.e. ~180 MB of rows per partition.
    """
    apply_conf(spark)
    mean_path, top_path = os.path.join(out, "mean_time_answer"), os.path.join(out, "top_tags")
    with run_scratch(spark) as scratch:  # intermediate tables of this run, removed once both reports are written
        data = read_dump(spark, questions, answers, tags, headers, scratch)
        summary = shared_summary(spark, data, threshold, scan_partitions)
        write_reports({mean_path: mean_time_lines(mean_time_answer_from(summary)), top_path: count_lines(top_tags_from(summary))}, single_file)
    return mean_path, top_path


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="qalens.job", description=__doc__.split("\n")[0])
    parser.add_argument("out", help="output directory")
    parser.add_argument("--questions", required=True)
    parser.add_argument("--answers", required=True)
    parser.add_argument("--tags", required=True)
    parser.add_argument("--threshold", type=int, default=DAY_MINUTES, help="fast-answer bound in minutes")
    parser.add_argument("--questions-header")
    parser.add_argument("--answers-header")
    parser.add_argument("--tags-header")
    parser.add_argument("--single-file", action="store_true", help="one text file per report")
    parser.add_argument("--scan-partitions", type=int, help="range partitions of the nearest-answer scan")
    args = parser.parse_args(argv)
    spark = build_session(app_name="qalens")
    try:
        run(spark, args.questions, args.answers, args.tags, args.out, args.threshold,
            (args.questions_header, args.answers_header, args.tags_header), args.single_file, args.scan_partitions)
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
