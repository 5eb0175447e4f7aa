"""Text output of the reports in tuple form (K1-K4)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qalens.functions.render import count_line, mean_time_line
from qalens.sinks.files import delete, join, merge_parts, replace_together


def mean_time_lines(report: DataFrame) -> DataFrame:
    """``(tag,(mean_minutes,probability))`` per row of the mean-time report."""
    return report.select(mean_time_line(F.col("tag"), F.col("mean_minutes"), F.col("probability")).alias("value"))


def count_lines(report: DataFrame) -> DataFrame:
    """``(tag,n)`` per row, keeping the report's order."""
    return report.select(count_line(F.col("tag"), F.col("n")).alias("value"))


def write_reports(reports: dict[str, DataFrame], single_file: bool = False) -> None:
    """Write frames of lines (path -> frame with the column ``value``) as text part files, replacing old output together.

    Every report is written whole to a staging folder beside its path first; then all are moved into place. A run that
    fails, in whichever report, leaves all old ones as they were. Part files follow the frame's partition order,
    so a globally sorted frame reads back in order when the parts are read by name; ``single_file`` joins them
    to one file in that order, without another shuffle.
    """
    staged: dict[str, str] = {}
    folders: set[str] = set()
    spark = None
    try:
        for path, lines in reports.items():
            spark = lines.sparkSession
            parent, _, name = path.rstrip("/").rpartition("/")
            folder = join(parent or ".", f"_staging-{uuid.uuid4().hex}")
            folders.add(folder)
            staged[join(folder, name)] = path
            lines.select("value").write.text(join(folder, name))
            if single_file:
                merge_parts(spark, join(folder, name))
        if staged:
            replace_together(spark, staged)
    finally:
        for folder in folders:
            delete(spark, folder)


def write_mean_time_answer(report: DataFrame, path: str, single_file: bool = False) -> None:
    write_reports({path: mean_time_lines(report)}, single_file)


def write_top_tags(report: DataFrame, path: str, single_file: bool = False) -> None:
    write_reports({path: count_lines(report)}, single_file)
