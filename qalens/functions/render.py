"""Tuple rendering of report rows, as the text sinks write them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pair(left: Column, right: Column) -> Column:
    """``(left,right)`` — the text form of a key/value pair."""
    return F.concat(F.lit("("), left.cast("string"), F.lit(","), right.cast("string"), F.lit(")"))


def mean_time_line(tag: Column, mean_minutes: Column, probability: Column) -> Column:
    """``(tag,(mean_minutes,probability))``."""
    return pair(tag, pair(mean_minutes, probability))


def count_line(tag: Column, n: Column) -> Column:
    """``(tag,n)``."""
    return pair(tag, n)


def parse_mean_time_line(lines: DataFrame) -> DataFrame:
    """``tag, mean_minutes, probability`` of frames of ``line``: what ``mean_time_line`` wrote, the share as the double it prints."""
    parts = [F.regexp_extract("line", r"(?s)^\((.*),\((-?\d+),([^,]*)\)\)$", i) for i in (1, 2, 3)]
    return lines.select(parts[0].alias("tag"), parts[1].cast("bigint").alias("mean_minutes"), parts[2].cast("double").alias("probability"))
