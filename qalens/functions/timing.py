"""Elapsed-time helpers on instants, independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_MINUTE = 60_000_000
# Fixed value: an answer is "fast" when it came strictly less than one day after the question.
DAY_MINUTES = 1440


def epoch_micros(ts: Column) -> Column:
    """Microseconds since the epoch of an instant (TIMESTAMP_NTZ is read under the pinned UTC zone)."""
    return F.unix_micros(ts.cast("timestamp"))


def int_div(numerator: Column, denominator: Column | int) -> Column:
    """Exact integral division (SQL ``div``), truncating toward zero; BIGINT result."""
    if not isinstance(denominator, Column):
        denominator = F.lit(denominator).cast("bigint")
    return F.call_function("div", numerator.cast("bigint"), denominator.cast("bigint"))


def whole_minutes(micros: Column) -> Column:
    """Elapsed (non-negative) microseconds truncated to whole minutes."""
    return int_div(micros, MICROS_PER_MINUTE)
