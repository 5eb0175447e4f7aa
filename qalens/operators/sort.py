"""Global sort of a report (S1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sort_by_count(df: DataFrame, count_col: str = "n", key_col: str = "tag") -> DataFrame:
    """All rows, count descending, ties by key ascending (range-partitioned global sort)."""
    return df.orderBy(F.col(count_col).desc(), F.col(key_col).asc())
