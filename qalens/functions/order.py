"""Order of file names in which numbers count as numbers: ``part-2`` before ``part-10``."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def name_key(name: Column) -> Column:
    """Sort key of a name: its runs of digits by value, all else by character."""
    def run(part: Column) -> Column:
        digits = F.ltrim(part, F.lit("0"))
        return F.when(part.rlike(r"^\d"), F.concat(F.lpad(F.length(digits).cast("string"), 6, "0"), digits)).otherwise(part)
    return F.transform(F.regexp_extract_all(name, F.lit(r"(\d+|\D+)"), F.lit(1)), run)


def sorted_names(names: list[str]) -> list[str]:
    """Names in the order of ``name_key`` (ties, e.g. ``1`` and ``01``, as text)."""
    def run(part: str) -> str:
        digits = part.lstrip("0")
        return f"{len(digits):06d}{digits}" if part[0].isdigit() else part
    return sorted(names, key=lambda name: ([run(p) for p in re.findall(r"[0-9]+|[^0-9]+", name)], name))
