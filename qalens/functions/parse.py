"""Strict field parsing as JVM-side Column expressions (no Python UDF).

The dumps are parsed the way ``Integer.parseInt`` and ``OffsetDateTime.parse`` (ISO offset
date-time) accept text. Spark's plain casts are more lenient (they trim blanks and accept
dates without a time or an offset), so integers are guarded by a pattern and date-times are
parsed with an explicit format.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted text forms.
INT_PATTERN = r"^[+-]?\d+$"
# ISO offset date-time: seconds and a 1-9 digit fraction optional, offset ``Z`` or ``+hh:mm``
# mandatory, ``T``/``Z`` in either case, calendar checked strictly.
OFFSET_DATETIME_FORMAT = "yyyy-MM-dd'T'HH:mm[:ss[.SSSSSSSSS]]XXX"
# Years 0000 to 9999 only. Also spares the date parser (which fails by an exception) what can't be a date.
DATE_START = r"^\d{4}-\d{2}-\d{2}[Tt]\d{2}:\d{2}"
FIELD_SEPARATOR = ","


def field(fields: Column, index: int) -> Column:
    """0-based field of a split line; NULL when the line has fewer fields."""
    return F.get(fields, F.lit(index))


def strict_int(text: Column) -> Column:
    """int32 parse: optional sign and ASCII digits only; NULL otherwise (incl. overflow)."""
    return F.when(text.rlike(INT_PATTERN), text.try_cast("int"))


def is_strict_int(text: Column) -> Column:
    return F.coalesce(strict_int(text).isNotNull(), F.lit(False))


def strict_offset_datetime(text: Column) -> Column:
    """ISO-8601 date-time with a mandatory offset to an instant; NULL for anything else.

    ``2021-01-01T10:15Z`` (no seconds) and up to nine fraction digits (cut to micros) are
    accepted; local date-times, bare dates, blanks and impossible dates give NULL.
    """
    return F.when(text.rlike(DATE_START), F.try_to_timestamp(text, F.lit(OFFSET_DATETIME_FORMAT)))


def leading_fields(line: Column, count: int) -> Column:
    """The first ``count`` comma-separated fields (fewer if the line has fewer).

    Only the line prefix up to the ``count``-th comma is split, so a long line costs no more
    than a short one. No quote handling: one physical line is one record.
    """
    return F.split(F.substring_index(line, FIELD_SEPARATOR, count), FIELD_SEPARATOR, -1)


def drop_trailing_separators(line: Column) -> Column:
    """``"5,x,,"`` -> ``"5,x"``: trailing empty fields do not count (``"5,"`` has one field)."""
    return F.rtrim(line, F.lit(FIELD_SEPARATOR))
