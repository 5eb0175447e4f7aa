"""Column-expression helpers: all JVM-side, none of them a Python UDF."""

from qalens.functions.parse import (drop_trailing_separators, field, is_strict_int, leading_fields, strict_int,
                                    strict_offset_datetime)
from qalens.functions.render import count_line, mean_time_line, pair
from qalens.functions.timing import DAY_MINUTES, epoch_micros, int_div, whole_minutes

__all__ = [
    "DAY_MINUTES", "count_line", "epoch_micros", "field", "int_div", "is_strict_int", "mean_time_line", "pair",
    "drop_trailing_separators", "leading_fields", "strict_int", "strict_offset_datetime",
    "whole_minutes",
]
