"""Column-level helpers: built-in Spark expressions only, so they stay inside whole-stage codegen."""

from studylake.functions.columns import code_or_zero, keep_when, trim_strings
from studylake.functions.times import calendar_parts, capture_date_of_hour, parse_raw_time

__all__ = ["calendar_parts", "capture_date_of_hour", "code_or_zero", "keep_when", "parse_raw_time", "trim_strings"]
