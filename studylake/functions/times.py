"""Time handling: raw text → timestamp (P-3, D-4), calendar columns (P-4), capture dates (P-15)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from studylake import constants as C

# ``xx`` reads a ``+hhmm`` / ``-hhmm`` offset under the current parser; the
# original pattern (``ZZZZ``) still reads ``GMT-06:00``.  Both are tried; text
# neither accepts (fractions, junk, empty) becomes NULL instead of an error.
OFFSET_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ssxx"
# Text of exactly that form, of the years 1000 to 9999: a cast reads it as the pattern does, at a fraction of the cost.
OFFSET_TIME_TEXT = r"^[1-9][0-9]{3}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}[+-][0-9]{4}\z"


def parse_raw_time(c: Column | str) -> Column:
    """Raw timestamp text to a timestamp at second precision, NULL when unparseable."""
    c = F.col(c) if isinstance(c, str) else c
    with_colon = F.concat(F.substring(c, 1, 22), F.lit(":"), F.substring(c, 23, 2))
    return F.coalesce(
        F.when(c.rlike(OFFSET_TIME_TEXT), with_colon.try_cast("timestamp")),
        F.try_to_timestamp(c, F.lit(OFFSET_TIME_FORMAT)),
        F.try_to_timestamp(c, F.lit(C.RAW_TIME_FORMAT)),
    )


def calendar_parts(ts: Column | str) -> dict[str, Column]:
    """year/month/day/hour columns of a timestamp, in the session time zone (UTC)."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return {
        C.YEAR: F.year(ts),
        C.MONTH: F.month(ts),
        C.DAY: F.dayofmonth(ts),
        C.HOUR: F.hour(ts),
    }


def capture_date_of_hour(year: str = C.YEAR_P, month: str = C.MONTH_P, day: str = C.DAY_P) -> Column:
    """The date of an hourly group (P-15, passive side); NULL for an impossible date such as Feb 30."""
    return F.expr(f"try_to_date(format_string('%04d-%02d-%02d', {year}, {month}, {day}))")
