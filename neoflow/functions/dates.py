"""Day strings and day calendars."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the day format of feed keys and of the stamped current_date.
DAY_FORMAT = "yyyy-MM-dd"


def parse_day(c) -> Column:
    """Text -> DATE; one-digit months and days are accepted, other text raises."""
    return F.to_date(F.col(c) if isinstance(c, str) else c, "yyyy-M-d")


def exact_day(c) -> Column:
    """Text -> DATE where it is a day written exactly 'yyyy-MM-dd', else NULL."""
    c = F.col(c) if isinstance(c, str) else c
    day = F.try_to_date(c, DAY_FORMAT)
    return F.when(F.date_format(day, DAY_FORMAT) == c, day)


def format_day(c) -> Column:
    """DATE / timestamp -> 'yyyy-MM-dd' text."""
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c, DAY_FORMAT)


def day_calendar(start: Column, end: Column) -> Column:
    """Array of every day from start to end, both included; an empty array
    when start > end (``sequence`` alone would raise)."""
    return F.when(start <= end, F.sequence(start, end, F.expr("INTERVAL 1 DAY"))) \
        .otherwise(F.array().cast("array<date>"))
