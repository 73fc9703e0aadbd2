"""Date text, integer date keys and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the text format of every date in the staging rows.
DATE_FORMAT = "M/d/yyyy"


def parse_date(text: Column | str) -> Column:
    """Month/day/year text as a date; text that is no date becomes null."""
    return F.try_to_date(text, DATE_FORMAT)


def date_key(day: Column) -> Column:
    """A date as the integer yyyymmdd. It names ``day`` once: where the optimizer copies
    the expression into a filter, a parsed text is parsed once there, not per part."""
    return F.date_format(day, "yyyyMMdd").cast("int")


def date_parts(day: Column) -> dict[str, Column]:
    """The calendar columns of the date dimension (day of week: 1 is Sunday)."""
    return {
        "date_key": date_key(day),
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month": F.month(day),
        "day": F.dayofmonth(day),
        "day_of_week": F.dayofweek(day),
        "month_name": F.date_format(day, "MMMM"),
        "day_name": F.date_format(day, "EEEE"),
    }
