"""Date and calendar expressions that turn malformed text into NULL instead of failing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text format of dates and the year/quarter pattern of folder names.
YMD = "yyyyMMdd"
YEAR_QUARTER = r"(?i)(\d{4})[^\d]*q([1-4])"


def ymd_to_date(text: Column) -> Column:
    """'20240131' as a date; NULL when the text is no such date."""
    return F.try_to_date(text, YMD)


def path_year(path: Column) -> Column:
    """Year in a path such as '/raw/2024q1/num.parquet'; NULL when the path names no quarter."""
    return _group_as_int(path, 1)


def path_quarter(path: Column) -> Column:
    """Quarter (1-4) in a path; NULL when the path names no quarter."""
    return _group_as_int(path, 2)


def _group_as_int(path: Column, group: int) -> Column:
    found = F.regexp_extract(path, YEAR_QUARTER, group)
    return found.try_cast("int")


def repaired_date(ymd: Column, fallback_year: Column, min_year: int, max_year: Column) -> Column:
    """Date of ``ymd``, taking ``fallback_year`` when its own year is outside the range.

    NULL text, text that is no date, and 29 February moved into a common year all give NULL.
    """
    own_year = F.substring(ymd, 1, 4)
    plausible = own_year.try_cast("int").between(F.lit(min_year), max_year)
    year_text = F.when(plausible, own_year).otherwise(fallback_year.cast("string"))
    return ymd_to_date(F.concat_ws("", year_text, F.substring(ymd, 5, 2), F.substring(ymd, 7, 2)))


def is_quarter_end(day: Column) -> Column:
    """True on the last day of a calendar quarter."""
    next_day = F.date_add(day, 1)
    return F.trunc(next_day, "quarter") == next_day
