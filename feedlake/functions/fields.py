"""Typed values out of feed strings. Bad input gives NULL, never an error.

ASCII digits only. ``1_0`` is read as 10, ``+5`` as 5, white space around a number is
ignored; other scripts' digits are not read.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlake.functions.text import strip

# What a date, a time and a whole number look like in a feed, and how
# snapshot files are named.
DATE_PATTERN = r"(\d{1,2}) (Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec) (\d{4})"
TIME_PATTERN = r"(\d{2}:\d{2}:\d{2})"
INT_PATTERN = r"^[+-]?[0-9]+(_[0-9]+)*$"
SNAPSHOT_NAME = "'events_'yyyyMMdd_HHmmss'.xml'"


def id_from_guid(guid: Column) -> Column:
    """The int32 after the last ``/``; NULL when it is not one."""
    last = strip(F.substring_index(strip(guid), "/", -1))
    return F.when(last.rlike(INT_PATTERN), F.replace(last, F.lit("_"), F.lit("")).try_cast("int"))


def date_text(text: Column) -> Column:
    """First thing that looks like ``5 Jan 2024``, else NULL."""
    return F.nullif(F.regexp_extract(text, DATE_PATTERN, 0), F.lit(""))


def feed_date(text: Column) -> Column:
    """The date in ``text``; NULL if there is none or no such day (31 Feb, year 0)."""
    # Year 0 parses in Spark but is no year: without it the rest does not parse.
    said = F.regexp_replace(date_text(text), " 0000$", "")
    return F.try_to_date(said, "d MMM yyyy")


def feed_time(text: Column) -> Column:
    """First ``HH:MM:SS``, kept as text and not range-checked, else NULL."""
    return F.nullif(F.regexp_extract(text, TIME_PATTERN, 0), F.lit(""))


def file_name(path: Column) -> Column:
    """Text after the last ``/``."""
    return F.substring_index(path, "/", -1)


def snapshot_name(ts: Column) -> Column:
    """``events_yyyyMMdd_HHmmss.xml``: fixed width, so name order is time order."""
    return F.date_format(ts, SNAPSHOT_NAME)
