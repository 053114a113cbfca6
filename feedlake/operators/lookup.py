"""Reads of the serving table."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.schemas import KEY


def events_on_date(
    mirror: DataFrame,
    day: date,
    date_col: str = "start_date",
    time_col: str = "start_time",
    key: str = KEY,
) -> DataFrame:
    """Rows of one date in time order; a row without a time is not in this index.

    The key settles ties, and lets the sort cut through a time that many rows share.
    """
    rows = mirror.filter((F.col(date_col) == F.lit(day)) & F.col(time_col).isNotNull())
    return rows.orderBy(time_col, key)


def titles(mirror: DataFrame, title: str = "title") -> DataFrame:
    return mirror.select(title)


def titles_json(
    mirror: DataFrame, page_size: int = 1000, key: str = KEY, title: str = "title"
) -> DataFrame:
    """All titles as JSON arrays in key order: ``page`` and ``body``.

    A page is a span of ``page_size`` keys. Keys are unique, so no page holds more titles
    than that, and the listing grows by pages instead of in one task.
    """
    pages = mirror.groupBy(F.floor(F.col(key) / page_size).alias("page"))
    in_order = F.sort_array(F.collect_list(F.struct(key, title)))
    return pages.agg(F.to_json(F.transform(in_order, lambda t: t[title])).alias("body"))
