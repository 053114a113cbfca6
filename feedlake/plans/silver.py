"""Feed items to silver rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake import schemas
from feedlake.functions.fields import date_text, feed_date, feed_time, id_from_guid
from feedlake.functions.html import class_text
from feedlake.functions.text import ascii_text, optional_text, strip
from feedlake.operators.validate import drop_bad_files, reasons
from feedlake.schemas import CORRUPT, PERMALINK, SILVER

# Fixed value: the class of the element that holds an event's description.
DESCRIPTION_CLASS = "p-description"

REASON = "reject_reason"


def is_bad() -> Column:
    return F.col(REASON) != ""


def judge_items(items: DataFrame) -> DataFrame:
    """Items with their id and dates read, and why an item makes its file unfit.

    ``reject_reason`` is ``""`` where it does not. A missing element is NULL here, an empty
    one is ``""`` and passes. The end may lack a date, but not name a day that does not exist.
    """
    end = F.col("end")
    read = items.withColumns(
        {
            "event_id": id_from_guid(F.col("guid")),
            "start_date": feed_date(F.col("start")),
            "end_date": feed_date(end),
        }
    )
    checks = {
        "corrupt": F.col(CORRUPT).isNotNull(),
        "title": F.col("title").isNull(),
        "event_id": F.col("event_id").isNull(),
        "location": F.col("location").isNull(),
        "start": F.col("start_date").isNull(),
        "end": end.isNull() | (F.col("end_date").isNull() & date_text(end).isNotNull()),
    }
    return read.withColumn(REASON, reasons(checks))


def clean_items(items: DataFrame, load_date: str, guid_is_link: bool = True) -> DataFrame:
    """Silver columns plus ``reject_reason`` for every item, in narrow selects.

    ``guid_is_link``: an item without a link takes its guid for one, unless that says that it
    is no permalink.
    """
    link = optional_text(F.col("link"))
    if guid_is_link:
        permalink = F.when(F.col(PERMALINK), optional_text(F.col("guid")))
        link = F.coalesce(link, permalink)
    cleaned = {
        "title": strip(F.col("title")),
        "host": optional_text(F.col("host")),
        "start_time": feed_time(F.col("start")),
        "end_time": feed_time(F.col("end")),
        "event_description": class_text(F.col("description"), DESCRIPTION_CLASS, fold=True),
        "location": ascii_text(F.col("location")),
        "external_link": link,
        "load_date": F.lit(load_date),
    }
    columns = [cleaned.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in SILVER]
    return judge_items(items).select(*columns, REASON)


def feed_to_silver(items: DataFrame, load_date: str, guid_is_link: bool = True) -> DataFrame:
    """Silver rows of the files in which every item is good."""
    cleaned = clean_items(items, load_date, guid_is_link)
    return drop_bad_files(cleaned, is_bad()).select(SILVER.names)
