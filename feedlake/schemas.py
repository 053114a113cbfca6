"""Explicit schemas. Nothing in this package infers one from data."""

from __future__ import annotations

from pyspark.sql import types as T

# Child elements of a feed <item> that are read. All others are pruned.
ITEM_FIELDS = ["title", "guid", "link", "host", "location", "start", "end", "description"]

CORRUPT = "_corrupt_record"

# Whether an item's guid is an address, which it is unless it says otherwise.
PERMALINK = "guid_is_permalink"

ITEM = T.StructType([T.StructField(name, T.StringType()) for name in ITEM_FIELDS])
ITEM_WITH_CORRUPT = T.StructType([*ITEM.fields, T.StructField(CORRUPT, T.StringType())])

# The silver table, in column order.
SILVER = T.StructType(
    [
        T.StructField("event_id", T.IntegerType(), False),
        T.StructField("title", T.StringType(), False),
        T.StructField("host", T.StringType()),
        T.StructField("start_date", T.DateType()),
        T.StructField("end_date", T.DateType()),
        T.StructField("start_time", T.StringType()),
        T.StructField("end_time", T.StringType()),
        T.StructField("event_description", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("external_link", T.StringType()),
        T.StructField("record_source", T.StringType(), False),
        T.StructField("load_date", T.StringType(), False),
    ]
)

#: The same, with NULL allowed everywhere.
OPEN_SILVER = T.StructType([T.StructField(f.name, f.dataType) for f in SILVER])

KEY = "event_id"

LEDGER = T.StructType(
    [
        T.StructField("record_source", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("n_items", T.LongType()),
        T.StructField("n_bad", T.LongType()),
        T.StructField("load_date", T.StringType()),
        T.StructField("state", T.StringType()),
    ]
)

COMMIT = T.StructType(
    [
        T.StructField("version", T.LongType(), False),
        T.StructField("path", T.StringType(), False),
        T.StructField("committed_at", T.TimestampType(), False),
    ]
)
