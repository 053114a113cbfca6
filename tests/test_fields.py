"""One field at a time, with values worked out from Python's own rules."""

import re
import unicodedata
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from feedlake.functions import fields, html, text


def over(spark, values, expression, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.out for r in rows.select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()]


DIRTY = [
    "plain", "", " ", "\t a\n", "\xa0b\xa0", " c d　", "\x1ce\x1f", "\x85f", "g​", "h﻿",
    "café au lait", "éé", " ñ", "日本語 text 日本", "a b", " x ", "  é  x  é  ",
]


def test_strip_is_str_strip(spark):
    assert over(spark, DIRTY, text.strip) == [v.strip() for v in DIRTY]


def test_optional_text(spark):
    want = [v.strip() or None for v in DIRTY]
    assert over(spark, [*DIRTY, None], text.optional_text) == [*want, None]


def test_ascii_text(spark):
    want = [re.sub(r"[^\x00-\x7F]+", " ", v).strip() for v in DIRTY]
    assert over(spark, [*DIRTY, None], text.ascii_text) == [*want, ""]


@pytest.mark.parametrize(
    "guid, want",
    [
        ("https://x/event/12", 12),
        ("  https://x/event/12\n", 12),
        ("12", 12),
        ("https://x/event/ 7", 7),
        ("https://x/+5", 5),
        ("https://x/-5", -5),
        ("https://x/1_000", 1000),
        ("https://x/1__0", None),
        ("https://x/_1", None),
        ("https://x/007", 7),
        ("https://x/12/", None),
        ("https://x/12.0", None),
        ("https://x/1e3", None),
        ("https://x/12?y=1", None),
        ("https://x/abc", None),
        ("", None),
        (None, None),
        ("https://x/2147483647", 2147483647),
        ("https://x/2147483648", None),
        ("https://x/-2147483648", -2147483648),
    ],
)
def test_id_from_guid(spark, guid, want):
    assert over(spark, [guid], fields.id_from_guid) == [want]


DATES = {
    "Sat, 16 Mar 2024 09:15:30 GMT": date(2024, 3, 16),
    "5 Jan 2024": date(2024, 1, 5),
    "05 Jan 2024": date(2024, 1, 5),
    "29 Feb 2024": date(2024, 2, 29),
    "123 Jan 2024": date(2024, 1, 23),
    "1 Mar 20245": date(2024, 3, 1),
    "1 Mar 2024 then 2 Apr 2025": date(2024, 3, 1),
    "31 Feb 2024": None,
    "29 Feb 2023": None,
    "00 Jan 2024": None,
    "5 Jan 0000": None,
    "5 jan 2024": None,
    "5 January 2024": None,
    "Jan 5 2024": None,
    "": None,
}


def test_feed_date(spark):
    assert over(spark, list(DATES), fields.feed_date) == list(DATES.values())
    assert over(spark, [None], fields.feed_date) == [None]


def test_a_day_that_does_not_exist_is_still_a_date_text(spark):
    bad = {"31 Feb 2024", "29 Feb 2023", "00 Jan 2024", "5 Jan 0000"}
    said = over(spark, list(DATES), fields.date_text)
    assert {d for d, s in zip(DATES, said) if s and DATES[d] is None} == bad


def test_feed_time(spark):
    said = ["at 09:15:30 GMT", "99:99:99", "2:00:00", "109:15:301", "10:00", "", None]
    want = ["09:15:30", "99:99:99", None, "09:15:30", None, None, None]
    assert over(spark, said, fields.feed_time) == want


def test_file_name_and_snapshot_name(spark):
    assert over(spark, ["new/a.xml", "b.xml", "x/y/"], fields.file_name) == ["a.xml", "b.xml", ""]
    got = over(spark, [datetime(2024, 3, 2, 4, 5, 16)], fields.snapshot_name, "timestamp_ntz")
    assert got == ["events_20240302_040516.xml"]


def test_nfkc(spark):
    odd = ["ﬁ①", "Å", "é", "x\xa0y", "", "ｶﾞ", "…", "plain", None]
    want = [None if v is None else unicodedata.normalize("NFKC", v) for v in odd]
    assert over(spark, odd, html.nfkc_text) == want


def test_nfkc_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for row in docs.select("text", html.nfkc_text(F.col("text")).alias("out")).collect():
        assert row.out == unicodedata.normalize("NFKC", row.text)
