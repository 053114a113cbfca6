"""Versioned tables, ledger, catalog, CSV, lookups, retention."""

from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake.operators.lookup import events_on_date, titles_json
from feedlake.operators.retention import retention_tier
from feedlake.session import materialize, shared_dir, work_path
from feedlake.sources import tables

SCHEMA = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.StringType())])


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_first_read_is_empty_with_the_schema(spark, tmp_path):
    table = tables.SnapshotTable(spark, str(tmp_path / "t"), SCHEMA)
    assert table.version == 0 and table.path is None
    assert table.read().schema == SCHEMA and table.read().isEmpty()


def test_versions_replace_each_other(spark, tmp_path):
    table = tables.SnapshotTable(spark, str(tmp_path / "t"), SCHEMA)
    assert table.write(frame(spark, [(1, "a"), (2, "b")])) == 1
    before = table.read()
    assert table.write(table.read().filter("k = 1").unionByName(frame(spark, [(3, "c")]))) == 2
    assert rows_of(table.read()) == [(1, "a"), (3, "c")]
    assert rows_of(before) == [(1, "a"), (2, "b")]
    table.write(frame(spark, []))
    assert table.version == 3 and table.read().isEmpty()


def test_a_version_without_its_commit_does_not_count(spark, tmp_path):
    table = tables.SnapshotTable(spark, str(tmp_path / "t"), SCHEMA)
    table.write(frame(spark, [(1, "a")]))
    frame(spark, [(9, "half")]).write.parquet(f"{table.root}/data/00000002-dead")
    assert table.version == 1 and rows_of(table.read()) == [(1, "a")]

    def boom(v):
        raise ValueError("lost")

    with pytest.raises(Exception, match="lost"):
        table.write(frame(spark, [(1, "a")]).withColumn("v", F.udf(boom)("v")))
    assert table.version == 1 and rows_of(table.read()) == [(1, "a")]
    assert table.write(frame(spark, [(2, "b")])) == 2


def test_clustered_write_spreads_one_value_over_files(spark, tmp_path):
    table = tables.SnapshotTable(spark, str(tmp_path / "t"), SCHEMA)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table.write(spark.range(4000).select(F.col("id").cast("int").alias("k"), F.lit("hot").alias("v")),
                    cluster_by=["v", "k"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    per_file = table.read().groupBy(F.input_file_name()).count().collect()
    assert len(per_file) > 4 and max(r["count"] for r in per_file) < 2000


def test_only_a_missing_path_is_empty(spark, tmp_path):
    assert tables.read_or_empty(spark, str(tmp_path / "none"), SCHEMA).isEmpty()
    with pytest.raises(AnalysisException):
        tables.path_exists_or_empty(spark, lambda: spark.table("no_such_table"), SCHEMA)


def test_published_view_follows_the_table(spark, tmp_path):
    table = tables.SnapshotTable(spark, str(tmp_path / "t"), SCHEMA)
    with pytest.raises(ValueError):
        tables.publish(table, "published")
    for version in ([(1, "a")], [(2, "b"), (3, "c")]):
        table.write(frame(spark, version))
        tables.publish(table, "published")
        assert rows_of(spark.sql("SELECT * FROM published")) == version
    spark.sql("DROP VIEW published")


def test_merged_schema(spark, tmp_path):
    frame(spark, [(1, "a")]).drop("v").write.parquet(str(tmp_path / "a"))
    frame(spark, [(2, "b")]).write.parquet(str(tmp_path / "b"))
    tables.register(tables.merged_schema(spark, [str(tmp_path / "a"), str(tmp_path / "b")]), "merged")
    assert rows_of(spark.sql("SELECT k, v FROM merged WHERE v IS NOT NULL")) == [(2, "b")]
    assert spark.sql("SELECT * FROM merged WHERE v IS NULL").count() == 1


def test_csv(spark, tmp_path):
    rows = [(1, 'quote " and, comma'), (2, "line\nbreak"), (3, ""), (4, None), (5, " x "), (6, "\\N?"), (7, "é\\")]
    tables.write_csv(frame(spark, rows), str(tmp_path / "csv"))
    assert rows_of(tables.read_csv(spark, str(tmp_path / "csv"), SCHEMA).na.fill("NULL")) == sorted(
        (k, "NULL" if v is None else v) for k, v in rows
    )


def test_events_on_date(spark):
    rows = [(6, date(2024, 1, 1), "09:00:00"), (1, date(2024, 1, 1), "10:00:00"), (2, date(2024, 1, 1), None), (3, None, "09:00:00"),
            (4, date(2024, 1, 2), "08:00:00"), (5, date(2024, 1, 1), "09:00:00")]
    df = spark.createDataFrame(rows, "event_id int, start_date date, start_time string")
    assert [r.event_id for r in events_on_date(df, date(2024, 1, 1)).collect()] == [5, 6, 1]


def test_titles_json_pages(spark):
    df = spark.createDataFrame([(k, f't"{k}é') for k in (-1, 0, 1, 2, 3, 7)], "event_id int, title string")
    assert {r.page: r.body for r in titles_json(df, page_size=3).collect()} == {
        -1: '["t\\"-1é"]', 0: '["t\\"0é","t\\"1é","t\\"2é"]', 1: '["t\\"3é"]', 2: '["t\\"7é"]',
    }


@pytest.mark.parametrize("kind", ["date", "timestamp_ntz"])
def test_retention(spark, kind):
    as_of = date(2024, 4, 1)
    days = {0: "standard", 29: "standard", 30: "infrequent", 59: "infrequent", 60: "archive", 89: "archive", 90: None, 91: None}
    stamp = [datetime.fromordinal(as_of.toordinal() - d).replace(hour=13) for d in days]
    rows = [(d, s if kind != "date" else s.date()) for d, s in zip(days, stamp)]
    got = retention_tier(spark.createDataFrame(rows, f"age int, created {kind}"), "created", as_of)
    assert {r.age: r.tier for r in got.collect()} == {d: t for d, t in days.items() if t}


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert work_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert rows_of(materialize(frame(spark, [(1, "a")]))) == [(1, "a")]
    assert materialize(frame(spark, [])).isEmpty()


def test_csv_keeps_what_reads_like_null(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(["\\N", "\\\\N", "\\", "N", "", None, "x\\N"])]
    df = spark.createDataFrame(rows, "i int, t string")
    tables.write_csv(df, str(tmp_path / "c"))
    assert sorted(map(tuple, tables.read_csv(spark, str(tmp_path / "c"), df.schema).collect())) == rows


def test_two_writers_cannot_take_one_version(spark, tmp_path):
    schema = "i int"
    df = spark.createDataFrame([(1,)], schema)
    table = tables.SnapshotTable(spark, str(tmp_path / "t"), df.schema)
    table.write(df)
    slow = tables.SnapshotTable(spark, str(tmp_path / "t"), df.schema)
    slow._latest = lambda: (0, None)
    with pytest.raises(tables.ConcurrentWrite):
        slow.write(df)
    assert table.version == 1


def test_expired_versions_go_but_the_latest_stays(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "i int")
    table = tables.SnapshotTable(spark, str(tmp_path / "t"), df.schema)
    first = (table.write(df), table.path)[1]
    table.write(df)
    assert table.expire(date.today()) == 0
    assert table.expire(date.today() + timedelta(days=400)) == 1
    assert not Path(first.removeprefix("file:")).exists() and table.read().count() == 1
