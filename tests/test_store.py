"""A keyed store read and written through Spark, over a folder in this process."""

from datetime import date
from pathlib import Path

import pytest
from feed_files import feed, item, name, put
from pyspark.sql import functions as F

from feedlake.operators.sync import sync_plan
from feedlake.plans import jobs
from feedlake.schemas import SILVER
from feedlake.sources.folder_store import FolderStore, folder_store
from feedlake.sources.store import ranges_of, register_store

SCHEMA = "event_id int, title string, day date"


@pytest.mark.parametrize("low, high, n", [(0, 0, 5), (-7, 12, 3), (1, 100, 64), (5, 9, 5), (0, 2**31 - 1, 64)])
def test_ranges_cover_each_key_once(low, high, n):
    ranges = ranges_of(low, high, n)
    assert len(ranges) <= n and (ranges[0].low, ranges[-1].high) == (low, high)
    assert all(a.high + 1 == b.low for a, b in zip(ranges, ranges[1:], strict=False))


@pytest.fixture
def store(spark, tmp_path):
    folder = str(tmp_path / "store")
    schema = spark.createDataFrame([], SCHEMA).schema
    register_store(spark, "folder", folder_store(folder, "event_id"), schema, ranges=4)
    return folder


def held(spark):
    return spark.read.format("folder").load()


def rows(spark, ids, title="t"):
    return spark.createDataFrame([(i, None if i == 3 else title, date(2024, 1, 1 + i % 5)) for i in ids], SCHEMA)


def send(plan):
    plan.write.format("folder").mode("append").save()


def test_plan_is_applied_and_read_back(spark, store):
    assert held(spark).isEmpty()
    send(sync_plan(held(spark), rows(spark, range(-4, 40))))
    assert Path(store, "last_write").read_text() == "44 0 whole"
    assert sorted(map(tuple, held(spark).collect())) == sorted(map(tuple, rows(spark, range(-4, 40)).collect()))
    wanted = rows(spark, range(20, 50), "u")
    for sent in ("30 24 whole", "30 0 whole"):
        # The second time nothing is left to delete, and the same rows are put again.
        plan = sync_plan(held(spark), wanted)
        send(plan)
        assert Path(store, "last_write").read_text() == sent
        assert sorted(map(tuple, held(spark).collect())) == sorted(map(tuple, wanted.collect()))


def test_conditions_on_the_key_reach_the_store(spark, store):
    send(rows(spark, range(100)).withColumn("op", F.lit("put")))
    for condition, want in [
        ("event_id = 17", [17]), ("event_id >= 95", range(95, 100)), ("event_id < 3 AND event_id > 0", [1, 2]), ("event_id IN (4, 90)", [4, 90]),
        ("event_id > 500", []), ("event_id <= 5 AND title IS NULL", [3]), ("day = DATE '2024-01-02' AND event_id BETWEEN 10 AND 20", [11, 16]),
    ]:
        assert sorted(r.event_id for r in held(spark).filter(condition).collect()) == list(want)
    # Keys beyond the condition are not even looked at: their files are broken here.
    for i in range(50, 100):
        Path(store, f"{i}.json").write_text("no json")
    assert held(spark).filter("event_id < 50").count() == 50
    with pytest.raises(Exception, match="JSON"):
        held(spark).collect()


def test_aborted_write_is_told_and_mended(spark, store):
    plan = rows(spark, range(60)).withColumn("op", F.lit("put")).repartition(4)
    late = F.when(F.col("event_id") == 41, F.raise_error(F.lit("lost"))).otherwise(F.col("title"))
    with pytest.raises(Exception, match="lost"):
        send(plan.withColumn("title", late))
    assert Path(store, "last_write").read_text().endswith("aborted")
    send(plan)
    assert Path(store, "last_write").read_text() == "60 0 whole" and held(spark).count() == 60


def test_overwrite_is_refused(spark, store):
    with pytest.raises(Exception, match="append"):
        rows(spark, [1]).withColumn("op", F.lit("put")).write.format("folder").mode("overwrite").save()


def test_job_syncs_with_what_the_store_really_holds(spark, tmp_path):
    folder, landing = str(tmp_path / "store"), str(tmp_path / "new")
    register_store(spark, "events_folder", folder_store(folder, "event_id"), SILVER)
    lake = jobs.Lake(spark, str(tmp_path / "lake"))
    put(landing, name(1), feed(item(1), item(2)))
    jobs.run(lake, landing, "L", open_store=folder_store(folder, "event_id"))
    FolderStore(folder, "event_id").put_many([{"event_id": 77, "title": "strange"}])
    FolderStore(folder, "event_id").delete_many([1])
    found = spark.read.format("events_folder").load()
    report = jobs.sync_mirror(lake, folder_store(folder, "event_id"), found)
    assert (report.n_deleted, report.n_put) == (1, 2)
    assert sorted(map(repr, spark.read.format("events_folder").load().collect())) == sorted(map(repr, lake.silver.read().collect()))


def test_different_keys_of_one_query_need_a_load_each(spark, store):
    send(rows(spark, range(100)).withColumn("op", F.lit("put")))
    both = held(spark).filter("event_id < 10").unionAll(held(spark).filter("event_id >= 90"))
    assert sorted(r.event_id for r in both.collect()) == [*range(10), *range(90, 100)]
