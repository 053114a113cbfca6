"""Feeds folded in the state of a stream, against one feed after the other."""

import random

import pytest
from feed_files import feed, item, name, put
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_merge import EARLY, LATE, frame, python_fold, rows_of

from feedlake.plans import jobs
from feedlake.session import work_path
from feedlake.sources.tables import SnapshotTable
from feedlake.streaming.fold import FeedLog, fold_feeds, fold_log

LOAD = "2024-02-01T00:00:00+00:00"
ROW = T.StructType([T.StructField(n, T.IntegerType() if n == "event_id" else T.StringType()) for n in ("event_id", "title", "record_source", "load_date")])


@pytest.mark.parametrize("seed", range(2))
def test_state_equals_feed_after_feed(spark, seed, tmp_path):
    """Runs of one to three feeds, in any order of names, some without a row; an id may stand twice in a feed."""
    draw = random.Random(seed)
    log = FeedLog(spark, work_path(spark, "log"), ROW)
    table = SnapshotTable(spark, work_path(spark, "table"), ROW)
    names = [f"f{i:02d}" for i in range(9)]
    draw.shuffle(names)
    want, loads = [], {}
    while names:
        files = {names.pop(): [] for _ in range(min(len(names), draw.randint(1, 3)))}
        for file in files:
            if draw.random() < 0.15:
                continue
            ids = [i for i in range(400) if draw.random() < 0.75]
            files[file] = [(i, f"{file} early", file, EARLY) for i in ids] + [(i, f"{file} late", file, LATE) for i in ids[::7]]
        want = python_fold(want, files)
        feeds = spark.createDataFrame([(file,) for file in files], "record_source string")
        log.append(frame(spark, [r for rows in files.values() for r in rows]), feeds)
        loads[fold_log(log, table, str(tmp_path / "checkpoint"))] = len(want)
        assert rows_of(table.read()) == want
    assert fold_log(log, table, str(tmp_path / "checkpoint")) is None and len(loads) > 3


def test_nothing_to_fold(spark, tmp_path):
    log = FeedLog(spark, work_path(spark, "log"), ROW)
    none = spark.createDataFrame([], "record_source string")
    assert log.append(frame(spark, []), none) == 0
    assert fold_log(log, SnapshotTable(spark, work_path(spark, "table"), ROW), str(tmp_path / "c")) is None


def test_job_equals_batch(spark, tmp_path):
    """Late, empty, changed, bad and repeated feeds."""
    landing = str(tmp_path / "landing")
    lake, other = jobs.Lake(spark, str(tmp_path / "lake")), jobs.Lake(spark, str(tmp_path / "other"))

    def both(**options):
        fold_feeds(lake, landing, str(tmp_path / "checkpoint"), LOAD, **options)
        jobs.ingest(other, landing, LOAD, **options)
        found = rows_of(lake.silver.read())
        assert found == rows_of(other.silver.read())
        assert rows_of(lake.ledger().drop("state")) == rows_of(other.ledger().drop("state"))
        return {(r[0], r[1], r[10]) for r in found}

    put(landing, name(5), feed(item(1, title="d5"), item(2, title="d5")))
    assert both() == {(1, "d5", name(5)), (2, "d5", name(5))}
    put(landing, name(3), feed(item(1, title="d3"), item(7, title="d3")))
    assert both() == {(1, "d5", name(5)), (7, "d3", name(3))}
    put(landing, name(4), feed(item(1, title="d4"), item(2, title="d4")))
    assert both() == {(1, "d5", name(5)), (2, "d4", name(4))}
    put(landing, name(5), feed(item(1, title="again"), item(2, title="again")))
    assert both() == {(1, "again", name(5)), (2, "again", name(5))}
    put(landing, name(6), feed())
    assert both() == set()
    put(landing, name(2), feed(item(1, title="d2")))
    put(landing, name(7), "<html>no feed</html>")
    assert both(strict=False) == {(1, "d2", name(2))}
    put(landing, name(8), feed(item(4, title="d8")))
    put(landing, name(9), "")
    for job in (lambda: fold_feeds(lake, landing, str(tmp_path / "checkpoint"), LOAD), lambda: jobs.ingest(other, landing, LOAD)):
        with pytest.raises(jobs.FeedRejected):
            job()
    assert rows_of(lake.silver.read()) == rows_of(other.silver.read())
    assert {r.event_id for r in lake.silver.read().collect()} == {4}


def test_feeds_logged_twice_change_nothing(spark, tmp_path):
    """A run that died before the ledger logs its feeds again."""
    log = FeedLog(spark, work_path(spark, "log"), ROW)
    table = SnapshotTable(spark, work_path(spark, "table"), ROW)
    files = {"f1": [(1, "a", "f1", EARLY), (2, "b", "f1", EARLY)], "f3": [(1, "c", "f3", EARLY), (3, "d", "f3", EARLY)]}
    for rows, load in ((files, EARLY), (files, LATE)):
        all_rows = frame(spark, [r for part in rows.values() for r in part]).withColumn("load_date", F.lit(load))
        log.append(all_rows, spark.createDataFrame([("f1",), ("f3",)], "record_source string"))
        fold_log(log, table, str(tmp_path / "checkpoint"))
        assert [r[:3] for r in rows_of(table.read())] == [(1, "c", "f3"), (3, "d", "f3")]
    assert log.last == 4
