"""Drift of a store from silver: found by digests of ranges, mended where it is."""

import random
from pathlib import Path

import pytest
from feed_files import feed, item, name, put

from feedlake.operators.drift import covering, drift_plan, drifted_ranges, range_digests
from feedlake.operators.sync import sync_plan
from feedlake.plans import jobs
from feedlake.schemas import SILVER
from feedlake.session import materialize, work_tables
from feedlake.sources.folder_store import FolderStore, folder_store
from feedlake.sources.store import register_store

SCHEMA = "event_id int, title string, host string"


@pytest.fixture(autouse=True)
def swept(spark):
    with work_tables(spark):
        yield


def table(spark, rows):
    return spark.createDataFrame([(k, *v) for k, v in rows.items()], SCHEMA)


def planned(held, desired, width, stretches=8):
    ranges = materialize(drifted_ranges(held, desired, "event_id", width), "drifted")
    return ranges, drift_plan(held, desired, ranges, "event_id", width, stretches)


@pytest.mark.parametrize("seed", range(4))
def test_plan_is_the_difference(spark, seed):
    """Against a plain comparison; NULL and an empty text differ, and so do two columns changed about."""
    rng = random.Random(seed)
    value = lambda: (rng.choice(["a", "", None]), rng.choice(["a", "", None]))
    keys = [*range(-60, 60), -(2**31), 2**31 - 1]
    held = {k: value() for k in keys if rng.random() < 0.9}
    desired = {k: v if rng.random() < 0.95 else value() for k, v in held.items() if rng.random() < 0.97} | {99: value()}
    want = {k: ("delete", v) for k, v in held.items() if k not in desired} | {k: ("put", v) for k, v in desired.items() if held.get(k) != v}
    ranges, plan = planned(table(spark, held), table(spark, desired), 10, stretches=3)
    assert {r.event_id: (r.op, (r.title, r.host)) for r in plan.collect()} == want
    assert {r.range for r in ranges.collect()} == {k // 10 for k in want}


def test_equal_and_empty_sides(spark):
    rows = {k: ("t", None) for k in range(50)}
    for held, desired, n in ((rows, rows, 0), ({}, {}, 0), (rows, {}, 50), ({}, rows, 50)):
        ranges, plan = planned(table(spark, held), table(spark, desired), 10)
        assert (ranges.count(), plan.count()) == (n // 10, n)
    # Order and files do not matter.
    some = table(spark, rows)
    digests = [sorted(map(repr, range_digests(df, "event_id", 7).collect())) for df in (some, some.repartition(5), some.orderBy("event_id", ascending=False))]
    assert digests[0] == digests[1] == digests[2]


def test_stretches_are_parted_at_the_widest_gaps(spark):
    ranges = spark.createDataFrame([(r,) for r in (5, 6, 9, 40, 41, 100, -3)], "range long")
    assert covering(ranges, 1) == [(-3, 100)]
    assert covering(ranges, 3) == [(-3, 9), (40, 41), (100, 100)]
    assert covering(ranges, 50) == [(-3, -3), (5, 6), (9, 9), (40, 41), (100, 100)]
    assert covering(ranges.limit(0)) == []


def test_one_drifted_row_reads_one_range(spark, tmp_path):
    """The store notes what it is asked for: after the digests, one range."""
    folder = str(tmp_path / "store")
    rows = {k: ("t", "h") for k in range(1000)}
    asked = tmp_path / "asked"

    class Noting(FolderStore):
        def scan(self, low, high):
            with asked.open("a") as f:
                f.write(f"{low} {high}\n")
            return super().scan(low, high)

    register_store(spark, "noting", lambda: Noting(folder, "event_id"), table(spark, {}).schema, ranges=4)
    sync_plan(table(spark, {}), table(spark, rows)).write.format("noting").mode("append").save()
    desired = table(spark, rows | {437: ("changed", "h")})
    held = spark.read.format("noting").load()
    ranges = materialize(drifted_ranges(held, desired, "event_id", 100), "drifted")
    asked.write_text("")
    plan = drift_plan(held, desired, ranges, "event_id", 100)
    assert [tuple(r) for r in plan.collect()] == [(437, "changed", "h", "put")]
    bounds = [tuple(map(int, line.split())) for line in asked.read_text().splitlines()]
    assert min(bounds)[0] == 400 and max(high for _, high in bounds) == 499


def test_job_mends_what_drifted_and_sends_nothing_else(spark, tmp_path):
    folder, landing = str(tmp_path / "store"), str(tmp_path / "new")
    register_store(spark, "drifting", folder_store(folder, "event_id"), SILVER)
    lake, store = jobs.Lake(spark, str(tmp_path / "lake")), folder_store(folder, "event_id")
    put(landing, name(1), feed(*[item(i) for i in range(30)]))
    jobs.run(lake, landing, "L", open_store=store)
    held = spark.read.format("drifting").load
    assert jobs.mend_store(lake, store, held(), 10) == jobs.DriftReport(0, 0, 0)
    FolderStore(folder, "event_id").put_many([{"event_id": 77, "title": "strange"}, {"event_id": 5, "title": "other"}])
    FolderStore(folder, "event_id").delete_many([8])
    untouched = Path(folder, "25.json").stat().st_mtime_ns
    assert jobs.mend_store(lake, store, held(), 10) == jobs.DriftReport(2, 1, 2)
    assert sorted(map(repr, held().collect())) == sorted(map(repr, lake.silver.read().collect()))
    assert Path(folder, "25.json").stat().st_mtime_ns == untouched
