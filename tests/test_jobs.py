"""The jobs as a user runs them: landed files in, silver and mirror out."""

import json
import os
from pathlib import Path

import pytest
from feed_files import HEAD, TAIL, feed, item, name, put
from pyspark.sql import functions as F

from feedlake.operators.sync import apply_plan, push_plan, removed_preview, removed_rows, sync_counts, sync_plan
from feedlake.plans import jobs
from feedlake.sources import tables
from feedlake.streaming.ingest import stream_feeds

LOAD = "2024-02-01T00:00:00+00:00"


@pytest.fixture
def lake(spark, tmp_path):
    return jobs.Lake(spark, str(tmp_path / "lake"))


@pytest.fixture
def landing(tmp_path):
    (tmp_path / "new").mkdir()
    return str(tmp_path / "new")


def state(table):
    return sorted((r.event_id, r.title, r.record_source) for r in table.read().collect())


def ledger(lake):
    return {r.record_source: r.status for r in lake.ledger().collect()}


def ingest(lake, landing, load=LOAD, **options):
    return jobs.ingest(lake, landing, load, **options)


def test_day_by_day_and_all_at_once_agree(spark, lake, landing, tmp_path):
    days = {1: [1, 2], 2: [2, 3], 3: [1, 3, 4]}
    other = jobs.Lake(spark, str(tmp_path / "other"))
    for day, ids in days.items():
        put(landing, name(day), feed(*[item(i, title=f"d{day}") for i in ids]))
        report = ingest(lake, landing)
        assert report == jobs.IngestReport(processed=1, silver_version=day)
    ingest(other, landing)
    assert state(lake.silver) == state(other.silver) == [(i, "d3", name(3)) for i in (1, 3, 4)]
    assert ledger(lake) == ledger(other) == {name(d): "processed" for d in days}
    assert other.silver.version == 1


def test_nothing_new_is_no_work(lake, landing):
    put(landing, name(1), feed(item(1)))
    ingest(lake, landing)
    report = ingest(lake, landing)
    assert report == jobs.IngestReport()
    assert lake.silver.version == 1


def test_nothing_landed(lake, landing):
    assert ingest(lake, landing) == jobs.IngestReport()
    assert ingest(lake, landing + "/absent") == jobs.IngestReport()
    assert lake.silver.version == 0


def test_late_file_gives_the_ids_and_newer_rows_the_values(lake, landing):
    put(landing, name(5), feed(item(1, title="five"), item(2, title="five")))
    ingest(lake, landing)
    put(landing, name(3), feed(item(1, title="three"), item(3, title="three")))
    put(landing, name(2), feed(item(1, title="two"), item(3, title="two")))
    ingest(lake, landing)
    assert state(lake.silver) == [(1, "five", name(5)), (3, "three", name(3))]


def test_late_files_of_which_one_lacks_the_id(lake, landing):
    put(landing, name(5), feed(item(1, title="five")))
    ingest(lake, landing)
    put(landing, name(2), feed(item(2)))
    put(landing, name(3), feed(item(1, title="three")))
    ingest(lake, landing)
    assert state(lake.silver) == [(1, "three", name(3))]


def test_empty_feed_empties_silver_and_mirror(lake, landing):
    put(landing, name(1), feed(item(1)))
    jobs.run(lake, landing, LOAD)
    put(landing, name(2), feed())
    report, sync = jobs.run(lake, landing, LOAD)
    assert report.processed == 1
    assert (sync.n_deleted, sync.n_put) == (1, 0)
    assert state(lake.silver) == state(lake.mirror) == []


def test_empty_feed_can_be_skipped(lake, landing):
    put(landing, name(1), feed(item(1)))
    put(landing, name(2), feed())
    report = ingest(lake, landing, allow_empty=False)
    assert (report.processed, report.skipped) == (1, 1)
    assert ledger(lake) == {name(1): "processed", name(2): "skipped"}
    assert state(lake.silver) == [(1, "T", name(1))]


def test_strict_stops_before_the_bad_file_and_keeps_it_pending(lake, landing):
    put(landing, name(1), feed(item(1)))
    put(landing, name(2), feed(item(2), item(3, start="never")))
    put(landing, name(3), feed(item(4)))
    for _ in range(2):
        with pytest.raises(jobs.FeedRejected, match=name(2)):
            jobs.run(lake, landing, LOAD)
        assert state(lake.silver) == [(1, "T", name(1))]
        assert ledger(lake) == {name(1): "processed"}
        assert lake.mirror.version == 0


def test_lenient_leaves_the_bad_file_out(lake, landing):
    put(landing, name(1), feed(item(1)))
    put(landing, name(2), feed(item(2), item(3, start="never")))
    put(landing, name(3), feed(item(4)))
    put(landing, name(4), HEAD + item(5) + "<item><title>cut")
    put(landing, name(6), (HEAD + item(6, title="\xff") + TAIL).encode("latin-1"))
    report = ingest(lake, landing, strict=False)
    assert (report.processed, report.rejected) == (2, 3)
    assert ledger(lake) == {name(d): "processed" if d in (1, 3) else "rejected" for d in (1, 2, 3, 4, 6)}
    assert state(lake.silver) == [(4, "T", name(3))]
    counts = {r.record_source: (r.n_items, r.n_bad) for r in lake.ledger().collect()}
    assert counts[name(2)] == (2, 1) and counts[name(3)] == (1, 0)


def test_all_files_bad(lake, landing):
    put(landing, name(1), feed(item(1, start="never")))
    assert ingest(lake, landing, strict=False) == jobs.IngestReport(rejected=1)
    assert lake.silver.version == 0


def test_file_that_cannot_be_split_is_read_whole(lake, landing):
    hidden = "<note><![CDATA[an <item> here]]></note><!-- </item> -->"
    put(landing, name(1), feed(item(1), item(2)))
    put(landing, name(2), feed(item(1, title="a", extra=hidden), item(3)))
    ingest(lake, landing)
    assert state(lake.silver) == [(1, "a", name(2)), (3, "T", name(2))]


def test_file_that_cannot_be_split_among_late_ones(lake, landing):
    hidden = "<note><![CDATA[an <item> here]]></note>"
    put(landing, name(9), feed(item(1, title="nine"), item(3, title="nine")))
    ingest(lake, landing)
    put(landing, name(1), feed(item(1, extra=hidden)))
    put(landing, name(2), feed(item(1), item(3, title="two")))
    ingest(lake, landing)
    assert state(lake.silver) == [(1, "nine", name(9)), (3, "two", name(2))]


def test_run_that_died_before_the_ledger_can_be_repeated(lake, landing, monkeypatch):
    put(landing, name(1), feed(item(1), item(2)))
    put(landing, name(2), feed(item(1, title="again")))

    def dies(*_):
        raise RuntimeError("lost the driver")

    with monkeypatch.context() as patch:
        patch.setattr(jobs, "append_ledger", dies)
        with pytest.raises(RuntimeError):
            ingest(lake, landing, "2024-02-01T00:00:00+00:00")
    assert ledger(lake) == {}
    first = lake.silver.read().collect()
    ingest(lake, landing, "2024-02-02T00:00:00+00:00")
    # Same rows down to the load date of the first run.
    assert lake.silver.read().collect() == first
    assert set(ledger(lake)) == {name(1), name(2)}


def test_mirror_follows_silver(lake, landing):
    put(landing, name(1), feed(item(1), item(2), item(3)))
    _, sync = jobs.run(lake, landing, LOAD)
    assert (sync.n_deleted, sync.n_put, sync.mirror_version) == (0, 3, 1)
    put(landing, name(2), feed(item(2, title="new"), item(4)))
    _, sync = jobs.run(lake, landing, LOAD)
    assert (sync.n_deleted, sync.n_put, sync.mirror_version) == (2, 2, 2)
    assert state(lake.mirror) == state(lake.silver) == [(2, "new", name(2)), (4, "T", name(2))]
    assert [r.event_id for r in removed_preview(lake.removed.read(), rows=1).collect()] == [1]


def test_plan_and_its_parts(spark):
    current = spark.createDataFrame([(1, "a"), (2, "b")], "event_id int, title string")
    desired = spark.createDataFrame([(2, "B"), (3, "c")], "event_id int, title string")
    plan = sync_plan(current, desired)
    assert sorted(map(tuple, plan.collect())) == [(1, "a", "delete"), (2, "B", "put"), (3, "c", "put")]
    assert sorted(map(tuple, apply_plan(current, plan).collect())) == [(2, "B"), (3, "c")]
    assert {r.op: r.n_rows for r in sync_counts(plan).collect()} == {"delete": 1, "put": 2}
    assert sorted(map(tuple, removed_rows(current, desired).collect())) == [(1, "a")]
    none = current.limit(0)
    assert {r.op for r in sync_plan(none, desired).collect()} == {"put"}
    assert sorted(map(tuple, apply_plan(current, sync_plan(current, none)).collect())) == []


class FolderStore:
    """A keyed store with a file per key, as a stand-in for a service."""

    def __init__(self, folder):
        self.folder = Path(folder)
        self.calls = 0

    def delete_many(self, keys):
        assert 0 < len(keys) <= 25
        for key in keys:
            (self.folder / str(key)).unlink(missing_ok=True)

    def put_many(self, rows):
        assert 0 < len(rows) <= 25
        for row in rows:
            (self.folder / str(row["event_id"])).write_text(json.dumps(row, default=str))

    def close(self):
        pass


def test_external_store_follows_silver(spark, lake, landing, tmp_path):
    folder = tmp_path / "store"
    folder.mkdir()
    # Tests are not installed on executors: let the class travel with the closure.
    from pyspark import cloudpickle

    import test_jobs

    cloudpickle.register_pickle_by_value(test_jobs)
    path = str(folder)

    def stored():
        return sorted(int(p.name) for p in folder.iterdir())

    put(landing, name(1), feed(*[item(i) for i in range(120)]))
    jobs.run(lake, landing, LOAD, open_store=lambda: FolderStore(path))
    assert stored() == list(range(120))
    put(landing, name(2), feed(*[item(i, title="b") for i in range(60, 130)]))
    jobs.run(lake, landing, LOAD, open_store=lambda: FolderStore(path))
    assert stored() == list(range(60, 130))
    row = json.loads((folder / "60").read_text())
    assert (row["title"], row["start_date"]) == ("b", "2024-05-07") and "op" not in row
    # The same plan again changes nothing.
    plan = sync_plan(lake.mirror.read(), lake.silver.read())
    push_plan(plan, lambda: FolderStore(path))
    assert stored() == list(range(60, 130))


# --- the stream ------------------------------------------------------------------------


def stream(lake, landing, tmp_path, **options):
    query = stream_feeds(lake, landing, str(tmp_path / "checkpoint"), LOAD, **options)
    query.awaitTermination()
    assert query.exception() is None


def test_stream_equals_batch(spark, lake, landing, tmp_path):
    """Files arrive out of name order."""
    for day, ids in [(3, [1, 3]), (1, [1, 2]), (2, [2])]:
        put(landing, name(day), feed(*[item(i, title=f"d{day}") for i in ids]))
    stream(lake, landing, tmp_path)
    other = jobs.Lake(spark, str(tmp_path / "other"))
    ingest(other, landing)
    assert state(lake.silver) == state(other.silver) == [(1, "d3", name(3)), (3, "d3", name(3))]
    assert ledger(lake) == ledger(other)


def test_stream_goes_on_where_it_stopped(lake, landing, tmp_path):
    put(landing, name(1), feed(item(1), item(2)))
    stream(lake, landing, tmp_path)
    stream(lake, landing, tmp_path)
    assert lake.silver.version == 1
    put(landing, name(2), feed(item(2, title="b")))
    stream(lake, landing, tmp_path)
    assert state(lake.silver) == [(2, "b", name(2))] and lake.silver.version == 2
    put(landing, name(3), feed())
    stream(lake, landing, tmp_path)
    assert state(lake.silver) == [] and ledger(lake)[name(3)] == "processed"


def test_stream_archives_what_it_has_used(lake, landing, tmp_path):
    archive = tmp_path / "processed"
    for day in (1, 2, 3):
        put(landing, name(day), feed(item(day)))
        stream(lake, landing, tmp_path, archive=str(archive))
    assert state(lake.silver) == [(3, "T", name(3))]
    moved = {p.name for p in archive.rglob("*.xml")}
    assert name(1) in moved and name(3) not in moved


def test_stream_takes_old_late_and_changed_files_like_a_batch(spark, lake, landing, tmp_path):
    other = jobs.Lake(spark, str(tmp_path / "other"))

    def both():
        stream(lake, landing, tmp_path)
        ingest(other, landing)
        assert state(lake.silver) == state(other.silver)
        return state(lake.silver)

    put(landing, f"{name(1)}/part-0.xml", feed(item(1)))
    assert both() == [(1, "T", name(1))]
    old = put(landing, f"{name(1)}/part-1.xml", feed(item(2)))
    long_ago = Path(old).stat().st_mtime - 30 * 86400
    os.utime(old, (long_ago, long_ago))
    assert both() == [(1, "T", name(1)), (2, "T", name(1))]
    put(landing, f"{name(1)}/part-1.xml", feed(item(2, title="again"), item(3)))
    assert both() == [(1, "T", name(1)), (2, "again", name(1)), (3, "T", name(1))]
    assert lake.silver.version == other.silver.version == 3


def test_names_that_need_escapes_do_not_empty_the_tables(lake, landing):
    put(landing, "a b.xml", feed(item(1)))
    put(landing, "a%20c+é.xml", feed(item(1), item(2)))
    report, _ = jobs.run(lake, landing, LOAD)
    assert report.processed == 2
    assert state(lake.mirror) == [(1, "T", "a%20c+é.xml"), (2, "T", "a%20c+é.xml")]
    assert {r.record_source: r.n_items for r in lake.ledger().collect()} == {"a b.xml": 1, "a%20c+é.xml": 2}


def test_items_of_an_unknown_file_stop_the_run(lake, landing, monkeypatch):
    put(landing, name(1), feed(item(1)))
    real = jobs.scan_feeds
    monkeypatch.setattr(jobs, "scan_feeds", lambda *a: real(*a).withColumn("record_source", F.lit("strange.xml")))
    with pytest.raises(ValueError, match="strange.xml"):
        ingest(lake, landing)
    assert lake.silver.version == 0


def test_used_files_can_be_moved_away(lake, landing, tmp_path):
    put(landing, name(1), feed(item(1)))
    put(landing, f"{name(2)}/part 0.xml", feed(item(2)))
    put(landing, name(3), feed(item(3, start="never")))
    with pytest.raises(jobs.FeedRejected):
        jobs.run(lake, landing, LOAD, archive=str(tmp_path / "done"))
    assert sorted(p.name for p in (tmp_path / "done").iterdir()) == [name(1), name(2)]
    assert [p.name for p in Path(landing).iterdir() if not p.name.startswith(".")] == [name(3)]


def test_store_that_drifted_is_cleaned(spark, lake, landing, tmp_path):
    """The store holds a row that no run has put there, and lacks one that the mirror has."""
    from pyspark import cloudpickle

    import test_jobs

    cloudpickle.register_pickle_by_value(test_jobs)
    folder = tmp_path / "store"
    folder.mkdir()
    path = str(folder)
    put(landing, name(1), feed(item(1), item(2)))
    jobs.run(lake, landing, LOAD, open_store=lambda: FolderStore(path))
    (folder / "77").write_text("{}")
    (folder / "1").unlink()
    held = spark.createDataFrame([(int(p.name),) for p in folder.iterdir()], "event_id int")
    report = jobs.sync_mirror(lake, lambda: FolderStore(path), held)
    assert (report.n_deleted, report.n_put) == (1, 2)
    assert sorted(p.name for p in folder.iterdir()) == ["1", "2"]
    assert [r.event_id for r in lake.removed.read().collect()] == [77]


def test_catalog_follows_the_runs(spark, landing, tmp_path):
    lake = jobs.Lake(spark, str(tmp_path / "lake"), silver_name="silver_now", mirror_name="mirror_now")
    try:
        for day in (1, 2):
            put(landing, name(day), feed(item(day)))
            jobs.run(lake, landing, LOAD)
            for view in ("silver_now", "mirror_now"):
                assert [r.event_id for r in spark.sql(f"SELECT event_id FROM {view}").collect()] == [day]
    finally:
        spark.sql("DROP VIEW IF EXISTS silver_now")
        spark.sql("DROP VIEW IF EXISTS mirror_now")


def test_plan_shuffles_each_side_once(spark, capsys):
    rows = [(i, str(i)) for i in range(50)]
    current, desired = (spark.createDataFrame(rows, "event_id int, title string") for _ in range(2))
    sync_plan(current, desired).explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Scan ExistingRDD") == 2 and "Join" not in plan


def test_ledger_grows(spark, tmp_path):
    rows = spark.createDataFrame([("f1", "processed", 1, 0, LOAD, "s")], tables.schemas.LEDGER)
    tables.append_ledger(rows, str(tmp_path / "l"))
    tables.append_ledger(rows.withColumn("record_source", F.lit("f2")), str(tmp_path / "l"))
    assert tables.read_ledger(spark, str(tmp_path / "l")).count() == 2
    assert tables.read_ledger(spark, str(tmp_path / "none")).isEmpty()
