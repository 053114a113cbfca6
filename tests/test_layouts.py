"""Tables laid out by key: merges without a shuffle of what is there, syncs that write what changed."""

import random
from pathlib import Path

import pytest
from feed_files import feed, item, name, put
from pyspark.sql import functions as F

from feedlake.operators.lookup import events_on_date
from feedlake.operators.merge import fold_snapshots, merge_dealt, merge_snapshot, present_in_all
from feedlake.operators.sync import removed_rows
from feedlake.plans import jobs
from feedlake.session import materialize, shared_dir, work_tables
from feedlake.sources.parts import PartTable, Synced, by_range
from feedlake.sources.tables import BucketedTable

LOAD = "2024-02-01T00:00:00+00:00"
SCHEMA = "event_id int, title string, host string, record_source string, load_date string"


def rows_of(spark, ids, source, title="t"):
    return spark.createDataFrame([(i, title, None, source, LOAD) for i in ids], SCHEMA)


def tuples(df):
    return sorted(map(repr, df.collect()))


@pytest.fixture
def table(spark, tmp_path):
    return BucketedTable(spark, str(tmp_path / "it's a table"), rows_of(spark, [], "").schema, buckets=4)


# --- buckets ---------------------------------------------------------------------------------


def test_merge_shuffles_only_what_comes_new(spark, table, capsys):
    first, new = rows_of(spark, range(50), "f1"), rows_of(spark, range(30, 70), "f2", "n")
    assert table.write(table.dealt(first)) == 1
    existing = table.read()
    assert tuples(existing) == tuples(first)
    merged = merge_dealt(existing, table.dealt(new))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    merged.explain()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    plan = capsys.readouterr().out
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan
    # The one exchange is the last step above the new rows.
    assert plan.index("Bucketed: true") < plan.index("Exchange") < plan.index("ExistingRDD")
    assert tuples(merged) == tuples(merge_snapshot(first, new))
    # The next version is made out of the one that is read, and may have other buckets.
    wider = BucketedTable(spark, table.root, table.schema, buckets=7)
    assert wider.write(wider.dealt(merged)) == 2
    assert tuples(table.read()) == tuples(new)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("feedlake_")]


def test_two_tables_meet_without_a_shuffle(spark, table, tmp_path, capsys):
    other = BucketedTable(spark, str(tmp_path / "other"), table.schema, buckets=4)
    table.write(table.dealt(rows_of(spark, range(20), "f1")))
    other.write(other.dealt(rows_of(spark, range(10, 30), "f1")))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    gone = removed_rows(table.read(), other.read())
    gone.explain()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in capsys.readouterr().out
    assert sorted(r.event_id for r in gone.collect()) == list(range(10))


@pytest.mark.parametrize("seed", range(3))
def test_both_merges_agree(spark, seed):
    rnd = random.Random(seed)
    loads = [LOAD, "2024-02-03T00:00:00+00:00"]
    row = lambda i: (i, rnd.choice("ab"), rnd.choice([None, "h"]), rnd.choice(["f1", "f2"]), rnd.choice(loads))
    existing = spark.createDataFrame([row(i) for i in range(0, 40)], SCHEMA)
    new = spark.createDataFrame([row(rnd.randrange(20, 60)) for _ in range(60)], SCHEMA)
    assert tuples(merge_dealt(existing, new)) == tuples(merge_snapshot(existing, new))


def test_empty_and_missing_versions(spark, table):
    assert table.read().isEmpty() and table.version == 0
    table.write(rows_of(spark, [], "f"))
    assert table.read().isEmpty() and table.version == 1


def test_fold_over_a_bucketed_table(spark, table):
    table.write(table.dealt(rows_of(spark, [1, 2, 3], "f9", "nine")))
    batch = rows_of(spark, [1, 2, 4], "f1").union(rows_of(spark, [1, 4], "f2")).union(rows_of(spark, [1, 2, 5], "f3"))
    folded = fold_snapshots(table.read(), table.dealt(batch), "f3", 3, merge=merge_dealt)
    assert sorted((r.event_id, r.record_source) for r in folded.collect()) == [(1, "f9"), (2, "f3"), (5, "f3")]


def test_ids_of_ten_thousand_files(spark):
    rows = spark.range(30_000).select((F.col("id") % 3).alias("event_id"), F.concat(F.lit("f"), (F.col("id") % 10_000).cast("string")).alias("record_source"))
    lacks = rows.filter("event_id <> 1 OR record_source <> 'f77'")
    twice = lacks.union(lacks.limit(100))
    everywhere = rows.select("record_source").distinct().select(F.lit(9).cast("long").alias("event_id"), "record_source")
    found = present_in_all(twice.union(everywhere), 10_000, "event_id", "record_source")
    assert sorted(r.event_id for r in found.collect()) == [0, 2, 9]


def test_lake_with_buckets_and_deltas_equals_a_plain_one(spark, tmp_path):
    landing = str(tmp_path / "new")
    plain = jobs.Lake(spark, str(tmp_path / "plain"))
    laid = jobs.Lake(spark, str(tmp_path / "laid"), buckets=3, deltas=True)
    days = {5: [1, 2, 3], 3: [1, 4], 7: []}
    before = set(Path(shared_dir(spark)).glob("feedlake/*"))
    for day, ids in days.items():
        put(landing, name(day), feed(*[item(i, title=f"d{day}") for i in ids]))
        a, b = (jobs.run(lake, landing, LOAD) for lake in (plain, laid))
        assert a[0].processed == b[0].processed == 1 and a[1].n_deleted == b[1].n_deleted
        assert tuples(laid.silver.read()) == tuples(plain.silver.read()) == tuples(laid.ranges.read()) == tuples(plain.mirror.read())
        assert tuples(laid.removed.read()) == tuples(plain.removed.read())
        assert tuples(laid.by_date.read_part("2024-05-07")) == tuples(plain.mirror.read())
    assert set(Path(shared_dir(spark)).glob("feedlake/*")) <= before


# --- parts -------------------------------------------------------------------------------------


def files_of(table):
    return {str(p.relative_to(table.root)): p.stat().st_mtime_ns for p in Path(table.root).rglob("part-*.parquet")}


def test_one_changed_row_writes_one_folder(spark, tmp_path):
    table = PartTable(spark, str(tmp_path / "t"), rows_of(spark, [], "").schema, part=by_range(width=10))
    assert table.read().isEmpty()
    first = rows_of(spark, range(-5, 45), "f1")
    assert table.sync(first) == Synced(0, 50, 6)
    before = files_of(table)
    second = first.withColumn("host", F.when(F.col("event_id") == 17, "new"))
    assert table.sync(second) == Synced(0, 1, 1)
    after = files_of(table)
    changed = {f for f in before | after if before.get(f) != after.get(f)}
    assert {f.split("/")[1] for f in changed} == {"part=1"}
    assert tuples(table.read()) == tuples(second)
    assert table.sync(second) == Synced(0, 0, 0) and files_of(table) == after
    # All rows of one folder go, a row of another.
    third = second.filter("event_id not between 20 and 29 and event_id <> 3")
    assert table.sync(third) == Synced(11, 0, 2)
    assert tuples(table.read()) == tuples(third) and not any("part=2/" in f for f in files_of(table))
    assert table.sync(third.limit(0)) == Synced(39, 0, 5) and table.read().isEmpty()


def test_values_that_move_between_columns_are_a_change(spark, tmp_path):
    table = PartTable(spark, str(tmp_path / "t"), rows_of(spark, [], "").schema)
    table.sync(spark.createDataFrame([(1, "x", None, "f", LOAD)], SCHEMA))
    moved = spark.createDataFrame([(1, None, "x", "f", LOAD)], SCHEMA)
    assert table.sync(moved) == Synced(0, 1, 1) and tuples(table.read()) == tuples(moved)


@pytest.mark.parametrize("seed", range(2))
def test_random_syncs_by_a_part_that_moves(spark, tmp_path, seed):
    """The folder is that of the title, which changes: a row leaves one folder and comes to another."""
    rnd = random.Random(seed)
    table = PartTable(spark, str(tmp_path / "t"), rows_of(spark, [], "").schema, part=F.col("title"))
    held = {}
    for _ in range(4):
        want = {i: rnd.choice("abc=%") for i in range(12) if rnd.random() < 0.7}
        rows = spark.createDataFrame([(i, t, None, "f", LOAD) for i, t in want.items()], SCHEMA)
        done = table.sync(rows)
        assert done.n_deleted == len(held.keys() - want.keys()) and done.n_put == sum(held.get(i) != t for i, t in want.items())
        assert tuples(table.read()) == tuples(rows)
        held = want


def test_a_sync_that_died_halfway_is_mended(spark, tmp_path, monkeypatch):
    table = PartTable(spark, str(tmp_path / "t"), rows_of(spark, [], "").schema, part=by_range(width=10))
    table.sync(rows_of(spark, range(40), "f1"))
    wanted = rows_of(spark, [*range(5), *range(20, 60)], "f2")
    # Two of the folders were written before the job was lost.
    half = wanted.filter("event_id >= 30").withColumn("part", by_range(width=10))
    half.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(f"{table.root}/data")
    table.sync(wanted)
    assert tuples(table.read()) == tuples(wanted)


def test_lookup_by_date_reads_one_folder(spark, tmp_path, capsys):
    landing = str(tmp_path / "new")
    lake = jobs.Lake(spark, str(tmp_path / "lake"), deltas=True)
    starts = [f"Tue, {d:02d} May 2024 1{d % 3}:00:00 GMT" for d in range(1, 9)] + ["9 May 2024"]
    put(landing, name(1), feed(*[item(i, start=s) for i, s in enumerate(starts)]))
    jobs.run(lake, landing, LOAD)
    day = lake.by_date.read_part("2024-05-03")
    day.explain()
    assert "PartitionFilters: [isnotnull(part" in capsys.readouterr().out
    assert [r.event_id for r in events_on_date(day, F.lit("2024-05-03").cast("date")).collect()] == [2]
    assert lake.by_date.read().count() == 8


def test_external_store_gets_changes_only(spark, tmp_path, monkeypatch):
    landing, sent = str(tmp_path / "new"), []
    lake = jobs.Lake(spark, str(tmp_path / "lake"), deltas=True)
    monkeypatch.setattr(jobs, "push_plan", lambda plan, store: sent.append(sorted((r.event_id, r.op) for r in plan.collect())))
    put(landing, name(1), feed(item(1), item(2), item(3)))
    jobs.run(lake, landing, LOAD, open_store=dict)
    report = jobs.sync_mirror(lake, dict)
    assert report == jobs.SyncReport(0, 0)
    assert sent == [[(1, "put"), (2, "put"), (3, "put")], []]


# --- work tables -------------------------------------------------------------------------------


def test_work_tables_go_also_after_an_error(spark):
    place = Path(shared_dir(spark).removeprefix("file:"))
    outside = materialize(spark.range(3), "stays")
    with pytest.raises(ZeroDivisionError), work_tables(spark):
        materialize(spark.range(3), "goes")
        with work_tables(spark):
            materialize(spark.range(3), "goes")
        1 / 0  # noqa: B018
    assert not list(place.glob("feedlake/goes-*")) and outside.count() == 3


def test_sync_counts_no_table_twice(spark, tmp_path, monkeypatch):
    landing = str(tmp_path / "new")
    lake = jobs.Lake(spark, str(tmp_path / "lake"))
    put(landing, name(1), feed(item(1), item(2)))
    jobs.ingest(lake, landing, LOAD)
    jobs.sync_mirror(lake)
    put(landing, name(2), feed(item(2)))
    jobs.ingest(lake, landing, LOAD)
    monkeypatch.setattr(type(lake.silver.read()), "count", lambda self: pytest.fail("counted"))
    assert jobs.sync_mirror(lake) == jobs.SyncReport(1, 1, 2)
