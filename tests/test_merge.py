"""Latest row, merge and fold, against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from feedlake.operators.keyed import restrict
from feedlake.operators.latest import latest_per_key, latest_per_key_window
from feedlake.operators.merge import fold_snapshots, merge_snapshot
from feedlake.operators.validate import drop_bad_files, file_status
from feedlake.schemas import SILVER

SCHEMA = "event_id int, title string, record_source string, load_date string"
EARLY, LATE = "2024-01-01T00:00:00+00:00", "2024-01-02T00:00:00+00:00"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(params=[latest_per_key, latest_per_key_window])
def latest(request):
    return request.param


def test_latest(spark, latest):
    df = frame(spark, [(1, "a", "f1", EARLY), (1, "b", "f2", EARLY), (2, "c", "f1", LATE), (1, "d", "f1", LATE)])
    assert rows_of(latest(df, "event_id")) == [(1, "b", "f2", EARLY), (2, "c", "f1", LATE)]


def test_same_file_loaded_twice_keeps_the_first_load(spark, latest):
    df = frame(spark, [(1, "a", "f1", LATE), (1, "a", "f1", EARLY)])
    assert rows_of(latest(df, "event_id")) == [(1, "a", "f1", EARLY)]


def test_load_order_is_by_time_not_by_text(spark, latest):
    df = frame(spark, [(1, "later", "f1", "2024-01-01T00:30:00+00:00"), (1, "sooner", "f1", "2024-01-01T01:00:00+01:00")])
    assert rows_of(latest(df, "event_id"))[0][1] == "sooner"


def test_id_twice_in_one_file_is_settled_the_same_way_each_time(spark, latest):
    rows = [(1, f"t{i}", "f1", EARLY) for i in range(20)]
    picks = set()
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        picks |= set(rows_of(latest(frame(spark, rows).repartition(seed + 1), "event_id")))
    assert len(picks) == 1


def test_both_forms_agree_on_a_hot_key(spark):
    """A third of the rows on one key, many ties."""
    ids = spark.range(30_000)
    df = ids.select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 997).cast("int").alias("event_id"),
        F.concat(F.lit("t"), F.col("id") % 50).alias("title"),
        F.concat(F.lit("f"), F.col("id") % 7).alias("record_source"),
        F.lit(EARLY).alias("load_date"),
    )
    assert rows_of(latest_per_key(df, "event_id")) == rows_of(latest_per_key_window(df, "event_id"))


def test_hot_key_is_reduced_before_the_shuffle(spark, capsys):
    df = frame(spark, [(1, "a", "f1", EARLY)])
    latest_per_key(df, "event_id").explain()
    plan = capsys.readouterr().out
    assert plan.index("partial_max_by") > plan.index("Exchange hashpartitioning(event_id")
    assert plan.count("Exchange hashpartitioning") == 1
    merge_snapshot(df, df).explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_merge_keeps_the_keys_of_new_only(spark):
    existing = frame(spark, [(1, "old", "f1", EARLY), (2, "gone", "f1", EARLY), (3, "newer", "f9", EARLY)])
    new = frame(spark, [(1, "new", "f2", LATE), (3, "late", "f2", LATE), (4, "added", "f2", LATE)])
    want = [(1, "new", "f2", LATE), (3, "newer", "f9", EARLY), (4, "added", "f2", LATE)]
    assert rows_of(merge_snapshot(existing, new)) == want


def test_merge_matches_columns_by_name(spark):
    existing = frame(spark, [(1, "old", "f1", EARLY)])
    new = frame(spark, [(1, "new", "f2", LATE)]).select("load_date", "record_source", "title", "event_id")
    assert rows_of(merge_snapshot(existing, new)) == [(1, "new", "f2", LATE)]


def test_merge_with_nothing(spark):
    some, none = frame(spark, [(1, "a", "f1", EARLY)]), frame(spark, [])
    assert rows_of(merge_snapshot(none, some)) == [(1, "a", "f1", EARLY)]
    assert rows_of(merge_snapshot(some, none)) == []


def python_fold(existing, files):
    """One file after the other; a row is (id, title, file, load)."""
    table = {row[0]: row for row in existing}
    for name in sorted(files):
        step = {}
        for row in files[name]:
            rivals = [row, *([table[row[0]]] if row[0] in table else []), *([step[row[0]]] if row[0] in step else [])]
            top = max(r[2] for r in rivals)
            step[row[0]] = min((r for r in rivals if r[2] == top), key=lambda r: r[3])
        table = step
    return sorted(table.values())


@pytest.mark.parametrize("seed", range(12))
def test_fold_in_one_pass_equals_file_after_file(spark, seed):
    """Many small cases at once: the case number is part of the id."""
    draw = random.Random(seed)
    n_files = draw.randint(1, 5)
    names = [f"f{2 * i + 2:02d}" for i in range(n_files)]
    existing, files, want = [], {name: [] for name in names}, []
    for case in range(150):
        ids = [case * 10 + k for k in range(4)]
        mine = [
            (i, "old", f"f{draw.randint(1, 2 * n_files + 2):02d}", EARLY) for i in ids if draw.random() < 0.7
        ]
        batch = {name: [(i, "new", name, LATE) for i in ids if draw.random() < 0.75] for name in names}
        existing += mine
        for name in names:
            files[name] += batch[name]
        want += python_fold(mine, batch)
    batch = frame(spark, [row for rows in files.values() for row in rows])
    got = fold_snapshots(frame(spark, existing), batch, names[-1], n_files)
    assert rows_of(got) == sorted(want)
    loop = frame(spark, existing)
    for name in names:
        loop = merge_snapshot(loop, batch.filter(F.col("record_source") == name))
    assert rows_of(loop) == sorted(want)


def test_fold_over_an_empty_last_file(spark):
    existing, batch = frame(spark, [(1, "a", "f0", EARLY)]), frame(spark, [(1, "b", "f1", LATE)])
    assert rows_of(fold_snapshots(existing, batch, "f2", 2)) == []


def test_fold_over_an_empty_file_on_the_way_forgets_old_rows(spark):
    existing = frame(spark, [(1, "newest", "f9", EARLY)])
    batch = frame(spark, [(1, "x", "f1", LATE), (1, "y", "f3", LATE)])
    assert rows_of(fold_snapshots(existing, batch, "f3", 2)) == [(1, "newest", "f9", EARLY)]
    assert rows_of(fold_snapshots(existing, batch, "f3", 3)) == [(1, "y", "f3", LATE)]


@pytest.mark.parametrize("how", ["left_semi", "left_anti"])
@pytest.mark.parametrize("limit", [0, 100_000])
def test_restrict_by_broadcast_and_by_shuffle(spark, how, limit, capsys):
    rows = [(i % 5 if i % 3 else 0, f"t{i}", "f", EARLY) for i in range(300)]
    keys = frame(spark, [(k, "", "", "") for k in (0, 2, 4, 4, 7)])
    got = restrict(frame(spark, rows), keys, "event_id", how, max_broadcast_bytes=limit)
    got.explain()
    plan = capsys.readouterr().out
    assert ("SortMergeJoin" in plan) == (limit == 0)
    keep = (lambda k: k in (0, 2, 4)) if how == "left_semi" else (lambda k: k not in (0, 2, 4))
    assert rows_of(got) == sorted(r for r in rows if keep(r[0]))
    assert got.columns == ["event_id", "title", "record_source", "load_date"]


def test_files_are_judged_whole(spark):
    df = frame(spark, [(1, "ok", "f1", EARLY), (2, "bad", "f1", EARLY), (3, "ok", "f2", EARLY)])
    bad = F.col("title") == "bad"
    assert rows_of(drop_bad_files(df, bad)) == [(3, "ok", "f2", EARLY)]
    assert rows_of(file_status(df, bad)) == [("f1", 2, 1), ("f2", 1, 0)]


def test_silver_schema_is_the_contract():
    assert SILVER.simpleString() == (
        "struct<event_id:int,title:string,host:string,start_date:date,end_date:date,start_time:string,"
        "end_time:string,event_description:string,location:string,external_link:string,"
        "record_source:string,load_date:string>"
    )
    assert [f.name for f in SILVER if not f.nullable] == ["event_id", "title", "record_source", "load_date"]
