"""A feed is whole or out; files with hidden items are cut in parallel."""

import random
from pathlib import Path

import pytest
from feed_files import HEAD, TAIL, feed, item, name, put
from pyspark.sql import functions as F

from feedlake.operators.automaton import NONE, states_before, transition
from feedlake.plans import jobs
from feedlake.plans.silver import is_bad, judge_items
from feedlake.schemas import ITEM_FIELDS
from feedlake.sources.feeds import file_status, list_feeds, scan_feeds, scan_feeds_exact, scan_feeds_whole
from feedlake.streaming.ingest import stream_feeds

LOAD = "2024-02-01T00:00:00+00:00"

PAGE = "<html><body><h1>502 Bad Gateway</h1></body></html>"
#: What a file may hold, and whether that is a whole feed.
FILES = {
    "whole": (feed(item(1)), True),
    "no items": (feed(), True),
    "closed at once": ('<?xml version="1.0"?><rss version="2.0"/>\n', True),
    "rdf": ('<?xml version="1.0"?>\n<!-- c --><rdf:RDF xmlns:rdf="x">' + item(1) + "</rdf:RDF >\n", True),
    "doctype, byte order mark": ("﻿" + '<?xml version="1.0"?><!DOCTYPE rss [<!ENTITY a "b">]>\n<rss>' + item(1) + TAIL, True),
    "words behind": (feed(item(1)) + "<!-- made in </html> --><?end now?>\n", True),
    "error page": (PAGE, False),
    "page around a feed": ("<html>" + feed(item(1)) + "</html>", False),
    "text": ("moved", False),
    "white space": (" \n", False),
    "other root": ("<rssfeed>" + item(1) + "</rssfeed>", False),
    "atom": ('<feed xmlns="http://www.w3.org/2005/Atom"><entry/></feed>', False),
    "cut behind an item": (HEAD + item(1), False),
    "cut before any item": (HEAD, False),
    "cut in its last tag": (feed(item(1))[:-2], False),
    "end in an open comment": (HEAD + item(1) + "<!-- " + TAIL, False),
    "end in a comment": (HEAD + item(1) + "<!-- " + TAIL + "-->", False),
    "item behind the end": (feed(item(1)) + item(2), False),
    "page, then a feed": (PAGE + feed(item(1)), False),
    "no head": (item(1) + TAIL, False),
}


def small_splits(spark, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")


@pytest.fixture
def splits(spark):
    yield lambda size: small_splits(spark, size)
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("scan", [scan_feeds, scan_feeds_exact])
@pytest.mark.parametrize("size", [None, 200])
def test_whole_feeds_are_told_from_others(spark, tmp_path, splits, scan, size):
    for i, (content, _) in enumerate(FILES.values()):
        put(tmp_path, f"f{i:02d}.xml", content)
    if size:
        splits(size)
    status = {r.record_source: r for r in file_status(judge_items(scan(spark, str(tmp_path), None, True)), is_bad()).collect()}
    said = {kind: status[f"f{i:02d}.xml"] for i, kind in enumerate(FILES)}
    wrong = {kind: r for kind, r in said.items() if (r.n_unsound == 0) != FILES[kind][1] and not r.again}
    assert wrong == {}
    assert {kind for kind, r in said.items() if r.again} <= {"end in an open comment"}
    assert all(r.n_items == FILES[kind][0].count("<item>") for kind, r in said.items() if not r.again)


BROKEN = {"page": PAGE, "nothing": "", "cut": HEAD + item(1), "hidden, cut": HEAD + item(1, extra="<!-- <item> -->")}


def state(table):
    return sorted((r.event_id, r.title, r.record_source) for r in table.read().collect())


@pytest.mark.parametrize("kind, how", [*[(kind, "batch") for kind in BROKEN], ("nothing", "stream"), ("page", "stream")])
def test_what_is_no_whole_feed_changes_nothing(spark, tmp_path, kind, how):
    landing = str(tmp_path / "new")
    lake = jobs.Lake(spark, str(tmp_path / "lake"))

    def go(strict):
        if how == "batch":
            jobs.ingest(lake, landing, LOAD, strict)
        else:
            query = stream_feeds(lake, landing, str(tmp_path / "checkpoint"), LOAD, strict=strict)
            query.awaitTermination()
            if query.exception():
                raise query.exception()
        jobs.sync_mirror(lake)

    put(landing, name(1), feed(item(1), item(2)))
    go(True)
    before = state(lake.silver)
    put(landing, name(2), BROKEN[kind])
    if kind == "page":
        with pytest.raises(Exception, match=name(2)):
            go(True)
        assert state(lake.silver) == state(lake.mirror) == before and len(before) == 2
    go(False)
    assert state(lake.silver) == state(lake.mirror) == before
    ledger = {r.record_source: r for r in lake.ledger().collect()}
    assert (ledger[name(2)].status, ledger[name(2)].n_bad > 0) == ("rejected", True)
    # The same name again, whole this time.
    put(landing, name(2), feed(item(2), item(3)))
    go(True)
    assert [r[0] for r in state(lake.mirror)] == [2, 3]


def test_an_empty_file_is_listed_under_any_name(spark, tmp_path):
    for odd in ("a b.xml", "a%20b.xml", "größe+.xml", "deep/c.xml/part-0.xml", "notes.txt"):
        put(tmp_path, odd, "")
    put(tmp_path, "deep/c.xml/part-1.xml", feed(item(1)))
    listing = list_feeds(spark, str(tmp_path)).collect()
    assert sorted((r.record_source, r.snapshot, r.length > 0) for r in listing) == [
        ("a b.xml", "a b.xml", False), ("a%20b.xml", "a%20b.xml", False), ("c.xml", "deep/c.xml", False),
        ("c.xml", "deep/c.xml", True), ("größe+.xml", "größe+.xml", False),
    ]


def test_one_cut_part_rejects_its_snapshot(spark, tmp_path):
    landing = str(tmp_path / "new")
    lake = jobs.Lake(spark, str(tmp_path / "lake"))
    put(landing, f"{name(1)}/part-0.xml", feed(item(1)))
    put(landing, f"{name(1)}/part-1.xml", HEAD + item(2))
    put(landing, f"{name(2)}/part-0.xml", feed(item(3)))
    put(landing, f"{name(2)}/part-1.xml", feed())
    report = jobs.ingest(lake, landing, LOAD, strict=False)
    assert (report.processed, report.rejected) == (1, 1)
    assert [r[0] for r in state(lake.silver)] == [3]


# --- hidden items, in parallel -----------------------------------------------------------------

HIDING = [
    "<note><![CDATA[an <item> here</item>]]></note>", "<!-- <item><title>no</title></item> -->", "<!-- <![CDATA[ <item> -->",
    "<note><![CDATA[ --> <!-- <item x='1'> </item> & &nbsp; ]]></note>", "<itemized>1 <items/></itemized>", "<note><![CDATA[<item>]]><!--</item>--><![CDATA[<item/>]]></note>",
    "<!---->", "<note><![CDATA[]]></note>", "",
]


def rows_of(items):
    return sorted((r.record_source, *[r[f] for f in ITEM_FIELDS], r._corrupt_record, r.unsplittable) for r in items.collect())


@pytest.mark.parametrize("size", [1009, 1 << 20])
def test_exact_scan_finds_each_item_in_many_splits(spark, tmp_path, splits, size):
    rnd = random.Random(size)
    want = []
    for f in range(3):
        items = [item(1000 * f + i, title=f"t{i}", extra="".join(rnd.choice(HIDING) for _ in range(rnd.randrange(4)))) for i in range(20)]
        between = [rnd.choice(["", "<!-- <item> -->", "<itemCount>3</itemCount>", "\n"]) for _ in items]
        put(tmp_path, name(f + 1), HEAD + "<items>1</items>" + "".join(a + b for a, b in zip(items, between, strict=True)) + TAIL)
        want += [(name(f + 1), f"t{i}", f"https://feed.example.org/event/{1000 * f + i}") for i in range(20)]
    splits(size)
    exact = rows_of(scan_feeds_exact(spark, str(tmp_path)))
    assert [(r[0], r[1], r[2]) for r in exact] == sorted(want)
    assert all(r[-2:] == (None, False) for r in exact)
    splits(1 << 27)
    assert rows_of(scan_feeds_whole(spark, str(tmp_path))) == exact
    status = file_status(judge_items(scan_feeds_exact(spark, str(tmp_path), None, True)), is_bad()).collect()
    assert [(r.n_items, r.n_bad, r.n_unsound, r.again) for r in status] == [(20, 0, 0, False)] * 3


def test_a_file_with_hidden_items_is_read_by_many_tasks(spark, tmp_path, splits):
    put(tmp_path, name(1), feed(*[item(i, extra=HIDING[0]) for i in range(200)]))
    splits(4096)
    chunks = scan_feeds_exact(spark, str(tmp_path))
    assert spark.read.option("lineSep", "<item").text(str(tmp_path)).rdd.getNumPartitions() > 10
    assert chunks.count() == 200
    # The job takes the same way: the file is processed, and nothing reads it as one text.
    lake = jobs.Lake(spark, str(tmp_path / "lake"))
    assert jobs.ingest(lake, str(tmp_path), LOAD).processed == 1
    assert lake.silver.read().count() == 200


def test_a_section_that_never_ends_takes_the_rest(spark, tmp_path):
    put(tmp_path, name(1), HEAD + item(1) + "<item><title>T<!-- " + item(2) + item(3) + TAIL)
    rows = scan_feeds_exact(spark, str(tmp_path)).collect()
    assert sorted(r._corrupt_record is not None for r in rows) == [False, True]
    status = file_status(judge_items(scan_feeds_exact(spark, str(tmp_path), None, True)), is_bad()).first()
    assert (status.n_items, status.n_bad, status.n_unsound) == (2, 1, 1)


@pytest.mark.parametrize("seed", range(4))
def test_automaton_equals_a_loop(spark, seed):
    rnd = random.Random(seed)
    rows, want, row = [], {}, 0
    for sequence in "abcd"[: seed + 1]:
        state, owner, place, block = 0, NONE, 0, 0
        for _ in range(rnd.choice([1, 5, 60])):
            place += rnd.randrange(1, 4)
            block = place if rnd.random() < 0.2 else block
            ends, marked = [rnd.randrange(3) for _ in range(3)], rnd.random() < 0.5
            owner = place if marked and state == 0 else owner
            rows.append((sequence, block, place, transition(ends), marked, row))
            want[row] = (state, owner)
            state, row = ends[state], row + 1
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "sequence string, block long, place long, code long, marks boolean, row long")
    found = states_before(df, 3).collect()
    assert {r.row: (r.state, r.owner) for r in found} == want and len(found) == len(want)
    ordered = sorted(rows, key=lambda r: (r[0], r[2]))
    after = {a[5]: b for a, b in zip(ordered, [*ordered[1:], None], strict=True)}
    for r in found:
        here, there = next(x for x in rows if x[5] == r.row), after[r.row]
        same_block = there is not None and there[:2] == here[:2]
        assert r.alone == (want[r.row][1] == here[2] and same_block and want[there[5]][1] != want[r.row][1])


def test_scan_without_marks_has_items_only(spark, tmp_path):
    put(tmp_path, name(1), PAGE)
    put(tmp_path, name(2), feed(item(1)))
    for scan in (scan_feeds, scan_feeds_exact, scan_feeds_whole):
        assert [r.record_source for r in scan(spark, str(tmp_path)).select("record_source", F.col("title")).collect()] == [name(2)]
    assert Path(tmp_path, name(1)).exists()
