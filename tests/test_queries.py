"""Every query against its SQL, on whole tables."""

import duckdb
import pytest

from __spark_entry__ import entry, feed_queries, feed_sql

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')")
    yield con
    con.close()


def as_rows(names, rows):
    """Columns by name, values as text, any order."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(feed_queries()))
def test_query(spark, duck, name):
    got = feed_queries()[name](spark, SF_DIR)
    rows = got.collect()
    assert rows
    want = duck.execute(feed_sql()[name])
    names = [column[0] for column in want.description]
    assert sorted(got.columns) == sorted(names)
    assert as_rows(got.columns, rows) == as_rows(names, want.fetchall())


def test_every_query_has_an_oracle():
    assert set(feed_sql()) == set(feed_queries())


def test_entry(spark):
    assert entry(spark).count() > 0
