"""Mirroring the current-state table into a keyed serving table."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import batched
from typing import Protocol

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from feedlake.operators.latest import free_name
from feedlake.schemas import KEY

DELETE, PUT = "delete", "put"


def removed_rows(current: DataFrame, desired: DataFrame, key: str = KEY) -> DataFrame:
    """Rows of ``current`` whose key ``desired`` no longer has."""
    return current.join(desired.select(key), key, "left_anti").select(current.columns)


def _last_side(sides: list[DataFrame], key: str) -> tuple[DataFrame, str]:
    """A row per key, that of the last side that has it, and the name of a column with its number.

    One aggregate over all sides: each is shuffled once, reduced by key before.
    """
    columns = sides[0].columns
    side, row = free_name(columns, "side"), free_name(columns, "row")
    rows = reduce(DataFrame.unionByName, [s.select(*columns, F.lit(i).alias(side)) for i, s in enumerate(sides)])
    others = [c for c in columns if c != key]
    best = rows.groupBy(key).agg(F.max_by(F.struct(*others), side).alias(row), F.max(side).alias(side))
    return best.select(key, f"{row}.*", side), side


def sync_plan(current: DataFrame, desired: DataFrame, key: str = KEY) -> DataFrame:
    """What makes ``current`` equal ``desired``: an ``op`` column, then the row.

    A delete for every removed row, a put for every desired one. Both inputs have unique keys.
    """
    both, side = _last_side([current, desired.select(current.columns)], key)
    op = F.when(F.col(side) == 0, DELETE).otherwise(PUT)
    return both.select(*current.columns, op.alias("op"))


def apply_plan(current: DataFrame, plan: DataFrame, key: str = KEY) -> DataFrame:
    """The table after the plan: named keys leave, put rows come in whole."""
    columns = current.columns
    both, side = _last_side([current.withColumn("op", F.lit(PUT)), plan.select(*columns, "op")], key)
    return both.filter(F.col("op") == PUT).select(columns)


def sync_counts(plan: DataFrame) -> DataFrame:
    """Number of rows per op."""
    return plan.groupBy("op").agg(F.count("*").alias("n_rows"))


def removed_preview(removed: DataFrame, key: str = KEY, rows: int = 20) -> DataFrame:
    """The first removed rows by key, for the log."""
    return removed.orderBy(key).limit(rows)


class KeyedStore(Protocol):
    """Client of an external keyed table; opened once per partition, on the executor."""

    def delete_many(self, keys: list) -> None: ...

    def put_many(self, rows: list[dict]) -> None: ...

    def close(self) -> None: ...


def push_plan(
    plan: DataFrame, open_store: Callable[[], KeyedStore], key: str = KEY, batch_size: int = 25
) -> None:
    """Send a plan to an external store in batches, from the executors.

    Deletes and puts name different keys, and each is idempotent: a task that runs twice, or
    a whole run repeated, ends in the same state.
    """

    def send(rows: Iterator[Row]) -> None:
        store = open_store()
        try:
            for chunk in batched(rows, batch_size):
                gone = [row[key] for row in chunk if row["op"] == DELETE]
                here = [row.asDict() for row in chunk if row["op"] == PUT]
                if gone:
                    store.delete_many(gone)
                if here:
                    store.put_many([{k: v for k, v in r.items() if k != "op"} for r in here])
        finally:
            store.close()

    plan.foreachPartition(send)
