"""An external keyed store as a Spark source and sink, through Spark's Python data source API.

    register_store(spark, "events_store", lambda: Client(...), SILVER)
    spark.read.format("events_store").load().filter("event_id >= 1000")
    plan.write.format("events_store").mode("append").save()

Reading cuts the keys into ranges, one per task; conditions on the key narrow them before the store is asked.
Spark keeps the conditions with the loaded source: parts of one query that ask for different keys need a ``load()`` each.
Writing sends a plan (``op`` and the row) in batches from the tasks; each reports what it
has sent, and the store is told once whether all of them came through. Deletes and puts can be repeated, so a
task or a run that is done twice ends in the same state, and an aborted write is mended by the next.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import batched
from typing import Protocol

from pyspark.sql import Row, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceWriter,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
    WriterCommitMessage,
)
from pyspark.sql.types import StructField, StructType

from feedlake.operators.sync import DELETE, PUT, KeyedStore
from feedlake.schemas import KEY

BATCH = 25
RANGES = 64


class ScannableStore(KeyedStore, Protocol):
    """Client of a store that can be read as well; opened where it is needed, in the tasks."""

    def bounds(self) -> tuple[int, int] | None:
        """The smallest and the greatest key; None for an empty store."""

    def scan(self, low: int, high: int) -> Iterator[dict]:
        """The rows of the keys from ``low`` to ``high``, both included."""

    def finished(self, puts: int, deletes: int, whole: bool) -> None:
        """Called once after a write: what was sent, and whether all tasks came through."""


@dataclass
class KeyRange(InputPartition):
    low: int
    high: int


@dataclass
class Sent(WriterCommitMessage):
    puts: int
    deletes: int


def ranges_of(low: int, high: int, n: int) -> list[KeyRange]:
    """``n`` ranges at most that cover each key from ``low`` to ``high`` once."""
    width = max(-(-(high - low + 1) // n), 1)
    return [KeyRange(at, min(at + width - 1, high)) for at in range(low, high + 1, width)]


class _Reader(DataSourceReader):
    def __init__(self, schema: StructType, open_store: Callable[[], ScannableStore], key: str, ranges: int):
        self.names, self.open_store, self.key, self.ranges = schema.names, open_store, key, ranges
        self.low: int | None = None
        self.high: int | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Keys narrow the ranges; a list of keys narrows them and is checked by Spark as well."""
        for f in filters:
            if getattr(f, "attribute", None) != (self.key,):
                yield f
                continue
            match f:
                case EqualTo(value=v):
                    self._narrow(v, v)
                case GreaterThan(value=v):
                    self._narrow(v + 1, None)
                case GreaterThanOrEqual(value=v):
                    self._narrow(v, None)
                case LessThan(value=v):
                    self._narrow(None, v - 1)
                case LessThanOrEqual(value=v):
                    self._narrow(None, v)
                case In(value=values) if values:
                    self._narrow(min(values), max(values))
                    yield f
                case _:
                    yield f

    def _narrow(self, low: int | None, high: int | None) -> None:
        if low is not None:
            self.low = low if self.low is None else max(self.low, low)
        if high is not None:
            self.high = high if self.high is None else min(self.high, high)

    def partitions(self) -> list[KeyRange]:
        store = self.open_store()
        try:
            bounds = store.bounds()
        finally:
            store.close()
        if bounds is not None:
            low = bounds[0] if self.low is None else max(bounds[0], self.low)
            high = bounds[1] if self.high is None else min(bounds[1], self.high)
            if low <= high:
                return ranges_of(low, high, self.ranges)
        # Spark wants a partition: one that covers no key.
        return [KeyRange(0, -1)]

    def read(self, partition: KeyRange) -> Iterator[tuple]:
        if partition.low > partition.high:
            return
        store = self.open_store()
        try:
            for row in store.scan(partition.low, partition.high):
                yield tuple(row.get(name) for name in self.names)
        finally:
            store.close()


class _Writer(DataSourceWriter):
    def __init__(self, open_store: Callable[[], ScannableStore], key: str, batch: int):
        self.open_store, self.key, self.batch = open_store, key, batch

    def write(self, iterator: Iterator[Row]) -> Sent:
        store, puts, deletes = self.open_store(), 0, 0
        try:
            for chunk in batched(iterator, self.batch):
                rows = [row.asDict() for row in chunk]
                gone = [row[self.key] for row in rows if row["op"] == DELETE]
                here = [{k: v for k, v in row.items() if k != "op"} for row in rows if row["op"] == PUT]
                if gone:
                    store.delete_many(gone)
                if here:
                    store.put_many(here)
                puts, deletes = puts + len(here), deletes + len(gone)
        finally:
            store.close()
        return Sent(puts, deletes)

    def _finished(self, messages: list[Sent | None], whole: bool) -> None:
        sent = [m for m in messages if m is not None]
        store = self.open_store()
        try:
            store.finished(sum(m.puts for m in sent), sum(m.deletes for m in sent), whole)
        finally:
            store.close()

    def commit(self, messages: list[Sent | None]) -> None:
        self._finished(messages, True)

    def abort(self, messages: list[Sent | None]) -> None:
        self._finished(messages, False)


def register_store(
    spark: SparkSession, name: str, open_store: Callable[[], ScannableStore], schema: StructType, key: str = KEY, ranges: int = RANGES, batch: int = BATCH
) -> None:
    """Make a store known to this session as a format ``name``.

    ``open_store`` travels to the tasks: it should build its client there, not carry one. ``key`` is an integer
    column. A read gives the columns of ``schema``; NULL where the store has none.
    """
    columns = StructType([StructField(f.name, f.dataType) for f in schema])

    class Store(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> StructType:
            return columns

        def reader(self, schema: StructType) -> DataSourceReader:
            return _Reader(schema, open_store, key, ranges)

        def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
            if overwrite:
                raise ValueError("a store is written by plans: use mode('append')")
            return _Writer(open_store, key, batch)

    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Store)
