"""Feeds folded into the state of a stream, so that a new table is made without reading the one before.

Feeds are kept in a log, in the order in which they were applied, each under a running number. A stream
over the log holds, for each id, the winning row and the number of the last feed that had it. An id
that the feed before did not have has been removed in between, so its old row is forgotten; otherwise the
greater row stays. The table after a feed is what that feed had: only these rows leave the stream.

The result equals ``fold_snapshots`` and the batch job, also for feeds that come out of name order, are empty, or
are put again. State lies with Spark's own state store, in as many parts as ``spark.sql.shuffle.partitions``
says when a checkpoint is first used; it keeps ids that have gone, as they may come back.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from feedlake.operators.latest import newest_order
from feedlake.plans.jobs import IngestReport, Lake, changed_files, feed_rows, ingest
from feedlake.schemas import KEY, OPEN_SILVER
from feedlake.session import materialize, work_tables
from feedlake.sources.tables import SnapshotTable
from feedlake.streaming.ingest import MAX_AGE_DAYS

#: Times to the microsecond.
JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class FeedLog:
    """Rows of feeds below ``root``, a folder for each batch that was applied.

    ``newest``: texts and whole numbers that make a row greater than another of its id. A row lies there as (feed_no, feed,
    again, key, newest0, newest1, ..., row), the last as JSON, since states hold plain values only; each feed has
    one more without a key, so that an empty feed is seen. A folder is written aside and renamed when it is whole, on a file system where that is one step. One writer at a time.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType = OPEN_SILVER, key: str = KEY, newest: list[Column] | None = None):
        self.spark, self.root, self.schema, self.key = spark, root, schema, key
        self.newest = newest or newest_order(schema.names)

    def _place(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _system(self):
        return self._place(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration())

    @property
    def last(self) -> int:
        """The number of the last feed, 0 if there is none."""
        place = self._place(f"{self.root}/feeds")
        if not self._system().exists(place):
            return 0
        names = [s.getPath().getName() for s in self._system().listStatus(place)]
        return max((int(n.rpartition("-")[2]) for n in names if re.fullmatch("[0-9]+-[0-9]+", n)), default=0)

    def append(self, rows: DataFrame, feeds: DataFrame, feed: str = "record_source") -> int:
        """Add the feeds named by the column ``feed`` of ``feeds``, in name order; the number of the last.

        ``rows`` holds their rows, each with the name of its feed in the column ``feed``. A true ``again`` beside a name says that
        the feed was there before and its rows replace their older selves.
        """
        begin = self.last
        again = F.col("again") if "again" in feeds.columns else F.lit(False)
        # A row per feed of one batch: short, whatever the feeds hold.
        names = feeds.select(F.col(feed).alias("feed"), again.alias("again"))
        names = materialize(names.withColumn("feed_no", begin + F.row_number().over(W.orderBy("feed")).cast("bigint")), "numbers")
        n_feeds = names.count()
        if not n_feeds:
            return begin
        row = F.to_json(F.struct(*self.schema.names), JSON | {"ignoreNullFields": "false"})
        order = [c.alias(f"newest{i}") for i, c in enumerate(self.newest)]
        held = rows.select(F.col(feed).alias("feed"), F.col(self.key).alias("key"), *order, row.alias("row"))
        numbered = ["feed_no", "feed", "again"]
        logged = held.join(names, "feed").select(*numbered, *held.columns[1:])
        marks = names.select(*numbered, *[F.lit(None).cast(held.schema[c].dataType).alias(c) for c in held.columns[1:]])
        aside = f"{self.root}/aside/{uuid.uuid4().hex}"
        logged.unionByName(marks).write.parquet(aside)
        place = self._place(f"{self.root}/feeds/{begin + 1:012d}-{begin + n_feeds:012d}")
        self._system().mkdirs(place.getParent())
        if self._system().exists(place) or not self._system().rename(self._place(aside), place):
            raise OSError(f"{place} cannot be made: another writer was there first")
        return begin + n_feeds

    def rows(self, logged: DataFrame) -> DataFrame:
        """What ``append`` was given, from the column ``row``."""
        return logged.select(F.from_json("row", self.schema, JSON).alias("row")).select("row.*")

    def stream(self) -> DataFrame:
        """The log as a stream; there has to be a feed in it."""
        schema = self.spark.read.parquet(f"{self.root}/feeds/*").schema
        return self.spark.readStream.schema(schema).option("maxFileAge", f"{MAX_AGE_DAYS}d").parquet(f"{self.root}/feeds/*")


class SnapshotFold(StatefulProcessor):
    """For an id: the last feed that had it, and the winning row with its feed and order."""

    def __init__(self, schema: T.StructType):
        self.schema = schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("held", self.schema)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        if key[0] is None:
            yield Row(feed_no=max(row.feed_no for row in rows), row=None)
            return
        # A row per feed, however often a feed repeats the id.
        best: dict[int, tuple] = {}
        again = set()
        for row in rows:
            came = (int(row.feed_no), *[row[c] for c in self.schema.names[1:]])
            if row.again:
                again.add(came[0])
            if came[0] not in best or _order(came) > _order(best[came[0]]):
                best[came[0]] = came
        held = tuple(self.held.get()) if self.held.exists() else None
        for no, came in sorted(best.items()):
            stays = held is not None and held[0] >= no - 1 and not (no in again and held[1] == came[1])
            held = (no, *held[1:]) if stays and _order(held) > _order(came) else came
        self.held.update(held)
        yield Row(feed_no=held[0], row=held[-1])

    def close(self) -> None:
        pass


def _order(held: tuple) -> tuple:
    """What makes a row (feed_no, feed, newest..., row) the greater one; NULL comes before all else."""
    return tuple((value is not None, value) for value in held[2:-1])


def fold_log(log: FeedLog, table: SnapshotTable, checkpoint: str) -> int | None:
    """Apply what the log holds beyond ``checkpoint``; the new version of ``table``, if there is one.

    A batch that is replayed after a crash writes the same table once more.
    """
    if not log.last:
        return None
    rows = log.stream()
    state = T.StructType([f for f in rows.schema if f.name not in ("again", "key")])
    folded = rows.groupBy("key").transformWithState(SnapshotFold(state), "feed_no bigint, row string", "Update", "None")
    before = table.version

    def apply(batch: DataFrame, _: int) -> None:
        with work_tables(log.spark):
            # Written first: to look at a batch twice would run the state twice.
            batch = materialize(batch, "folded")
            last = batch.agg(F.max("feed_no")).first()[0]
            if last is not None:
                table.write(log.rows(batch.filter((F.col("feed_no") == last) & F.col("row").isNotNull())))

    setting = "spark.sql.streaming.stateStore.providerClass"
    was = log.spark.conf.get(setting)
    log.spark.conf.set(setting, STORE)
    try:
        query = folded.writeStream.outputMode("update").foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        log.spark.conf.set(setting, was)
    query.awaitTermination()
    return table.version if table.version != before else None


def fold_feeds(
    lake: Lake, landing: str, checkpoint: str, load_date: str | None = None, strict: bool = True, allow_empty: bool = True
) -> IngestReport:
    """The ingest job with silver in the state of a stream: pending feeds are logged, then folded.

    A silver table is kept up by this job or by ``ingest``, not by both. A run that died between log and ledger logs its
    feeds again, which changes nothing.
    """
    log = FeedLog(lake.spark, f"{lake.root}/log")

    def append(landing: str, pending: DataFrame, files: DataFrame, load_date: str) -> None:
        again = changed_files(lake, files).withColumn("again", F.lit(True))
        names = files.select("record_source").join(again, "record_source", "left").na.fill(False, ["again"])
        log.append(feed_rows(lake, landing, pending, files, load_date), names)

    try:
        report = ingest(lake, landing, load_date, strict, allow_empty, apply=append)
    finally:
        # Also when a bad feed stopped the run: what came before it counts.
        version = fold_log(log, lake.silver, checkpoint)
    return replace(report, silver_version=version)
