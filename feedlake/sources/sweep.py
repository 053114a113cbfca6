"""Folders that nothing speaks of any more: found by what can be reached, and removed.

A version that a writer left without a commit, and the work tables of an application that died, are named by no
commit and by no running job. They are told from the work of a running one by age alone: what holds a
file younger than ``keep`` is left.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from datetime import datetime, timedelta, timezone

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from feedlake.schemas import COMMIT
from feedlake.session import delete_path, shared_dir
from feedlake.sources.tables import SnapshotTable, read_or_empty

#: Longer than any run takes.
KEEP = timedelta(days=2)


def _children(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies directly in a folder: one per version or work table, not per file."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return [status.getPath().getName() for status in system.listStatus(place)] if system.exists(place) else []


def _times(spark: SparkSession, folder: str) -> Iterator[datetime]:
    """Times of the folder itself, which a write may have made a moment ago, and of the files below it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    yield datetime.fromtimestamp(system.getFileStatus(place).getModificationTime() / 1000, timezone.utc)
    files = system.listFiles(place, True)
    while files.hasNext():
        yield datetime.fromtimestamp(files.next().getModificationTime() / 1000, timezone.utc)


def _remove(spark: SparkSession, root: str, names: Iterable[str], now: datetime, keep: timedelta) -> int:
    """Remove the named folders in which nothing is younger than ``keep``; how many went."""
    gone = 0
    for name in names:
        if all(now - time > keep for time in _times(spark, f"{root}/{name}")):
            gone += delete_path(spark, f"{root}/{name}")
    return gone


def sweep_versions(table: SnapshotTable, keep: timedelta = KEEP, now: datetime | None = None) -> int:
    """Remove versions beyond their retention, and those that no commit names: their writer died, or another took their number.

    A table with one version has none to spare, and costs a listing.
    """
    now, data = now or datetime.now(timezone.utc), f"{table.root}/data"
    if len(_children(table.spark, data)) < 2:
        return 0
    gone = table.expire(now.date())
    commits = read_or_empty(table.spark, f"{table.root}/commits", COMMIT).select(F.element_at(F.split("path", "/"), -1).alias("name"))
    listed = table.spark.createDataFrame([(name,) for name in _children(table.spark, data)], "name string")
    lost = listed.join(commits, "name", "left_anti").collect()
    return gone + _remove(table.spark, data, [row.name for row in lost], now, keep)


def sweep_work(spark: SparkSession, keep: timedelta = KEEP, now: datetime | None = None) -> int:
    """Remove the work tables of applications that are gone; those of this one are its own business."""
    now, root = now or datetime.now(timezone.utc), f"{shared_dir(spark)}/feedlake"
    own = f"-{spark.sparkContext.applicationId}-"
    return _remove(spark, root, [name for name in _children(spark, root) if own not in name], now, keep)
