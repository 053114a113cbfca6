"""Session helpers: settings, the shared scratch folder and lineage cuts."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Paths of the work tables made so far in the innermost ``work_tables``.
_MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)


# Settings for large inputs. AQE merges small shuffle partitions down to the advisory size,
# so ``shuffle_partitions`` is an upper bound: input bytes over 200 MB is a good start.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str = "feedlake", shuffle_partitions: int = 2000, **conf) -> SparkSession:
    """A session with the settings above; master and resources come from spark-submit."""
    builder = SparkSession.builder.appName(app).config(
        map={**SETTINGS, "spark.sql.shuffle.partitions": str(shuffle_partitions), **conf}
    )
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only where the session names none and all of it runs in one process (a local test run) is a
    temporary one made.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="feedlake-")
        spark.sparkContext.setCheckpointDir(named)
    return named


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path below the shared folder; its name says which application made it."""
    return f"{shared_dir(spark)}/feedlake/{name}-{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "cut", release: bool = False) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Cuts the lineage, outlives the loss of an executor, and gives the planner true sizes.
    ``release``: the shuffle files behind it are no longer needed; Spark deletes them once the
    driver has collected its garbage, which is asked for here rather than waited for.
    """
    path = work_path(df.sparkSession, name)
    made = _MADE.get()
    if made is not None:
        made.append(path)
    df.write.parquet(path)
    if release:
        df.sparkSession._jvm.java.lang.System.gc()
    cut = df.sparkSession.read.schema(df.schema).parquet(path)
    cut.work_path = path
    return cut


def discard(df: DataFrame) -> None:
    """Delete the table behind a result of ``materialize``; anything else is left alone.

    Nothing that reads the table may be used afterwards.
    """
    path = vars(df).get("work_path")
    if path:
        delete_path(df.sparkSession, path)


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder or file, by whatever file system it lies in; False if there is none."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def work_tables(spark: SparkSession) -> Iterator[None]:
    """Every work table that is made inside is deleted at the end, also after an error.

    For jobs whose results are tables of their own: nothing lazy may be carried out of it.
    """
    made: list[str] = []
    token = _MADE.set(made)
    try:
        yield
    finally:
        _MADE.reset(token)
        for path in made:
            delete_path(spark, path)
