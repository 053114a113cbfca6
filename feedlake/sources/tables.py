"""Parquet tables at rest: versioned snapshots, append-only ledgers, catalog and CSV."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import date, datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from feedlake import schemas
from feedlake.operators.retention import retention_tier
from feedlake.session import delete_path


def path_exists_or_empty(
    spark: SparkSession, load: Callable[[], DataFrame], schema: StructType | str
) -> DataFrame:
    """``load()``, or no rows where its path does not exist yet. Other errors are raised."""
    try:
        return load()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return path_exists_or_empty(spark, lambda: spark.read.schema(schema).parquet(path), schema)


class SnapshotTable:
    """A table that is replaced as a whole, one folder per version.

    A version counts once its row is in ``commits``, written last. So a reader never sees
    half a version, a crash leaves the one before in force, and a job may read the table
    while it writes the next version of it. Two writers cannot take one version: the second
    one fails.
    """

    def __init__(self, spark: SparkSession, root: str, schema: StructType = schemas.SILVER):
        self.spark, self.root, self.schema = spark, root, schema

    def _latest(self) -> tuple[int, str | None]:
        commits = read_or_empty(self.spark, f"{self.root}/commits", schemas.COMMIT)
        row = commits.orderBy(F.desc("version")).first()
        return (row.version, row.path) if row else (0, None)

    @property
    def version(self) -> int:
        return self._latest()[0]

    @property
    def path(self) -> str | None:
        return self._latest()[1]

    def read(self) -> DataFrame:
        """The latest version under the declared schema; no rows before the first.

        Columns that came to the schema after the version was written are NULL.
        """
        path = self.path
        if path is None:
            return self.spark.createDataFrame([], self.schema)
        return self._load(path)

    def _load(self, path: str) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(path)

    def _new_path(self, version: int) -> str:
        return f"{self.root}/data/{version:08d}-{uuid.uuid4().hex[:8]}"

    def _save(self, df: DataFrame, path: str) -> None:
        df.write.parquet(path)

    def dealt(self, df: DataFrame) -> DataFrame:
        """``df`` laid out like the table's own rows, so that both meet without a further shuffle."""
        return df

    def write(self, df: DataFrame, cluster_by: list[str] | None = None, rows: Observation | None = None) -> int:
        """Write the next version, return its number.

        ``cluster_by`` sorts the table by range over all its files, so that a filter on those
        columns skips files and row groups by their statistics. Ranges cut through a value
        that holds much of the table as long as a later column still tells its rows apart.
        Finding the ranges reads ``df`` once more: let it come from a table.

        ``rows`` gets the number of rows (``n``) from the write itself.
        """
        version = self._latest()[0] + 1
        path = self._new_path(version)
        if cluster_by:
            df = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
        if rows:
            df = df.observe(rows, F.count("*").alias("n"))
        self._save(df, path)
        attempt = self._claim(version)
        if not self._holds(version, attempt):
            raise ConcurrentWrite(f"{self.root}: version {version} was taken over")
        row = (version, path, datetime.now(timezone.utc))
        commit = self.spark.createDataFrame([row], schemas.COMMIT)
        commit.write.mode("append").parquet(f"{self.root}/commits")
        return version

    def _claim(self, version: int) -> int:
        """Take the right to commit a version; raises if another writer has it.

        A claim whose writer died is taken over by making the next one, which only one writer can do.
        """
        attempt = 0
        while not self._system().createNewFile(self._claim_path(version, attempt)):
            if self._latest()[0] >= version or not self._stale(self._claim_path(version, attempt)):
                raise ConcurrentWrite(f"{self.root}: version {version} is taken by another writer")
            attempt += 1
        return attempt

    def _holds(self, version: int, attempt: int) -> bool:
        """Whether nobody has taken the claim over since, or committed the version."""
        return not self._system().exists(self._claim_path(version, attempt + 1)) and self._latest()[0] < version

    def _claim_path(self, version: int, attempt: int):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/claims/{version:08d}" + f"-{attempt}" * (attempt > 0))

    def _system(self):
        """The file system that the table lies in."""
        return self._claim_path(0, 0).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _stale(self, claim) -> bool:
        """A claim whose writer died before its commit, which follows a claim at once."""
        age = datetime.now(timezone.utc).timestamp() * 1000 - self._system().getFileStatus(claim).getModificationTime()
        return age > CLAIM_MILLISECONDS

    def expire(self, as_of: date) -> int:
        """Delete the files of versions that ``retention_tier`` counts as expired, never the latest."""
        commits = read_or_empty(self.spark, f"{self.root}/commits", schemas.COMMIT)
        commits = commits.withColumn("day", F.to_date("committed_at"))
        kept = retention_tier(commits, "day", as_of).select("version")
        latest = self._latest()[0]
        old = commits.join(kept, "version", "left_anti").filter(F.col("version") != latest).collect()
        gone = 0
        for row in old:
            gone += delete_path(self.spark, row.path)
        return gone


class BucketedTable(SnapshotTable):
    """A snapshot table whose rows are dealt out to ``buckets`` files by a hash of ``key``, each sorted by it.

    Spark knows the layout: a merge, a semi- or anti-join or a sync plan by ``key`` reads the table where
    it lies, and only what comes new is shuffled (``dealt``); two such tables meet without any shuffle.
    The number of buckets is part of the name of a version, so it may change from one to the next.

    Spark keeps the layout in its catalog. So a table is named there for a moment, to write or to read a version, and the
    name is dropped at once; files and plans outlive it.
    """

    def __init__(self, spark: SparkSession, root: str, schema: StructType = schemas.SILVER, key: str = schemas.KEY, buckets: int = 200):
        super().__init__(spark, root, schema)
        self.key, self.buckets = key, buckets

    def _new_path(self, version: int) -> str:
        return f"{super()._new_path(version)}-b{self.buckets}"

    def dealt(self, df: DataFrame) -> DataFrame:
        return df.repartition(self.buckets, self.key)

    @contextmanager
    def _named(self) -> Iterator[str]:
        name = f"feedlake_{uuid.uuid4().hex}"
        try:
            yield name
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def _save(self, df: DataFrame, path: str) -> None:
        with self._named() as name:
            df.write.bucketBy(self.buckets, self.key).sortBy(self.key).option("path", path).saveAsTable(name)

    def _load(self, path: str) -> DataFrame:
        buckets = int(path.rpartition("-b")[2])
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
        place = path.replace("\\", "\\\\").replace("'", "\\'")
        with self._named() as name:
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) INTO {buckets} BUCKETS LOCATION '{place}'"
            )
            return self.spark.table(name)


class ConcurrentWrite(RuntimeError):
    """Another writer took the version first. Nothing was committed."""


#: How long a claim without a commit holds others off.
CLAIM_MILLISECONDS = 600_000


def append_ledger(rows: DataFrame, path: str) -> None:
    """Append file outcomes. Written after the data they speak of. Without a state, any counts as seen."""
    if "state" not in rows.columns:
        rows = rows.withColumn("state", F.lit(None).cast("string"))
    rows.select(schemas.LEDGER.names).write.mode("append").parquet(path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, schemas.LEDGER)


def register(df: DataFrame, name: str) -> None:
    """Open a DataFrame to ``spark.sql`` under ``name`` in this session."""
    df.createOrReplaceTempView(name)


def publish(table: SnapshotTable, name: str) -> None:
    """Put the latest version in the catalog as ``name``, for every session that uses it.

    A view, so that the next version replaces this one in a single step.
    """
    path = table.path
    if path is None:
        raise ValueError(f"{table.root} has no version yet")
    columns = ", ".join(f"`{column}`" for column in table.schema.names)
    table.spark.sql(
        f"CREATE OR REPLACE VIEW {name} AS SELECT {columns} FROM parquet.`{path}`"
    )


def merged_schema(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Versions written under an older, narrower schema next to newer ones; gaps are NULL."""
    return spark.read.option("mergeSchema", "true").parquet(*paths)


# RFC 4180 quoting, white space kept, and a mark that tells NULL from "".
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "nullValue": "\\N",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def _escaped(df: DataFrame, change: Callable[[Column], Column]) -> DataFrame:
    text = [f.name for f in df.schema if isinstance(f.dataType, StringType)]
    return df.select(*[change(df[f"`{c}`"]).alias(c) if c in text else df[f"`{c}`"] for c in df.columns])


def write_csv(df: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """Write CSV in files of bounded length, since each is read back by one task.

    A text that reads like the mark for NULL, with any number of backslashes, gets one more.
    """
    marked = _escaped(df, lambda c: F.when(c.rlike(r"^\\+N$"), F.concat(F.lit("\\"), c)).otherwise(c))
    marked.write.options(**CSV_OPTIONS, maxRecordsPerFile=rows_per_file).csv(path)


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read back what ``write_csv`` wrote; quoted line breaks are part of a value."""
    rows = spark.read.options(**CSV_OPTIONS, multiLine="true", mode="FAILFAST").schema(schema).csv(path)
    return _escaped(rows, lambda c: F.when(c.rlike(r"^\\{2,}N$"), F.substring(c, 2, 1 << 30)).otherwise(c))
