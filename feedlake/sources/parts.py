"""A keyed table in folders, of which a sync writes only those in which a row changed."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from feedlake import schemas
from feedlake.operators.drift import WIDTH, range_of, row_hashes
from feedlake.operators.latest import free_name
from feedlake.operators.sync import DELETE, PUT
from feedlake.session import delete_path, materialize
from feedlake.sources.tables import read_or_empty


@dataclass(frozen=True)
class Synced:
    """Rows deleted and put (new or changed) by a sync, and how many folders were written or removed."""

    n_deleted: int
    n_put: int
    n_parts: int


class PartTable:
    """Rows with a unique ``key``, in a folder for each value of ``part``, an expression over the row.

    ``sync`` makes the table equal to what is desired: rows of both sides are compared by key and a digest, in one
    narrow join; folders without a difference are not touched, the others are written anew by Spark's
    dynamic partition overwrite. A daily run that changes little costs the comparison and little else.

    A sync that died halfway leaves some folders old and some new; the next one compares with what is there
    and ends in the right state. One writer at a time. What is desired must not be read from this table.
    """

    def __init__(self, spark: SparkSession, root: str, schema: StructType = schemas.SILVER, key: str = schemas.KEY, part: Column | None = None):
        self.spark, self.root, self.key = spark, root, key
        self.schema = StructType([StructField(f.name, f.dataType) for f in schema])
        self.part = by_range(key) if part is None else part
        self.part_name = free_name(schema.names, "part")
        kind = spark.createDataFrame([], self.schema).select(self.part).schema[0].dataType
        self.stored = StructType([*self.schema, StructField(self.part_name, kind)])

    def read(self) -> DataFrame:
        return self._held().select(self.schema.names)

    def read_part(self, value) -> DataFrame:
        """The rows of one folder; the others are not listed for it."""
        return self._held().filter(F.col(self.part_name) == F.lit(value)).select(self.schema.names)

    def _held(self) -> DataFrame:
        return read_or_empty(self.spark, f"{self.root}/data", self.stored)

    def _side(self, rows: DataFrame, side: str) -> DataFrame:
        """Key, part and a digest of 128 bits of each row; the rows themselves stay where they are."""
        digest = F.struct(*row_hashes(self.schema.names))
        return rows.select(self.key, F.col(self.part_name).alias(f"{side}_part"), digest.alias(f"{side}_digest"))

    def changes(self, desired: DataFrame) -> DataFrame:
        """(key, old_part, new_part, op) of the rows to delete or to put; a work table."""
        desired = self._cut(desired)
        both = self._side(self._held(), "old").join(self._side(desired, "new"), self.key, "full")
        differ = both.filter(~F.col("old_digest").eqNullSafe(F.col("new_digest")))
        op = F.when(F.col("new_digest").isNull(), DELETE).otherwise(PUT)
        return materialize(differ.select(self.key, "old_part", "new_part", op.alias("op")), "changes")

    def _cut(self, desired: DataFrame) -> DataFrame:
        typed = desired.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.schema])
        return typed.withColumn(self.part_name, self.part)

    def sync(self, desired: DataFrame, changes: DataFrame | None = None) -> Synced:
        """Make the table equal ``desired``. ``changes``: what ``changes(desired)`` gave, if it has been asked for."""
        changes = self.changes(desired) if changes is None else changes
        touched = F.explode(F.array_compact(F.array_distinct(F.array("old_part", "new_part"))))
        parts = materialize(changes.select(touched.alias(self.part_name)).distinct(), "parts")
        counts = changes.agg(F.count_if(F.col("op") == DELETE).alias("gone"), F.count_if(F.col("op") == PUT).alias("put")).first()
        # A row per folder, of which there are as many as the file system has to hold anyway.
        rows = self._cut(desired).join(parts, self.part_name, "left_semi")
        written = rows.hint("rebalance", F.col(self.part_name)).sortWithinPartitions(self.part_name, self.key).select(self.stored.names)
        kept = parts.join(rows.select(self.part_name).distinct(), self.part_name, "left_semi")
        emptied = parts.join(materialize(kept, "kept"), self.part_name, "left_anti")
        written.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(self.part_name).parquet(f"{self.root}/data")
        escaped = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
        for row in emptied.select(F.col(self.part_name).cast("string").alias("folder")).toLocalIterator():
            delete_path(self.spark, f"{self.root}/data/{self.part_name}={escaped(row.folder)}")
        return Synced(counts.gone, counts.put, parts.count())


def by_range(key: str = schemas.KEY, width: int = WIDTH) -> Column:
    """Folders by ranges of the key: no folder can hold more rows than a range has keys."""
    return range_of(key, width)


def by_date(column: str = "start_date") -> Column:
    """Folders by date, for lookups. Rows without one belong to no such table: leave them out."""
    return F.date_format(column, "yyyy-MM-dd")
