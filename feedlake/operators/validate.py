"""File-atomic checks: one bad item rejects the whole file it came in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.operators.keyed import restrict


def reasons(checks: dict[str, Column]) -> Column:
    """Names of the checks that are true, comma-separated; ``""`` for a good row."""
    return F.concat_ws(",", *[F.when(bad, F.lit(name)) for name, bad in checks.items()])


def file_status(rows: DataFrame, bad: Column, source: str = "record_source") -> DataFrame:
    """Items and bad items per file; combined before the shuffle, whatever a file's size."""
    return rows.groupBy(source).agg(
        F.count("*").alias("n_items"), F.count_if(bad).alias("n_bad")
    )


def drop_bad_files(rows: DataFrame, bad: Column, source: str = "record_source") -> DataFrame:
    """The rows of files that have no bad row."""
    bad_files = file_status(rows, bad, source).filter(F.col("n_bad") > 0)
    return restrict(rows, bad_files, source, "left_anti")
