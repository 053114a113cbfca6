"""Age tiers of stored files."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Days after which a file changes tier, and after which it is expired.
INFREQUENT_AFTER, ARCHIVE_AFTER, EXPIRED_AFTER = 30, 60, 90


def retention_tier(rows: DataFrame, created: str, as_of: date) -> DataFrame:
    """Rows not yet expired on ``as_of``, with their ``tier``; one without a date never expires."""
    age = F.date_diff(F.lit(as_of), F.col(created))
    tier = (
        F.when(age >= ARCHIVE_AFTER, "archive")
        .when(age >= INFREQUENT_AFTER, "infrequent")
        .otherwise("standard")
    )
    # Written against the column itself, so that it reaches the Parquet scan.
    oldest = F.date_sub(F.lit(as_of), EXPIRED_AFTER - 1)
    kept = rows.filter((F.col(created) >= oldest) | F.col(created).isNull())
    return kept.withColumn("tier", tier)
