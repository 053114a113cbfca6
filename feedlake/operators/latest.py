"""Latest row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def free_name(columns: list[str], name: str) -> str:
    """``name``, with underscores as long as a column has it."""
    while name.lower() in {c.lower() for c in columns}:
        name += "_"
    return name


def newest_order(columns: list[str]) -> list[Column]:
    """What makes one silver row newer than another, greatest first to be compared.

    The file name; then the *earlier* load, so that loading a file twice changes nothing;
    then a hash of the row, so that an id twice in one file always gives the same row.
    """
    return [
        F.col("record_source"),
        -F.unix_micros(F.try_to_timestamp(F.col("load_date"))),
        F.xxhash64(*columns),
    ]


def best_row(columns: list[str], key: str, newest: list[Column]) -> Column:
    """Aggregate: the other columns of the greatest row, as a struct."""
    others = [name for name in columns if name != key]
    return F.max_by(F.struct(*others), F.struct(*newest))


def latest_per_key(df: DataFrame, key: str, newest: list[Column] | None = None) -> DataFrame:
    """The greatest row by ``newest`` for each key, as one aggregate.

    Each map task sends at most one row per key, however many it holds. The key is not part
    of the aggregated row, so a reader of keys alone does not pay for the rest.
    """
    newest = newest or newest_order(df.columns)
    row = free_name(df.columns, "row")
    best = df.groupBy(key).agg(best_row(df.columns, key, newest).alias(row))
    return best.select(key, f"{row}.*").select(df.columns)


def latest_per_key_window(
    df: DataFrame, key: str, newest: list[Column] | None = None
) -> DataFrame:
    """``latest_per_key`` as ``row_number() = 1``. Spark limits each key before the shuffle."""
    newest = newest or newest_order(df.columns)
    window = Window.partitionBy(key).orderBy(*[c.desc_nulls_last() for c in newest])
    rank = free_name(df.columns, "rank")
    ranked = df.withColumn(rank, F.row_number().over(window))
    return ranked.filter(F.col(rank) == 1).select(df.columns)


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).distinct()
