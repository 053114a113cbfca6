"""Merging feed snapshots into the current-state table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.operators.latest import best_row, free_name, latest_per_key, newest_order
from feedlake.schemas import KEY


def union_rows(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Both as a bag, matched by column name."""
    return existing.unionByName(new)


def merge_snapshot(
    existing: DataFrame, new: DataFrame, key: str = KEY, newest: list[Column] | None = None
) -> DataFrame:
    """Latest row per key over both sides, for the keys of ``new`` only.

    An id that ``new`` lacks is gone: the table is the current snapshot, not a history. An
    older file arriving late gives the ids, the newer rows already there give the values.

    Both steps are one aggregate with one shuffle and no join: the latest row, and whether
    any row of the key came from ``new``. A key with many rows is reduced before the shuffle.
    """
    columns = existing.columns
    newest = newest or newest_order(columns)
    is_new, row = free_name(columns, "is_new"), free_name(columns, "row")
    rows = union_rows(
        existing.withColumn(is_new, F.lit(False)), new.withColumn(is_new, F.lit(True))
    )
    best = best_row(columns, key, newest).alias(row)
    merged = rows.groupBy(key).agg(best, F.bool_or(is_new).alias(is_new))
    return merged.filter(F.col(is_new)).select(key, f"{row}.*").select(columns)


def merge_dealt(existing: DataFrame, new: DataFrame, key: str = KEY, newest: list[Column] | None = None) -> DataFrame:
    """``merge_snapshot`` as a join, for an ``existing`` side that lies dealt out by its unique key.

    Such a side is not shuffled: ``new`` comes to it, dealt the same way, reduced to a row per key first.
    """
    columns = existing.columns
    newest = newest or newest_order(columns)
    others = [c for c in columns if c != key]
    old, old_order, row, order = (free_name(columns, x) for x in ("old", "old_order", "row", "order"))
    held = existing.select(key, F.struct(*others).alias(old), F.struct(*newest).alias(old_order))
    came = latest_per_key(new.select(columns), key, newest).select(key, F.struct(*others).alias(row), F.struct(*newest).alias(order))
    best = F.when(F.col(old).isNotNull() & (F.col(old_order) > F.col(order)), F.col(old)).otherwise(F.col(row))
    return held.join(came, key, "right").select(key, best.alias(row)).select(key, f"{row}.*").select(columns)


def present_in_all(rows: DataFrame, n_files: int, key: str, source: str) -> DataFrame:
    """Keys that occur in each of ``n_files`` sources.

    Counted over the distinct pairs of key and source: no task holds the sources of a key, however
    many files there are. Rows dealt out by key stay where they are.
    """
    per_key = rows.select(key, source).distinct().groupBy(key).agg(F.count("*").alias("n"))
    return per_key.filter(F.col("n") == n_files).select(key)


def fold_snapshots(
    existing: DataFrame,
    batch: DataFrame,
    last: str,
    n_files: int,
    key: str = KEY,
    newest: list[Column] | None = None,
    source: str = "record_source",
    merge: Callable[..., DataFrame] = merge_snapshot,
) -> DataFrame:
    """``merge_snapshot`` over ``n_files`` files in name order, ``last`` being the greatest name.

    One pass instead of one merge a file. Only rows of ``last`` can be in the result, plus
    rows of ``existing`` that are not older than it; and those only where no file on the way
    lacked their id, since a file without it would have removed the row. ``n_files`` and
    ``last`` come from the file listing: a feed without items has no row in ``batch``, yet
    it empties the table. ``merge``: how the two sides are put together.
    """
    new = batch.filter(F.col(source) == last)
    late = existing.filter(F.col(source) >= last)
    if n_files > 1:
        earlier = batch.filter(F.col(source) < last)
        late = late.join(present_in_all(earlier, n_files - 1, key, source), key, "left_semi")
    return merge(late.select(existing.columns), new, key, newest)
