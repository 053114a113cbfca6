"""Semi- and anti-joins of a big side against a list of keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.session import materialize

MAX_BROADCAST_BYTES = 32 * 1024 * 1024
ROW_BYTES = 32


def key_bytes(keys: DataFrame, on: str) -> int:
    """Memory that a broadcast of these keys takes, text length plus overhead per row."""
    size = F.sum(F.octet_length(F.col(on).cast("string")) + ROW_BYTES)
    return keys.agg(F.coalesce(size, F.lit(0))).first()[0]


def restrict(
    rows: DataFrame,
    keys: DataFrame,
    on: str,
    how: str,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """``rows`` with (``left_semi``) or without (``left_anti``) the distinct values of ``keys``.

    The keys are written once and measured. If small they are broadcast, so ``rows`` is not
    shuffled at all. If not it is a plain join by shuffle: both sides come straight from their
    exchange, so adaptive execution cuts the rows of a hot key into as many tasks as they need.
    """
    keys = materialize(keys.select(on).distinct())
    if key_bytes(keys, on) <= max_broadcast_bytes:
        return rows.join(F.broadcast(keys), on, how).select(rows.columns)
    return rows.join(keys.hint("merge"), on, how).select(rows.columns)
