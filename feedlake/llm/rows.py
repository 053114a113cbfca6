"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICE_CHARS = 4_000_000


def column(df: DataFrame, name: str) -> Column:
    """The column of exactly this name, dots and odd signs included."""
    return df["`" + name.replace("`", "``") + "`"]


def pick(df: DataFrame, **names: str) -> DataFrame:
    """Only the named columns, under names of our own: other columns cannot clash with ours."""
    return df.select([column(df, theirs).alias(ours) for ours, theirs in names.items()])


def slices(batch: pa.RecordBatch, text: str, chars: int = 0) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of some 4 MB of text, or of ``chars``, so that long documents do not add up in memory."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > (chars or SLICE_CHARS):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n + 64
    if start < len(sizes):
        yield batch.slice(start)


def map_slices(
    df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, text: str = "text", chars: int = 0
) -> DataFrame:
    """``work`` over bounded slices of every partition; no shuffle."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, text, chars):
                yield work(part)

    return df.mapInArrow(run, schema)


def same_length_lower(text: str) -> str:
    """In lower case, character by character: no place moves."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c if len(c.lower()) != 1 else c.lower() for c in text)
    return low


def hash_text(column: Column) -> Column:
    """Lower-case hex of the SHA-256 of the UTF-8 text."""
    return F.sha2(column.cast("binary"), 256)
