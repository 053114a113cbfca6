"""Where a keyed store has drifted from the table it should equal, found by digests of key ranges.

    ranges = materialize(drifted_ranges(held, desired))
    drift_plan(held, desired, ranges)        # deletes and puts of the rows that differ

Each side is reduced to a count and an order-free digest per range before anything is shuffled, so two sides that
are equal cost a scan each and no join of rows. Rows are joined in the ranges that differ only, and only these ranges
are read again: conditions on the key reach the files, or the store, that hold them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlake.operators.latest import free_name
from feedlake.operators.sync import DELETE, PUT
from feedlake.schemas import KEY

#: Keys a range.
WIDTH = 1_000_000
#: Stretches of keys that the ranges which differ are put together to, for the condition of the second read.
STRETCHES = 8


def range_of(key: str = KEY, width: int = WIDTH) -> Column:
    """Number of the range that a key lies in."""
    return F.floor(F.col(key) / width).cast("bigint")


def row_hashes(columns: list[str]) -> list[Column]:
    """Two hashes of 64 bits of a row. A hash passes over NULL, so which columns hold one is hashed too."""
    values = [F.col(f"`{c}`") for c in columns]
    values += [c.isNull() for c in values]
    return [F.xxhash64(*values), F.xxhash64(F.lit(1), *values)]


def range_digests(rows: DataFrame, key: str = KEY, width: int = WIDTH, columns: list[str] | None = None) -> DataFrame:
    """(range, n, digest) of rows with a unique key, whatever their order and the files they come from."""
    first, second = row_hashes(columns or rows.columns)
    hashed = rows.select(range_of(key, width).alias("range"), first.alias("first"), second.alias("second"))
    sums = hashed.groupBy("range").agg(F.count("*").alias("n"), F.bit_xor("first").alias("first"), F.bit_xor("second").alias("second"))
    return sums.select("range", "n", F.struct("first", "second").alias("digest"))


def drifted_ranges(held: DataFrame, desired: DataFrame, key: str = KEY, width: int = WIDTH) -> DataFrame:
    """(range, n_held, n_desired) of the ranges in which the two sides differ; none where they are equal."""
    columns = desired.columns
    old = range_digests(held, key, width, columns).withColumnsRenamed({"n": "n_held", "digest": "old"})
    new = range_digests(desired, key, width, columns).withColumnsRenamed({"n": "n_desired", "digest": "new"})
    differ = old.join(new, "range", "full").filter(~F.col("old").eqNullSafe(F.col("new")) | ~F.col("n_held").eqNullSafe(F.col("n_desired")))
    return differ.select("range", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_held", "n_desired")])


def covering(ranges: DataFrame, stretches: int = STRETCHES) -> list[tuple[int, int]]:
    """At most ``stretches`` stretches of ranges, first and last, that hold all of ``ranges`` and as few others as can be.

    The widest gaps part them. ``ranges`` has a row per range, so one window over all of it is small.
    """
    ends = ranges.agg(F.min("range").alias("low"), F.max("range").alias("high")).first()
    if ends.low is None:
        return []
    before = F.lag("range").over(Window.orderBy("range"))
    gaps = ranges.select("range", before.alias("before")).filter("range - before > 1")
    cuts = gaps.orderBy(F.desc(F.col("range") - F.col("before")), "range").limit(stretches - 1).collect()
    out, low = [], ends.low
    for cut in sorted(cuts, key=lambda r: r.range):
        out.append((low, cut.before))
        low = cut.range
    return [*out, (low, ends.high)]


def _within(rows: DataFrame, stretches: list[tuple[int, int]], key: str, width: int) -> DataFrame:
    """The rows of these stretches, in one read: files are skipped by each of them, a store that knows plain bounds only
    narrows by their ends."""
    if not stretches:
        return rows.limit(0)
    # Bounds in the type of the key: a cast around it would not be pushed down.
    kind = rows.schema[key].dataType
    least, most = (-(1 << 31), (1 << 31) - 1) if kind.simpleString() == "int" else (-(1 << 63), (1 << 63) - 1)

    def between(first: int, last: int) -> Column:
        low, high = max(first * width, least), min(last * width + width - 1, most)
        return (F.col(key) >= F.lit(low).cast(kind)) & (F.col(key) <= F.lit(high).cast(kind))

    hull = between(stretches[0][0], stretches[-1][1])
    return rows.filter(hull & reduce(Column.__or__, [between(*stretch) for stretch in stretches]))


def drift_plan(held: DataFrame, desired: DataFrame, ranges: DataFrame, key: str = KEY, width: int = WIDTH, stretches: int = STRETCHES) -> DataFrame:
    """What makes ``held`` equal ``desired``, for rows that differ only: the row (of a delete: as it is held), then ``op``.

    ``ranges``: a table of what ``drifted_ranges`` gave, with the same ``width``.
    """
    columns = desired.columns
    others = [c for c in columns if c != key]
    old, new, number = (free_name(columns, c) for c in ("old", "new", "range"))
    near_to = covering(ranges, stretches)
    hit = ranges.select(F.col("range").alias(number))

    def side(rows: DataFrame, name: str) -> DataFrame:
        near = _within(rows.select(columns), near_to, key, width).withColumn(number, range_of(key, width))
        return near.join(hit, number, "left_semi").select(key, F.struct(*others).alias(name))

    differ = side(held, old).join(side(desired, new), key, "full").filter(~F.col(old).eqNullSafe(F.col(new)))
    op = F.when(F.col(new).isNull(), DELETE).otherwise(PUT)
    row = free_name(columns, "row")
    return differ.select(key, F.coalesce(new, old).alias(row), op.alias("op")).select(key, f"{row}.*", "op").select(*columns, "op")
