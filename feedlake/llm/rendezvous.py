"""Sharding by rendezvous hashing of stable record keys over weighted shards. DataFrame operations only.

A key and a shard give a uniform number u in (0, 1) by MD5; the shard with the smallest
-ln(u) / weight takes the key. So a shard gets its share of the weights, and a key's scores at
the other shards do not change when one comes, goes or changes its weight: a new shard takes keys only
into itself (its share of them), one that goes gives up its own only, and a greater weight moves keys
only towards it.

``assign`` is a narrow expression: no shuffle, whatever the size. ``numbered`` counts the records
of each shard off without gaps: shards are cut into ranges of a hash, about as many as a range has
records; counts of the ranges give where each begins. Copies of one record are counted before any
shuffle and dealt out in pieces, so a key that holds much of the table burdens no task.

Defined results: a null key counts as an empty one; records of one key share a shard, whatever else they hold; ties of
scores go to the smaller shard; copies of a record get slots of their own, next to one another; a null text
has no bytes; an empty table gives an empty result; shards of weight 0 get nothing. Only the named columns are read,
and columns that are added take a free name, so other columns cannot clash.
"""

from __future__ import annotations

from math import isfinite, isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedlake.llm.rows import column, pick
from feedlake.operators.latest import free_name
from feedlake.session import materialize

#: What a record takes in a shard file besides its text.
RECORD_BYTES = 8
#: Copies of one record that are numbered together.
PIECE = 1 << 16
# 13 hexadecimal digits: as many bits as a double holds without rounding, less the half step.
DIGITS, STEPS = 13, float(1 << 52)


def checked(weights: list[float]) -> list[float]:
    if not all(isfinite(w) and w >= 0 for w in weights) or not any(weights):
        raise ValueError("weights must be finite and not negative, and one of them above 0")
    return [float(w) for w in weights]


def scores(key: Column, weights: list[float]) -> Column:
    """An array of (score, shard), in the order of the shards; shards of weight 0 are left out."""
    shards = F.array(*[F.struct(F.lit(i).alias("shard"), F.lit(w).alias("weight")) for i, w in enumerate(weights) if w > 0])

    def score(shard: Column) -> Column:
        digest = F.md5(F.concat(key, F.lit(":"), shard["shard"].cast("string")).cast("binary"))
        u = (F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("bigint").cast("double") + 0.5) / STEPS
        return F.struct((-F.ln(u) / shard["weight"]).alias("score"), shard["shard"].alias("shard"))

    return F.transform(shards, score)


def assign(df: DataFrame, key_col: str, weights: list[float], name: str = "shard", grown: float | None = None) -> DataFrame:
    """``df`` with the shard of each row, from 0, as ``name`` (or a free name like it, at the end).

    ``grown``: the weight of one shard more; a further column has the shard that the row would then be in.
    """
    weights = checked(weights)
    key = F.coalesce(column(df, key_col).cast("string"), F.lit(""))
    held = free_name(df.columns, "_scores")
    scored = df.withColumn(held, scores(key, weights + ([] if grown is None else checked([grown]))))
    shard = F.array_min(F.filter(F.col(held), lambda s: s["shard"] < len(weights)))["shard"]
    found = {free_name(df.columns, name): shard}
    if grown is not None:
        found[free_name([*df.columns, *found], f"grown_{name}")] = F.array_min(F.col(held))["shard"]
    return scored.withColumns(found).drop(held)


def sizes(df: DataFrame, key_col: str, text_col: str, weights: list[float], grown: float | None = None) -> DataFrame:
    """(key, size, text_crc32, shard, grown_shard) of every row: the bytes it takes and where it goes."""
    rows = pick(df, key=key_col, text=text_col)
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = rows.select("key", (F.octet_length(text) + RECORD_BYTES).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"))
    placed = assign(rows, "key", weights, grown=grown)
    return placed if grown is not None else placed.withColumn("grown_shard", F.lit(None).cast("int"))


def numbered(rows: DataFrame, shard: str = "shard") -> DataFrame:
    """``rows`` with ``slot``: their number in their shard, from 0, without gaps.

    The order is that of a hash of the whole row. Rows should be narrow: they are shuffled, texts need not be.
    """
    names = rows.columns
    column_of = [F.col("`" + c.replace("`", "``") + "`") for c in names]
    copies, piece, n, place, part, before, base = (free_name(names, x) for x in ("_copies", "_piece", "_n", "_place", "_part", "_before", "_base"))
    once = rows.groupBy(*column_of).agg(F.count("*").alias(copies))
    pieces = once.withColumn(piece, F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col(copies) - 1) / PIECE))))
    text = F.concat_ws(":", *[F.coalesce(c.cast("string"), F.lit("")) for c in column_of], F.col(piece).cast("string"))
    pieces = pieces.select(*column_of, piece, F.least(F.lit(PIECE), F.col(copies) - F.col(piece) * PIECE).alias(n), F.md5(text.cast("binary")).alias(place))
    pieces = materialize(pieces, "pieces", release=True)
    found = pieces.agg(F.sum(n), F.count_distinct(shard)).first()
    parts = isqrt((found[0] or 0) // max(found[1], 1)) + 1
    pieces = pieces.withColumn(part, F.floor(F.conv(F.substring(place, 1, 8), 16, 10).cast("bigint") * parts / F.lit(1 << 32)).cast("int"))
    up_to_here = lambda *by: W.partitionBy(shard, *by).rowsBetween(W.unboundedPreceding, -1)
    counts = pieces.groupBy(shard, part).agg(F.sum(n).alias(n))
    begins = counts.select(shard, part, F.coalesce(F.sum(n).over(up_to_here().orderBy(part)), F.lit(0)).alias(base))
    begins = materialize(begins, "begins")
    in_part = up_to_here(part).orderBy(place, *column_of, piece)
    placed = pieces.withColumn(before, F.coalesce(F.sum(n).over(in_part), F.lit(0))).join(begins, [shard, part])
    first = F.col(base) + F.col(before)
    return placed.select(*column_of, F.explode(F.sequence(first, first + F.col(n) - 1)).alias("slot"))


def write_shards(df: DataFrame, key_col: str, weights: list[float], path: str) -> None:
    """All columns of ``df`` as Parquet, a folder ``shard=N`` each.

    Spark cuts a large shard into as many files as it takes and keeps a small one together. A column
    ``shard`` of the table itself stays in the files, under a free name.
    """
    name = free_name(df.columns, "shard")
    placed = assign(df, key_col, weights, name)
    placed.hint("rebalance", F.col(name)).write.partitionBy(name).parquet(path)
