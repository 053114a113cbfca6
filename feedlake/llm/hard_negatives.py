"""Hard negatives by exact integer scores: Strassen products of tiles, and heaps that merge.

Vectors become integers, floor(256 * x). Anchors and candidates are dealt out in blocks by a hash of the row;
each block of anchors meets each block of candidates in one group. A group multiplies tiles of
them by Strassen's recursion on int64: odd sides are filled up with zeros, sums are exact (they may wrap
around on the way, which cancels out, since the results fit). Of each tile only the best are kept:

1. positive heaps: for each anchor the candidates of its label with the highest scores;
2. window heaps, in a second pass: for each anchor and positive, the best of other labels whose
   score lies in the window that the positive's score spans.

A heap holds a fixed number of rows, and two of them merge into one, so tiles, groups and tasks
can be merged in any order. The anchors are a stated query set; every candidate is looked at.

Defined results: rows whose label, vector or id is null, or whose vector holds null, NaN or infinite parts
take no part; nor do those whose 256 * x have a sum of squares above 2**56, as their scores need more
than a long. Vectors of another length never meet; one without parts scores 0. Repeated rows
are one row; rows of one id that differ stand each for themselves, and are never their own positives. Ties go to
the smaller id. An empty table, or one without anchors, gives an empty result. Only the named columns are read,
so other columns cannot clash.
"""

from __future__ import annotations

from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedlake.llm.rows import column
from feedlake.session import discard, materialize

SCALE = 256
LARGEST_SQUARE = float(1 << 56)
#: Sides of a product below which it is worked out directly.
LEAF = 16
TILE_ANCHORS, TILE_ROWS = 256, 2048
LEAST_BLOCK, LARGEST_BLOCK, BLOCK_ROOT = 2048, 32_768, 16

POSITIVES, NEGATIVES = 5, 5
#: The window of a positive's score, in percent of it.
WINDOW = (80, 100)


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The product of int64 matrices, modulo 2**64 on the way."""
    if min(*a.shape, b.shape[1]) <= LEAF:
        return a @ b
    rows, columns = a.shape[0], b.shape[1]
    a = np.pad(a, [(0, s % 2) for s in a.shape])
    b = np.pad(b, [(0, s % 2) for s in b.shape])
    m, d, k = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:m, :d], a[:m, d:], a[m:, :d], a[m:, d:]
    b11, b12, b21, b22 = b[:d, :k], b[:d, k:], b[d:, :k], b[d:, k:]
    p1 = strassen(a11 + a22, b11 + b22)
    p2 = strassen(a21 + a22, b11)
    p3 = strassen(a11, b12 - b22)
    p4 = strassen(a22, b21 - b11)
    p5 = strassen(a11 + a12, b22)
    p6 = strassen(a21 - a11, b11 + b12)
    p7 = strassen(a12 - a22, b21 + b22)
    out = np.empty((2 * m, 2 * k), np.int64)
    out[:m, :k] = p1 + p4 - p5 + p7
    out[:m, k:] = p3 + p5
    out[m:, :k] = p2 + p4
    out[m:, k:] = p1 - p2 + p3 + p6
    return out[:rows, :columns]


class Heaps:
    """For each key the ``most`` best (score, id): highest scores first, then smallest ids."""

    def __init__(self, most: int):
        self.most = most
        self.key = self.score = self.id = np.zeros(0, np.int64)

    def add(self, key: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        key, score, ids = np.concatenate([self.key, key]), np.concatenate([self.score, score]), np.concatenate([self.id, ids])
        order = np.lexsort((ids, -score, key))
        key, score, ids = key[order], score[order], ids[order]
        first = np.searchsorted(key, key, "left")
        best = np.arange(len(key)) - first < self.most
        self.key, self.score, self.id = key[best], score[best], ids[best]


def _matrix(table: pa.Table, name: str, size: int) -> np.ndarray:
    return table.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(table.num_rows, size)


def _tiles(anchors: pa.Table, rows: pa.Table):
    """(places of the anchors, places of the rows, their scores) for all tiles of a group."""
    size = len(anchors.column("vec")[0])
    a, b = _matrix(anchors, "vec", size), _matrix(rows, "vec", size)
    for i in range(0, len(a), TILE_ANCHORS):
        for j in range(0, len(b), TILE_ROWS):
            left, right = slice(i, i + TILE_ANCHORS), slice(j, j + TILE_ROWS)
            yield left, right, strassen(a[left], np.ascontiguousarray(b[right].T))


def _long(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy().astype(np.int64)


def _best_positives(most: int):
    def work(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        heaps = Heaps(most)
        if anchors.num_rows and rows.num_rows:
            asks, ask_id, ask_label = (_long(anchors, c) for c in ("ask", "id", "label"))
            ids, labels = _long(rows, "id"), _long(rows, "label")
            for left, right, score in _tiles(anchors, rows):
                fits = (ask_label[left][:, None] == labels[right]) & (ask_id[left][:, None] != ids[right])
                score = np.where(fits, score, np.iinfo(np.int64).min)
                if score.shape[1] > most:
                    # Nothing below the last place of a tile gets into a heap; what ties with it may.
                    fits &= score >= np.partition(score, -most, axis=1)[:, -most][:, None]
                at, of = np.nonzero(fits)
                heaps.add(asks[left][at], score[at, of], ids[right][of])
        return pa.table([heaps.key, heaps.id, heaps.score], ["ask", "id", "score"])

    return work


def _best_in_windows(most: int, window: tuple[int, int]):
    least, largest = window

    def work(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        heaps = Heaps(most)
        if anchors.num_rows and rows.num_rows:
            ask_label = _long(anchors, "label")
            ids, labels = _long(rows, "id"), _long(rows, "label")
            wanted = anchors.column("positives").combine_chunks()
            count = np.diff(wanted.offsets.to_numpy())
            of_anchor = np.repeat(np.arange(len(count)), count)
            keys, aims = (wanted.flatten().field(c).to_numpy().astype(np.int64) for c in ("key", "score"))
            begin = np.cumsum(count) - count
            low, high = np.full(len(count), np.iinfo(np.int64).max), np.full(len(count), np.iinfo(np.int64).min)
            np.minimum.at(low, of_anchor, least * aims)
            np.maximum.at(high, of_anchor, largest * aims)
            for left, right, score in _tiles(anchors, rows):
                hundred = 100 * score
                fits = (ask_label[left][:, None] != labels[right]) & (hundred >= low[left][:, None]) & (hundred <= high[left][:, None])
                at, of = np.nonzero(fits)
                found, at = hundred[at, of], at + left.start
                for nth in range(int(count.max(initial=0))):
                    own = begin[at] + nth
                    has = np.flatnonzero(nth < count[at])
                    has = has[(least * aims[own[has]] <= found[has]) & (found[has] <= largest * aims[own[has]])]
                    heaps.add(keys[own[has]], found[has] // 100, ids[right][of[has]])
        return pa.table([heaps.key, heaps.id, heaps.score], ["key", "id", "score"])

    return work


def _vectors(df: DataFrame, id_col: str, vec_col: str, label: Column) -> DataFrame:
    """(id, label, vec) of the rows that take part, in integers; rows that repeat are one."""
    rows = df.select(column(df, id_col).cast("bigint").alias("id"), label.cast("bigint").alias("label"), column(df, vec_col).cast("array<double>").alias("vec"))
    is_bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull() & ~F.exists("vec", is_bad))
    square = F.aggregate("vec", F.lit(0.0), lambda s, x: s + F.pow(x * SCALE, F.lit(2)))
    rows = rows.filter(square <= LARGEST_SQUARE)
    return rows.select("id", "label", F.transform("vec", lambda x: F.floor(x * SCALE).cast("bigint")).alias("vec")).dropDuplicates()


def mine(
    df: DataFrame, id_col: str, vec_col: str, label: Column, is_anchor: Column,
    positives: int = POSITIVES, negatives: int = NEGATIVES, window: tuple[int, int] = WINDOW,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``label`` is an expression over ``df``, ``is_anchor`` one over ``id``. Up to ``positives`` rows of an
    anchor's label, and for each up to ``negatives`` rows of other labels whose score is between the two
    percentages of ``window`` of the positive's.
    """
    rows = materialize(_vectors(df, id_col, vec_col, label), "vectors", release=True)
    asked = materialize(rows.filter(is_anchor).withColumn("ask", F.monotonically_increasing_id()), "anchors")
    n, n_asked = rows.count(), asked.count()
    # Sides of a block grow with the root of the table up to what one group may hold.
    block = min(LARGEST_BLOCK, max(LEAST_BLOCK, BLOCK_ROOT * isqrt(n)))
    row_blocks, ask_blocks = -(-n // block) or 1, -(-n_asked // block) or 1
    group = ["size", "ask_block", "row_block"]

    def dealt(side: DataFrame, own: str, blocks: int, other: str, others: int) -> DataFrame:
        """Each row in its block, once for each block of the other side."""
        number = F.pmod(F.xxhash64("id", "vec", "label"), F.lit(blocks)).cast("int")
        return side.withColumns({"size": F.size("vec"), own: number, other: F.explode(F.sequence(F.lit(0), F.lit(others - 1)))})

    def met(anchors: DataFrame, work, schema: str) -> DataFrame:
        left = dealt(anchors, "ask_block", ask_blocks, "row_block", row_blocks)
        right = dealt(rows, "row_block", row_blocks, "ask_block", ask_blocks)
        return left.groupBy(*group).cogroup(right.groupBy(*group)).applyInArrow(work, schema)

    def merged(found: DataFrame, key: str, most: int) -> DataFrame:
        order = W.partitionBy(key).orderBy(F.desc("score"), "id")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)

    best = merged(met(asked, _best_positives(positives), "ask bigint, id bigint, score bigint"), "ask", positives)
    # A positive's window is known by its anchor and its rank.
    best = best.select("ask", (F.col("ask") * positives + F.col("rank") - 1).alias("key"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    best = materialize(best, "positives", release=True)
    windows = best.groupBy("ask").agg(F.array_sort(F.collect_list(F.struct("key", F.col("positive_score").alias("score")))).alias("positives"))
    asked_again = asked.join(windows, "ask")
    found = merged(met(asked_again, _best_in_windows(negatives, window), "key bigint, id bigint, score bigint"), "key", negatives)
    found = materialize(found, "negatives", release=True)
    discard(rows)
    out = found.join(best, "key").join(asked.select("ask", F.col("id").alias("anchor_id")), "ask")
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
