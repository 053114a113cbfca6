"""Approximate nearest neighbours by cross-polytope hashing, with exact reranking.

A table turns unit vectors by a pseudo-rotation (three rounds of random signs and a fast Hadamard
transform) and puts each below the signed axis that is nearest. A query looks below the
``probes`` nearest axes of each of ``tables`` tables. Rows of an axis are dealt out in blocks; each
block and the queries that look there meet in one group, and exact distances decide.

Equal vectors are one class with its smallest ids, so copies cost nothing; queries with equal
vectors are one query. A query that finds fewer than it asked for looks below all axes.

Distances are Euclidean, in double precision, on the vectors as they are. Defined results: vectors
that are null, zero or hold null, NaN or infinite parts take no part; vectors of another
length never meet; ties go to the smaller id; rows of one id and vector are one row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedlake.llm.rows import pick
from feedlake.session import materialize

TABLES, PROBES = 8, 10
BLOCK = 512
_SEED = 7_919


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of each row, not normalised."""
    n, step = x.shape[1], 1
    while step < n:
        pairs = x.reshape(len(x), n // (2 * step), 2, step)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(x), n)
        step *= 2
    return x


def rotate(unit: np.ndarray, table: int) -> np.ndarray:
    """The pseudo-rotation of a table; rows are filled up with zeros to a power of two."""
    width = 1 << max(unit.shape[1] - 1, 0).bit_length()
    x = np.zeros((len(unit), width))
    x[:, : unit.shape[1]] = unit
    draw = np.random.default_rng([_SEED, table])
    for _ in range(3):
        x = hadamard(x * draw.choice([-1.0, 1.0], width))
    return x


def axes(unit: np.ndarray, table: int, probes: int) -> np.ndarray:
    """The nearest signed axes of each row, nearest first: 2 * axis, and 1 more for its negative."""
    x = rotate(unit, table)
    probes = min(probes, 2 * x.shape[1])
    signed = np.stack([x, -x], axis=2).reshape(len(x), -1)
    return np.argsort(-signed, axis=1, kind="stable")[:, :probes]


def _hashed(vectors: DataFrame, tables: int, probes: int, keep: list[str]) -> DataFrame:
    """A row per vector, table and probe: the columns of ``keep``, vec and ``bucket``."""

    def run(batches):
        for batch in batches:
            lists = batch.column("vec")
            sizes = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            starts = np.cumsum(sizes) - sizes
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                for part in np.array_split(rows, len(rows) // 2048 + 1):
                    x = flat[starts[part][:, None] + np.arange(size)]
                    # Scaled first, so that neither tiny nor huge parts overflow.
                    x = x / np.abs(x).max(axis=1, keepdims=True)
                    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
                    found = np.stack([axes(unit, t, probes) for t in range(tables)], axis=1)
                    bucket = (int(size) * tables + np.arange(tables))[None, :, None] * (1 << 32) + found
                    times = found.shape[1] * found.shape[2]
                    out = batch.take(pa.array(np.repeat(part, times)))
                    yield pa.record_batch([*(out.column(c) for c in [*keep, "vec"]), pa.array(bucket.reshape(-1))], [*keep, "vec", "bucket"])

    kinds = ", ".join(f"{c} {vectors.schema[c].dataType.simpleString()}" for c in keep)
    return vectors.mapInArrow(run, f"{kinds}, vec array<double>, bucket bigint")


def _search(queries: DataFrame, rows: DataFrame, tables: int, probes: int, most: int, block: int) -> DataFrame:
    """(query, id, score): the nearest rows of each query in each group, more than one may be equal."""
    base = materialize(_hashed(rows, tables, 1, ["id"]), "index")
    blocks = base.groupBy("bucket").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    blocks = materialize(blocks, "blocks")
    base = base.join(blocks, "bucket").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).drop("blocks")
    asked = _hashed(queries, tables, probes, ["query"]).join(blocks, "bucket")
    asked = asked.select("query", "vec", "bucket", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))

    def nearest(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        if left.num_rows and right.num_rows:
            width = len(left.column("vec")[0])
            at = right.column("vec").combine_chunks().flatten().to_numpy().reshape(-1, width)
            ids = right.column("id").to_numpy()
            asked_at = left.column("vec").combine_chunks().flatten().to_numpy().reshape(-1, width)
            for query, vec in zip(left.column("query").to_numpy(), asked_at, strict=True):
                score = np.sqrt(np.square(at - vec).sum(axis=1))
                order = np.lexsort((ids, score))[:most]
                out.append((np.full(len(order), query), ids[order], score[order]))
        columns = [np.concatenate([o[i] for o in out]) if out else np.zeros(0, k) for i, k in enumerate((np.int64, np.int64, np.float64))]
        return pa.table(columns, ["query", "id", "score"])

    key = ["bucket", "block"]
    return asked.groupBy(*key).cogroup(base.groupBy(*key)).applyInArrow(nearest, "query bigint, id bigint, score double")


def _best(found: DataFrame, most: int) -> DataFrame:
    order = W.partitionBy("query").orderBy("score", "id")
    return found.distinct().withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= most).drop("nth")


def neighbours(
    df: DataFrame, id_col: str, vec_col: str, is_query: Column, k: int = 10, tables: int = TABLES, probes: int = PROBES, block: int = BLOCK
) -> DataFrame:
    """(query_id, rank, vec_id, score): up to ``k`` nearest other rows of each row with ``is_query``."""
    rows = pick(df, id=id_col, vec=vec_col).select(F.col("id").cast("bigint").alias("id"), F.col("vec").cast("array<double>").alias("vec")).filter("id is not null")
    part_is_bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    rows = rows.filter(F.col("vec").isNotNull() & ~F.exists("vec", part_is_bad) & F.exists("vec", lambda x: x != 0))
    rows = rows.withColumn("same_a", F.xxhash64("vec")).withColumn("same_b", F.xxhash64("vec", F.lit(1)))
    same = ["same_a", "same_b"]
    # The smallest ids of each class: as many as one result can hold, and the query's own.
    nth = F.row_number().over(W.partitionBy(*same).orderBy("id"))
    members = rows.select("id", *same).distinct().withColumn("nth", nth).filter(F.col("nth") <= k + 1)
    members = materialize(members.withColumn("class", F.min("id").over(W.partitionBy(*same))).select("id", "class", *same), "members")
    classes = members.filter("id = class").select("id", *same)
    vectors = materialize(rows.dropDuplicates(["id", *same]).join(classes, ["id", *same]).select("id", "vec"), "vectors")
    wanted = rows.filter(is_query).select(F.col("id").alias("asks"), *same).distinct()
    wanted = materialize(wanted.join(classes, same).select("asks", F.col("id").alias("class")), "queries")
    queries = vectors.join(wanted.select(F.col("class").alias("id")).distinct(), "id").select(F.col("id").alias("query"), "vec")
    queries = materialize(queries, "asked")
    found = materialize(_best(_search(queries, vectors, tables, probes, k + 1, block), k + 1), "found")
    counts = found.groupBy("query").count()
    short = queries.join(counts.filter(F.col("count") > k).select("query"), "query", "left_anti")
    short = materialize(short, "short")
    if not short.isEmpty():
        every = _search(short, vectors, 1, 1 << 30, k + 1, block)
        found = materialize(_best(found.join(short.select("query"), "query", "left_anti").unionByName(every), k + 1), "found")
    near = found.join(members.select(F.col("class").alias("id"), F.col("id").alias("vec_id")), "id")
    pairs = wanted.select("asks", F.col("class").alias("query")).join(near.select("query", "vec_id", "score"), "query").filter("asks <> vec_id")
    rank = F.row_number().over(W.partitionBy("asks").orderBy("score", "vec_id"))
    out = pairs.select("asks", "vec_id", "score").withColumn("rank", rank).filter(F.col("rank") <= k)
    return out.select(F.col("asks").alias("query_id"), F.col("rank").cast("int").alias("rank"), "vec_id", "score")
