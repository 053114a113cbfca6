"""Near-duplicate documents: one-permutation MinHash, optimal densification, banded buckets.

One hash function deals the shingles of a document out to bins; the signature is the least hash in
each bin. An empty bin takes the value of the first filled one on a random walk of its own, which
is the same for every document. Bands of the signature are keys; documents that share a key are
candidates in the shape of a star (see ``linking``), and every link is confirmed on full sets.

With 40 bands of 5 bins a pair of similarity 0.8 shares no band with a probability of 1e-7. Sets
of fewer than four shingles reach 0.8 with equal sets only, and those are one class from the start.

Defined results: a null text is an empty one; a document without words is linked with nothing;
rows without an id are linked with nothing, have no component and are kept; rows of one id count
as one document with the links of all its rows.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.linking import Near, link
from feedlake.llm.rows import map_slices, pick
from feedlake.llm.shingling import mix, shingles
from feedlake.operators.keyed import restrict
from feedlake.session import discard, materialize

BANDS, ROWS = 40, 5
#: Bands whose keys are dealt out at a time.
BANDS_AT_A_TIME = 10
SIMILAR_PERCENT = 80
SHINGLE = 5
#: Of the 192 bits that pairs are tested on, so many may differ. At a similarity of 0.8 some 19 do;
#: 60 is ten standard deviations above that.
BITS, MOST_BITS = 192, 60
#: Bits of a set in which the members of crowded keys are compared, 64 to a column.
MASK_BITS = 1024
_SEED = 61_409


def _sets(texts: list[str | None], size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text, sorted, one text after another, and how many each has.

    ``bytes.lower`` changes A to Z and nothing else.
    """
    hashes, counts = shingles([(t or "").encode("utf-8", "surrogatepass").lower() for t in texts], size)
    owner = np.repeat(np.arange(len(texts)), counts)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[new], np.bincount(owner[new], minlength=len(texts))


def signatures(sets: np.ndarray, counts: np.ndarray, bins: int) -> np.ndarray:
    """Dense one-permutation signatures of 32-bit values; rows of empty sets are zeros."""
    n = len(counts)
    empty = np.uint64(1 << 32)
    mixed = mix(sets ^ np.uint64(_SEED))
    owner = np.repeat(np.arange(n), counts)
    place = owner * bins + ((mixed >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    least = np.full(n * bins, empty, np.uint64)
    np.minimum.at(least, place, mixed & np.uint64(0xFFFFFFFF))
    first = least.reshape(n, bins)
    dense = first.copy()
    row, column = np.nonzero((first == empty) & (counts > 0)[:, None])
    attempt = 0
    while len(row):
        attempt += 1
        step = mix((column.astype(np.uint64) << np.uint64(32)) + np.uint64(attempt))
        value = first[row, (step % np.uint64(bins)).astype(np.int64)]
        hit = value != empty
        dense[row[hit], column[hit]] = value[hit]
        row, column = row[~hit], column[~hit]
    dense[counts == 0] = 0
    return dense.astype(np.uint32)


def _sketches(docs: DataFrame, size: int) -> DataFrame:
    """id, n, set_a and set_b (which tell sets apart), bands and bits of every document."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets, counts = _sets(batch.column("text").to_pylist(), size)
        owner = np.repeat(np.arange(len(counts)), counts)
        known = np.zeros((2, len(counts)), np.uint64)
        for i, salt in enumerate((0x243F6A8885A308D3, 0x13198A2E03707344)):
            np.add.at(known[i], owner, mix(sets + np.uint64(salt)))
        bins = signatures(sets, counts, BANDS * ROWS)
        # A band's key mixes its number and its values.
        keys = np.tile(np.arange(BANDS, dtype=np.uint64), (len(counts), 1))
        for r in range(ROWS):
            keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + bins[:, r::ROWS])
        bits = np.packbits((mix(bins[:, :BITS].astype(np.uint64)) & np.uint64(1)).astype(np.uint8), axis=1).view(np.int64)
        return pa.record_batch(
            [
                batch.column("id"), pa.array(counts, pa.int64()), pa.array(known[0].view(np.int64)), pa.array(known[1].view(np.int64)),
                pa.array(list(keys.view(np.int64)), pa.list_(pa.int64())), *(pa.array(np.ascontiguousarray(bits[:, i])) for i in range(BITS // 64)),
            ],
            ["id", "n", "set_a", "set_b", "bands", *(f"bits{i}" for i in range(BITS // 64))],
        )

    bits = ", ".join(f"bits{i} bigint" for i in range(BITS // 64))
    return map_slices(docs, work, f"id bigint, n bigint, set_a bigint, set_b bigint, bands array<bigint>, {bits}")


def _sets_of(docs: DataFrame, ids: DataFrame, size: int, masks: int = 0) -> DataFrame:
    """(id, shingles) of the documents with these ids, made anew from the texts.

    With so many columns ``mask<i>`` of 64 bits: a bit is set if a shingle has its number as a hash.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets, counts = _sets(batch.column("text").to_pylist(), size)
        offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
        flags = np.zeros((len(counts), 64 * masks), bool)
        if masks:
            flags[np.repeat(np.arange(len(counts)), counts), (mix(sets) % np.uint64(64 * masks)).astype(np.int64)] = True
        bits = np.packbits(flags, axis=1).view(np.int64) if masks else flags
        columns = [pa.array(np.ascontiguousarray(bits[:, i])) for i in range(masks)]
        sets = pa.ListArray.from_arrays(offsets, pa.array(sets.view(np.int64)))
        return pa.record_batch([batch.column("id"), sets, *columns], ["id", "shingles", *names])

    names = [f"mask{i}" for i in range(masks)]
    schema = ", ".join(["id bigint, shingles array<bigint>", *(f"{c} bigint" for c in names)])
    return map_slices(restrict(docs, ids, "id", "left_semi"), work, schema)


def _confirm(docs: DataFrame, size: int, percent: int):
    """Of pairs (a, b) those whose full sets are similar."""

    def confirm(pairs: DataFrame) -> DataFrame:
        ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b"))
        sets = materialize(_sets_of(docs, ids, size), "sets")
        both = pairs.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b")
        common = F.size(F.array_intersect("x", "y"))
        links = both.filter(100 * common >= percent * (F.size("x") + F.size("y") - common)).select("a", "b").distinct()
        links = materialize(links, "similar", release=True)
        discard(sets)
        return links

    return confirm


def _alone(docs: DataFrame, size: int):
    """(id, own, masks): how many shingles of a document none of the others given has, and the bits of its set.

    Ids of several rows are left out: one of their sets has not what another one has.
    """

    def alone(ids: DataFrame) -> DataFrame:
        sets = materialize(_sets_of(docs, ids, size, MASK_BITS // 64), "sets")
        parts = sets.select("id", F.explode("shingles").alias("part"))
        single = parts.groupBy("part").agg(F.min("id").alias("id"), F.count("*").alias("n")).filter("n = 1")
        own = single.groupBy("id").agg(F.count("*").alias("own"))
        once = sets.groupBy("id").count().filter("count = 1").join(own, "id", "left").select("id", F.coalesce("own", F.lit(0)).alias("own"))
        found = materialize(once.join(sets.drop("shingles"), "id"), "alone", release=True)
        discard(sets)
        return found

    return alone


def components(df: DataFrame, id_col: str, text_col: str, size: int = SHINGLE, percent: int = SIMILAR_PERCENT) -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row of ``df``."""
    if percent < SIMILAR_PERCENT:
        raise ValueError("the bands are laid out for a similarity of 80 percent or more")
    docs = pick(df, id=id_col, text=text_col).withColumn("id", F.col("id").cast("bigint"))
    sketches = materialize(_sketches(docs, size), "sketches")
    facts = [c for c in sketches.columns if c not in ("id", "set_a", "set_b")]
    classes = sketches.filter("id is not null and n > 0").groupBy("set_a", "set_b").agg(F.min(F.struct("id", *facts)).alias("x"))
    classes = materialize(classes.select("set_a", "set_b", "x.*"), "classes", release=True)
    # Only the classes are compared: the bands of the other rows need not lie on disk any longer.
    bands, sketches = sketches, materialize(sketches.select("id", "n", "set_a", "set_b"), "sketches")
    discard(bands)
    # A smaller set than this cannot be similar to another one without being equal to it.
    least = ceil(percent / (100 - percent)) if percent < 100 else 1 << 62
    near = Near("n", percent, tuple(f"bits{i}" for i in range(BITS // 64)), MOST_BITS)
    named = docs.filter("id is not null")
    facts = classes.filter(F.col("n") >= least).drop("set_a", "set_b")
    roots = link(facts, [F.slice("bands", i + 1, BANDS_AT_A_TIME) for i in range(0, BANDS, BANDS_AT_A_TIME)], near, _confirm(named, size, percent), _alone(named, size))
    of_class = materialize(classes.join(roots, "id", "left").select("set_a", "set_b", F.coalesce("root", "id").alias("root")), "of_class", release=True)
    discard(classes)
    rows = sketches.select("id", "n", "set_a", "set_b").join(of_class, ["set_a", "set_b"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("root", "id"))
    return rows.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def keep_one(df: DataFrame, id_col: str, text_col: str, size: int = SHINGLE, percent: int = SIMILAR_PERCENT) -> DataFrame:
    """``df`` with one document of each group; rows that share an id leave one, any of equal standing.

    Which rows go is known by id: usually few enough to be sent to every task (by measured
    size), else joined by shuffle.
    """
    found = components(df, id_col, text_col, size, percent)
    gone = found.filter(~F.col("kept")).select(F.col(id_col).cast("string").alias("gone"))
    name = "`" + id_col.replace("`", "``") + "`"
    marked = df.withColumn("_feedlake_key", F.col(name).cast("string"))
    left = restrict(marked, gone.withColumnRenamed("gone", "_feedlake_key"), "_feedlake_key", "left_anti").drop("_feedlake_key")
    repeated = materialize(found.filter(F.col(id_col).isNotNull()).groupBy(id_col).count().filter("count > 1"), "repeated")
    if repeated.isEmpty():
        return left
    once, more = (restrict(left, repeated, id_col, how) for how in ("left_anti", "left_semi"))
    return once.union(more.dropDuplicates([id_col]))
