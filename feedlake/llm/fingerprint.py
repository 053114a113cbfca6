"""MinHash fingerprints of texts, their likeness, and verified pairs of similar texts.

A text's shingles are runs of ``SHINGLE`` words (in lower case); a shorter text is one shingle as
a whole. Each of the hash functions of a universal family gives the least value over the
shingles; numpy does this for a block of texts at once. Two fingerprints agree in a share of their
values that estimates the Jaccard similarity of the shingle sets.

Defined results: a null text is an empty one; texts without words have a fingerprint of zeros, are
alike among each other (1.0) and unlike all others (0.0); equal texts have equal fingerprints.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.llm.rows import map_slices, pick
from feedlake.llm.shingling import shingles
from feedlake.session import materialize

VALUES = 64
SHINGLE = 5
SIMILAR = 0.8

_SEED = 20_231


def _family(values: int) -> tuple[np.ndarray, np.ndarray]:
    """Multiply-shift: (a * x + b) >> 32 for odd a is universal on 64-bit x."""
    draw = np.random.default_rng(_SEED)
    a = draw.integers(0, 1 << 63, values, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, draw.integers(0, 1 << 63, values, dtype=np.uint64)


#: Texts are taken in blocks of so many characters; a longer one is cut into runs of words that
#: overlap by a shingle, whose least values are merged.
BLOCK = 400_000
#: Words as shingles have them: other white space is part of a word.
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _pieces(texts: list[str], size: int) -> Iterator[tuple[list[int], list[str]]]:
    owners, block, held = [], [], 0
    for i, text in enumerate(texts):
        parts = [text]
        if len(text) > 2 * BLOCK:
            words, step = _WORD.findall(text), BLOCK // 8
            parts = [" ".join(words[k : k + step + size - 1]) for k in range(0, max(len(words) - size + 1, 1), step)]
        for part in parts:
            if block and held + len(part) > BLOCK:
                yield owners, block
                owners, block, held = [], [], 0
            owners.append(i)
            block.append(part)
            held += len(part)
    if block:
        yield owners, block


def signatures(texts: list[str], values: int = VALUES, size: int = SHINGLE) -> np.ndarray:
    """A row of ``values`` 32-bit values per text; zeros for a text without words."""
    out = np.full((len(texts), values), 0xFFFFFFFF, np.uint32)
    seen = np.zeros(len(texts), bool)
    a, b = _family(values)
    for owners, block in _pieces(texts, size):
        hashes, counts = shingles([t.lower().encode("utf-8", "surrogatepass") for t in block], size)
        some = np.flatnonzero(counts)
        if not len(some):
            continue
        at, owner = (np.cumsum(counts) - counts)[some], np.array(owners)[some]
        least = np.empty((len(some), values), np.uint32)
        for j in range(values):
            least[:, j] = np.minimum.reduceat(((hashes * a[j] + b[j]) >> np.uint64(32)).astype(np.uint32), at)
        np.minimum.at(out, owner, least)
        seen[owner] = True
    out[~seen] = 0
    return out


def _hex(rows: np.ndarray) -> list[str]:
    data, width = rows.astype(">u4").tobytes().hex(), rows.shape[1] * 8
    return [data[i * width : (i + 1) * width] for i in range(len(rows))]


def likeness(left: Column, right: Column, values: int = VALUES) -> Column:
    """Share of the values in which two fingerprints (hex strings) agree."""
    parts = lambda c: F.transform(F.sequence(F.lit(0), F.lit(values - 1)), lambda i: F.substring(c, i * 8 + 1, F.lit(8)))
    same = F.size(F.filter(F.zip_with(parts(left), parts(right), lambda a, b: a == b), lambda x: x))
    return same / F.lit(values)


def fingerprint(df: DataFrame, id_col: str, text_col: str, values: int = VALUES, size: int = SHINGLE) -> DataFrame:
    """(id, fingerprint) of every text; no shuffle."""
    docs = pick(df, id=id_col, text=text_col)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = signatures([t or "" for t in batch.column("text").to_pylist()], values, size)
        return pa.record_batch([batch.column("id"), pa.array(_hex(rows))], ["id", "fingerprint"])

    kind = docs.schema["id"].dataType.simpleString()
    return map_slices(docs, work, f"id {kind}, fingerprint string").toDF(id_col, "fingerprint")


def similar_pairs(
    df: DataFrame, id_col: str, text_col: str, similar: float = SIMILAR, values: int = VALUES, rows: int = 4, size: int = SHINGLE
) -> DataFrame:
    """(left_id, right_id, jaccard) of texts whose bands meet and whose shingle sets agree.

    Texts with one and the same shingle set are one class; pairs are between the least ids of
    classes, so that copies do not multiply. A band is ``rows`` values of the fingerprint.
    Similarity is verified on whole sets of shingles.
    """
    docs = pick(df, id=id_col, text=text_col)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        sets, counts = shingles([t.lower().encode("utf-8", "surrogatepass") for t in texts], size)
        cuts = np.split(sets, np.cumsum(counts)[:-1])
        sets = [np.unique(x).view(np.int64) for x in cuts]
        prints = _hex(signatures(texts, values, size))
        return pa.record_batch(
            [batch.column("id"), pa.array(prints), pa.array(sets, pa.list_(pa.int64()))], ["id", "fingerprint", "shingles"]
        )

    kind = docs.schema["id"].dataType.simpleString()
    found = map_slices(docs, work, f"id {kind}, fingerprint string, shingles array<bigint>").filter("size(shingles) > 0")
    classes = materialize(found.groupBy("shingles").agg(F.min("id").alias("id"), F.min("fingerprint").alias("fingerprint")), "classes")
    width = 8 * rows
    bands = F.transform(F.sequence(F.lit(0), F.lit(values // rows - 1)), lambda i: F.struct(i.alias("band"), F.substring("fingerprint", i * width + 1, F.lit(width)).alias("key")))
    keys = classes.select("id", F.size("shingles").alias("n"), F.inline(bands))
    pairs = (
        keys.alias("a").join(keys.alias("b"), ["band", "key"])
        .filter("a.id < b.id and least(a.n, b.n) >= {0} * greatest(a.n, b.n)".format(similar))
        .select(F.col("a.id").alias("left_id"), F.col("b.id").alias("right_id")).distinct()
    )
    sets = classes.select("id", "shingles")
    both = pairs.join(sets.toDF("left_id", "x"), "left_id").join(sets.toDF("right_id", "y"), "right_id")
    common = F.size(F.array_intersect("x", "y"))
    jaccard = common / (F.size("x") + F.size("y") - common)
    return both.select("left_id", "right_id", jaccard.alias("jaccard")).filter(F.col("jaccard") >= similar)


def follow(df: DataFrame, id_col: str, text_col: str, values: int = VALUES, size: int = SHINGLE) -> DataFrame:
    """Each text beside an edited copy of it and the text that follows in descending id.

    The last floor(n/2) code points are replaced by the first as many of the next text; after
    the smallest id comes the largest. Returns id, n_chars, edited, fingerprint, edited_fingerprint,
    near_edited, near_next. Rows without an id come last; rows of one id follow each other by text.

    The ids alone are read first for cut points. Then the texts are dealt out once, by ranges of
    ids; the first text of each range is also sent to the range before it, as its end.
    """
    docs = pick(df, id=id_col, text=text_col).withColumn("id", F.col("id").cast("bigint"))
    ids = docs.select("id").filter("id is not null")
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    steps = [i / parts for i in range(1, parts)]
    cuts = sorted(set(ids.approxQuantile("id", steps, 0.2 / parts))) if steps else []
    # Ranges count from the largest ids down; rows without an id stand behind the smallest.
    high = -np.array(cuts[::-1], np.float64)

    def ranges(ids) -> np.ndarray:
        return np.where(ids.isna(), len(high), np.searchsorted(high, -ids.fillna(0).to_numpy(np.float64), "right"))

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        return pd.Series(ranges(ids).astype(np.int32))

    # The largest id of each range is the end of the range before it: a row per range.
    tops = docs.select("id", range_of("id").alias("place")).groupBy("place").agg(F.max("id").alias("top")).collect()
    tops = sorted((r["place"], r["top"]) for r in tops)
    ends = {}
    for i, (place, _) in enumerate(tops):
        ends.setdefault(tops[(i + 1) % len(tops)][1], []).append(place)

    @F.pandas_udf("array<int>")
    def end_of(ids: pd.Series) -> pd.Series:
        return pd.Series([ends.get(None if pd.isna(i) else int(i)) for i in ids])

    row = F.array(F.struct(range_of("id").alias("place"), F.lit(False).alias("last")))
    closing = F.transform(end_of("id"), lambda p: F.struct(p.alias("place"), F.lit(True).alias("last")))
    rows = docs.select("id", "text", F.inline(F.concat(row, F.coalesce(closing, F.slice(row, 1, 0)))))
    dealt = rows.repartitionById(len(cuts) + 1, F.col("place"))
    return _followed(dealt.sortWithinPartitions("last", F.desc_nulls_last("id"), "text"), values, size, id_col)


def _followed(ordered: DataFrame, values: int, size: int, id_col: str) -> DataFrame:
    names = ["id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def block(ids: list, texts: list[str], after: str) -> pa.RecordBatch:
        ahead = [*texts[1:], after]
        edited = [t[: len(t) - len(t) // 2] + nxt[: len(t) // 2] for t, nxt in zip(texts, ahead, strict=True)]
        own = signatures([*texts, after], values, size)
        changed = signatures(edited, values, size)
        near_edited, near_next = (own[:-1] == changed).mean(axis=1), (own[:-1] == own[1:]).mean(axis=1)
        columns = [ids, list(map(len, texts)), edited, _hex(own[:-1]), _hex(changed), near_edited, near_next]
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, held, closed = [], [], 0, False
        for batch in batches:
            for i, text, last in zip(*(batch.column(k).to_pylist() for k in ("id", "text", "last")), strict=True):
                text = text or ""
                if last:
                    if not closed and texts:  # further rows of the same id begin the next range, but later
                        yield block(ids, texts, text)
                        closed = True
                    continue
                if held > BLOCK:
                    yield block(ids, texts, text)
                    ids, texts, held = [], [], 0
                ids.append(i)
                texts.append(text)
                held += len(text) + 64

    schema = "id bigint, n_chars bigint, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return ordered.select("id", "text", "last").mapInArrow(run, schema).withColumnRenamed("id", id_col)
