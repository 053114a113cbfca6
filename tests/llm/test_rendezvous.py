"""Rendezvous sharding against a plain loop over the shards."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from feedlake.llm import rendezvous


def shard_of(key, weights):
    def score(i):
        u = (int(hashlib.md5(f"{'' if key is None else key}:{i}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        return -math.log(u) / weights[i]

    return min((score(i), i) for i in range(len(weights)) if weights[i] > 0)[1]


def placed(spark, n, weights, **more):
    return rendezvous.assign(spark.range(n), "id", weights, **more).collect()


@pytest.mark.parametrize("weights", [[1.0], [1.0] * 24, [0.0, 3.0, 1.0, 0.5], [1e-9, 1e9]])
def test_assign_equals_a_loop(spark, weights):
    found = placed(spark, 2000, weights, grown=2.0)
    assert [(r.shard, r.grown_shard) for r in found] == [(shard_of(r.id, weights), shard_of(r.id, [*weights, 2.0])) for r in found]


def test_shares_follow_the_weights_and_changes_move_little(spark):
    weights, n = [4.0, 2.0, 1.0, 1.0], 20_000
    before = {r.id: r.shard for r in placed(spark, n, weights)}
    share = Counter(before.values())
    for i, w in enumerate(weights):
        p = w / sum(weights)
        assert abs(share[i] - n * p) < 5 * math.sqrt(n * p * (1 - p))
    moved = lambda now: {(before[r.id], r.shard) for r in now if before[r.id] != r.shard}
    assert {to for _, to in moved(placed(spark, n, [*weights, 1.0]))} == {4}
    assert {of for of, _ in moved(placed(spark, n, [4.0, 0.0, 1.0, 1.0]))} == {1}
    assert {to for _, to in moved(placed(spark, n, [4.0, 2.0, 1.5, 1.0]))} == {2}
    grown = placed(spark, n, weights, grown=1.0)
    assert 0 < sum(r.shard != r.grown_shard for r in grown) < 2 * n / 9


@pytest.mark.parametrize("weights", [[], [0.0], [-1.0, 2.0], [float("nan")], [float("inf")]])
def test_bad_weights(spark, weights):
    with pytest.raises(ValueError, match="weights"):
        rendezvous.assign(spark.range(1), "id", weights)


def check_slots(rows):
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    assert all(sorted(slots) == list(range(len(slots))) for slots in by.values())


def test_odd_rows(spark):
    rows = [(None, "a"), (None, "a"), (None, None), (3, ""), (3, None), (4, "é🦊"), (5, "x" * 3_000_000), (4, "é🦊")]
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "id long, text string, shard int, key string, _scores int")
    found = rendezvous.numbered(rendezvous.sizes(df, "id", "text", [1.0] * 5, grown=1.0)).collect()
    facts = lambda i, t: (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()), shard_of(i, [1.0] * 5), shard_of(i, [1.0] * 6))
    assert Counter((r.key, r.size, r.text_crc32, r.shard, r.grown_shard) for r in found) == Counter(facts(i, t) for i, t in rows)
    check_slots(found)
    kept = rendezvous.assign(df, "id", [1.0] * 5)
    assert kept.columns == [*df.columns, "shard_"] and kept.drop("shard_").exceptAll(df).isEmpty()
    assert rendezvous.numbered(rendezvous.sizes(df.limit(0), "id", "text", [1.0])).count() == 0


def test_slots_with_a_key_that_holds_a_third_of_the_rows(spark, monkeypatch):
    monkeypatch.setattr(rendezvous, "PIECE", 64)
    df = spark.range(6000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("id"), F.when(F.col("id") % 9 == 0, F.col("id").cast("string")).otherwise("t").alias("text"))
    sizes = rendezvous.sizes(df, "id", "text", [1.0] * 6)
    found = rendezvous.numbered(sizes).collect()
    check_slots(found)
    assert len(found) == 6000 and all(r.grown_shard is None for r in found)
    again = rendezvous.numbered(sizes.repartition(5)).collect()
    assert sorted(map(tuple, map(lambda r: (r.key, r.text_crc32, r.slot), again))) == sorted((r.key, r.text_crc32, r.slot) for r in found)


def test_written_shards_hold_all_rows(spark, tmp_path):
    df = spark.range(300).select("id", F.col("id").cast("string").alias("shard"))
    rendezvous.write_shards(df, "id", [1.0, 2.0], str(tmp_path / "out"))
    found = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r.id, r.shard, r.shard_) for r in found) == [(i, str(i), shard_of(i, [1.0, 2.0])) for i in range(300)]
