"""Hard negatives: products of tiles against Python integers, results against a plain loop."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedlake.llm import hard_negatives
from feedlake.llm.hard_negatives import strassen


@pytest.mark.parametrize("shape", [(1, 1, 1), (17, 17, 17), (33, 64, 70), (256, 64, 300), (5, 0, 4), (31, 47, 129), (64, 100, 18)])
@pytest.mark.parametrize("largest", [3, 1 << 28])
def test_strassen_is_exact(shape, largest):
    m, d, k = shape
    rnd = np.random.default_rng([m, d, k])
    a, b = rnd.integers(-largest, largest, (m, d)), rnd.integers(-largest, largest, (d, k))
    want = [[sum(int(x) * int(y) for x, y in zip(row, column, strict=True)) for column in b.T] for row in a]
    assert strassen(a, b).tolist() == want


def test_sums_may_wrap_on_the_way():
    a = np.full((64, 64), 1 << 61, np.int64)
    b = np.zeros((64, 64), np.int64)
    b[0] = 3
    b[1] = -2
    # Halves of a add up to 2**63 and more; the product itself is 2**61.
    assert (strassen(a, b) == 1 << 61).all()


def test_heaps_merge_in_any_order():
    rnd = random.Random(5)
    rows = [(rnd.randrange(4), rnd.randrange(6), i) for i in range(200)]
    want = [r for k in range(4) for r in sorted((r for r in rows if r[0] == k), key=lambda r: (-r[1], r[2]))[:5]]
    for _ in range(4):
        rnd.shuffle(rows)
        heaps, at = hard_negatives.Heaps(5), 0
        while at < len(rows):
            part = rows[at : at + rnd.randrange(1, 40)]
            heaps.add(*(np.array(c, np.int64) for c in zip(*part, strict=True)))
            at += len(part)
        assert list(zip(heaps.key.tolist(), heaps.score.tolist(), heaps.id.tolist(), strict=True)) == want


def mined(rows, every, most=5, low=80):
    """Rows (id, label, vec), without repeated ones: the same by loops."""
    part = [(i, g, [math.floor(256 * float(x)) for x in v]) for i, g, v in rows if None not in (i, g, v) and all(x is not None and math.isfinite(x) for x in v)]
    part = list({(i, g, tuple(v)) for i, g, v in part if sum(x * x for x in v) <= 2**56})
    out = []
    for a, label, va in part:
        if a % every:
            continue
        near = [(sum(x * y for x, y in zip(va, v, strict=True)), i, g) for i, g, v in part if i != a and len(v) == len(va)]
        for ps, p in sorted(((s, i) for s, i, g in near if g == label), key=lambda r: (-r[0], r[1]))[:most]:
            fits = sorted(((s, i) for s, i, g in near if g != label and low * ps <= 100 * s <= 100 * ps), key=lambda r: (-r[0], r[1]))
            out += [(a, p, n + 1, i, ps, s) for n, (s, i) in enumerate(fits[:most])]
    return sorted(out)


def run(spark, rows, every, kind="double"):
    df = spark.createDataFrame([(i, g, v, 1, 2) for i, g, v in rows], f"id long, label int, vec array<{kind}>, ask int, positives int")
    found = hard_negatives.mine(df, "id", "vec", F.col("label"), F.col("id") % every == 0)
    return sorted(tuple(r) for r in found.collect())


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, 1, [1.0, 0.5]), (1, 1, [1.0, 0.5]), (2, 1, [0.9, 0.1]), (3, 2, [1.0, 0.5]), (4, 2, [1.0, 0.4]), (4, 2, [1.0, 0.4]), (5, 2, [0.9, 0.2]),
        (6, None, [1.0, 1.0]), (7, 1, None), (8, 2, [1.0, None]), (9, 2, [nan, 1.0]), (10, 1, [inf, 1.0]), (None, 2, [1.0, 0.5]), (20, 3, []), (21, 3, []), (22, 4, []),
        (30, 1, [1.0, 0.5, 0.0]), (31, 1, [1.0, 0.0, 0.0]), (32, 2, [1.0, 0.1, 0.0]), (40, 2, [0.0, 0.0]), (41, 5, [-1.0, -1.0]), (42, 2, [1e300, 1.0]), (50, 5, [-1.0, -2.0]),
        (0, 1, [0.25, 0.75]), (11, 3, [1.0, 0.45]), (12, 4, [1.0, 0.47]), (13, 4, [1.0, 0.47]),
    ]
    assert run(spark, rows, 10) == mined(rows, 10)
    assert any(a == 20 for a, *_ in run(spark, rows, 10))
    assert run(spark, [], 10) == [] and run(spark, [(1, 1, [1.0])], 10) == []


@pytest.mark.parametrize("block", [2048, 16])
def test_equals_a_loop_over_blocks_and_hot_labels(spark, monkeypatch, block):
    """A third of all rows is of one label, a tenth holds one vector; coarse parts make ties."""
    monkeypatch.setattr(hard_negatives, "LEAST_BLOCK", block)
    monkeypatch.setattr(hard_negatives, "BLOCK_ROOT", 1)
    monkeypatch.setattr(hard_negatives, "TILE_ANCHORS", 8)
    monkeypatch.setattr(hard_negatives, "TILE_ROWS", 20)
    rnd = random.Random(block)
    rows = [(i, 0 if i % 3 == 0 else rnd.randrange(6), [0.5] * 20 if i % 10 == 3 else [rnd.choice([-0.5, 0.0, 0.25, 0.5, 1.0]) for _ in range(20)]) for i in range(300)]
    assert run(spark, rows, 7, "float") == mined(rows, 7)


def test_long_vectors(spark):
    rnd = np.random.default_rng(4)
    rows = [(i, int(i % 3), rnd.normal(size=3000).tolist()) for i in range(24)]
    rows += [(100 + i, int(i % 2), [x + 0.01 * i for x in rows[0][2]]) for i in range(12)]
    assert run(spark, rows, 4) == mined(rows, 4)
