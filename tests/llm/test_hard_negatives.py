"""Hard negatives against brute force, and the packed products against plain ones."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.llm.hard_negatives import LEAST_SLICE, Packed, limit_bits, mine_hard_negatives


def brute(rows, step, positives=5, negatives=3, low=50, high=95):
    whole = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        own = (label, [math.floor(256 * x) for x in v])
        whole[i] = min(whole.get(i, own), own)
    out = set()
    for a, (label, v) in whole.items():
        if a % step:
            continue
        scored = [(sum(x * y for x, y in zip(v, w)), i, m == label) for i, (m, w) in whole.items() if i != a]
        scored.sort(key=lambda s: (-s[0], s[1]))
        for p, pid, _ in [s for s in scored if s[2]][:positives]:
            inside = [s for s in scored if not s[2] and low * p <= 100 * s[0] <= high * p]
            out |= {(a, pid, k + 1, i, p, s) for k, (s, i, _) in enumerate(inside[:negatives])}
    return out


def mined(spark, rows, step, **more):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = mine_hard_negatives(df, F.col("id") % step == 0, **more).collect()
    assert len(set(got)) == len(got)
    return {tuple(r) for r in got}


@pytest.mark.parametrize("reach, bias, size", [(7, 3, 5), (150, 150, 64), (1 << 20, 1 << 20, 33), ((1 << 27) - 1, (1 << 27) - 1, 64), (0, 5, 4), (5, 0, 4), (1 << 30, 1 << 30, 1)])
def test_packed_products_are_exact(reach, bias, size):
    rng = np.random.RandomState(1)
    anchors = rng.randint(-reach, reach + 1, (9, size)).astype(np.int64)
    rows = rng.randint(-bias, bias + 1, (31, size)).astype(np.int64)
    packed = Packed(rows, int(np.abs(anchors).max(initial=0)))
    assert np.array_equal(packed.scores(anchors), anchors @ rows.T)
    assert max(reach, bias) <= 1 << limit_bits(size)


def test_several_candidates_share_a_product():
    assert Packed(np.full((10, 64), 148, np.int64), 148).fields == 2
    assert Packed(np.full((10, 8), 3, np.int64), 3).fields == 5


def test_equals_brute_force(spark):
    rng = random.Random(3)
    # Few values: many ties.
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, 0.5]) for _ in range(6)], rng.choice([0, 0, 0, 1, 2])) for i in range(400)]
    expected = brute(rows, 20)
    assert len(expected) > 100
    assert mined(spark, rows, 20) == expected


def test_many_slices_and_other_bounds(spark):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 1) for _ in range(4)], i % 3) for i in range(LEAST_SLICE * 3)]
    got = mined(spark, rows, 400, positives=2, negatives=4, low=20, high=90)
    assert got == brute(rows, 400, 2, 4, 20, 90) and got


def test_odd_rows(spark):
    ok = [0.5, 0.25]
    rows = [
        (0, ok, 1), (1, ok, 1), (1, ok, 1), (2, [0.25, 0.25], 2), (3, None, 1), (4, ok, None), (None, ok, 1), (5, [None, 1.0], 1), (6, [math.nan, 1.0], 2),
        (7, [math.inf, 1.0], 2), (8, [], 1), (9, [0.4], 2), (10, [1e300, -1e300], 2), (11, [-1e300, 1.0, 5.0], 1), (50, [-1.0, -1.0], 2), (12, [0.25, 0.5], 2), (12, [0.2, 0.1], 2),
    ]
    held = [(i, v if v is None else [x if x is None or not math.isfinite(x) else max(-(2.0 ** 21), min(2.0 ** 21 , x)) for x in v], m) for i, v, m in rows]
    got = mined(spark, rows, 50)
    assert limit_bits(3) == 29 and got == brute(held, 50) and got


def test_clashing_columns_and_empty_tables(spark):
    rows = [(i, [0.1 * (i % 7), 0.3], i % 2, i, "x") for i in range(60)]
    df = spark.createDataFrame(rows, "id long, v array<float>, label int, g int, place string")
    plain = mine_hard_negatives(df, F.col("id") % 5 == 0, "id", "v").collect()
    assert plain and {tuple(r) for r in plain} == brute([(i, [float(np.float32(x)) for x in v], m) for i, v, m, _, _ in rows], 5)
    assert mine_hard_negatives(df.limit(0), F.col("id") % 5 == 0, "id", "v").collect() == []
    assert mine_hard_negatives(df, F.lit(False), "id", "v").collect() == []


def test_string_ids(spark):
    rows = [(f"r{i}", [float(i % 5), 1.0], "a" if i % 2 else "b") for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id string, embedding array<double>, label string")
    got = mine_hard_negatives(df, F.col("id") == "r4").collect()
    assert got and {r["anchor_id"] for r in got} == {"r4"}
