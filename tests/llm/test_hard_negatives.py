import math
import random

import numpy as np
import pytest

from marginflow.llm import hard_negatives
from marginflow.llm.hard_negatives import MOST_SCORE, mine, scores, slots_of

SCHEMA = "vec_id long, label int, embedding array<float>"


def plain(rows, every=50, positives=5, negatives=3, low=50, high=95):
    """All pairs by whole lists."""
    rows = [(i, l, [math.floor(256 * float(np.float32(x))) for x in v]) for i, l, v in rows
            if l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    order = lambda x: (-x[0], x[1] is None, x[1] or 0)
    out = []
    for a, la, va in {(i, l, tuple(v)) for i, l, v in rows if i is not None and i % every == 0}:
        met = [(sum(x * y for x, y in zip(va, v)), i, l) for i, l, v in rows if len(v) == len(va)]
        for p, pid, _ in sorted((m for m in met if m[2] == la and m[1] != a), key=order)[:positives]:
            fit = sorted((m for m in met if m[2] != la and low * p <= 100 * m[0] <= high * p), key=order)[:negatives]
            out += [(a, pid, k, i, p, s) for k, (s, i, _) in enumerate(fit, 1)]
    return sorted(out, key=str)


def mined(df, **more):
    return sorted((tuple(r) for r in mine(df, "vec_id % 50 = 0", **more).collect()), key=str)


def some(n, dims, seed, spread=1.0):
    r = random.Random(seed)
    return [(i, 1 if r.random() < 0.4 else r.randrange(5), [r.gauss(0.3, spread) / math.sqrt(dims) for _ in range(dims)]) for i in range(n)]


@pytest.mark.parametrize("dims, bytes_", [(16, 32 << 20), (16, 600), (3, 4000)])
def test_equals_all_pairs(spark, dims, bytes_):
    rows = some(700, dims, dims)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = mined(df, anchor_bytes=bytes_)
    assert got == plain(rows) and len(got) > 50


def test_ties_and_one_common_vector(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "FIRST_TILE", 2)
    r = random.Random(1)
    rows = [(i, r.randrange(3), [1.0, 0.5] if i % 3 else [r.choice([0.25, 0.5, 1.0]), 0.5]) for i in range(600)]
    got = mined(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert got == plain(rows) and len(got) > 50


def test_odd_rows(spark):
    rows = some(160, 4, 3) + [
        (200, None, [1.0] * 4), (201, 1, None), (202, 1, [1.0, None, 1.0, 1.0]), (203, 1, [float("nan")] * 4),
        (250, 1, [float("inf")] * 4), (None, 1, [0.5] * 4), (None, 2, [0.5] * 4), (300, 2, []), (301, 2, []), (302, 3, []),
        (350, 1, [1.0, 1.0]), (351, 1, [1.0, 1.0]), (352, 2, [0.5, 0.5]), (50, 1, [0.9] * 4), (50, 1, [0.9] * 4),
        (7, 3, [0.4] * 4), (7, 3, [0.4] * 4), (400, 0, [-1.0] * 4)]
    got = mined(spark.createDataFrame(rows, SCHEMA))
    assert got == plain(rows)
    assert (350, 351, 1, 352, 2 * 256 * 256, 256 * 256) in got
    assert mine(spark.createDataFrame([], SCHEMA), "vec_id % 50 = 0").count() == 0
    assert mine(spark.createDataFrame([(1, 1, [1.0])], SCHEMA), "vec_id % 50 = 0").count() == 0
    more = spark.createDataFrame([(*x, 0, "k") for x in rows], SCHEMA + ", anchor int, score string")
    assert mined(more) == got


def test_exact_scores():
    r = np.random.default_rng(0)
    for most in (100, 1 << 20, 1 << 30, 1 << 40):
        a, b = (r.integers(-most, most, (5, 8)).astype(float) for _ in range(2))
        exact = [[max(-MOST_SCORE, min(MOST_SCORE, sum(int(x) * int(y) for x, y in zip(p, q)))) for q in b] for p in a]
        assert scores(a, b).tolist() == exact
    assert scores(np.zeros((2, 0)), np.zeros((3, 0))).tolist() == [[0] * 3] * 2


def test_slots_cover_the_windows():
    anchor, score = np.array([0, 0, 0, 2, 2]), np.array([1000, 700, 700, 10, -5])
    lower, upper = slots_of(3, anchor, score, 50, 95)
    assert upper[0].tolist() == [950, 665, 665] and lower[0].tolist() == [665, 665, 349]
    assert (lower[1] >= upper[1]).all()
    assert upper[2, 0] == 9 and lower[2, 0] == 4


def test_large_components(spark):
    rows = [(50 * i, i % 3, [1e5 * (i % 7), 3e5, -1e4]) for i in range(60)]
    assert mined(spark.createDataFrame(rows, SCHEMA)) == plain(rows)
