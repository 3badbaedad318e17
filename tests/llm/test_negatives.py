import math
import random

import pytest
from pyspark.sql import functions as F

from starloom.llm import hard_negatives as M


def mined(rows, positives=5, negatives=5, low=80, high=100, every=100):
    """The definition, pair by pair."""
    kept = []
    for key, label, vector in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept.append((key, label, [math.floor(256 * x) for x in vector]))
    out = []
    order = lambda e: (-e[0], e[1] is None, e[1] or 0)
    for i, (key, label, vector) in enumerate(kept):
        if key is None or key % every:
            continue
        scored = [(sum(a * b for a, b in zip(vector, v)), k, name) for j, (k, name, v) in enumerate(kept) if j != i]
        same = sorted((e for e in scored if e[2] == label), key=order)[:positives]
        other = sorted((e for e in scored if e[2] != label), key=order)
        for score, positive, _ in same:
            fits = [e for e in other if low * score <= 100 * e[0] <= high * score]
            for rank, (s, negative, _) in enumerate(fits[:negatives], 1):
                out.append((key, positive, rank, negative, score, s))
    return sorted(out, key=repr)


SCHEMA = "vec_id long, label int, embedding array<double>"


def found(spark, rows, every=100, parts=3, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    got = M.mine_hard_negatives(df, F.col("vec_id") % every == 0, **options).collect()
    return sorted(map(tuple, got), key=repr)


def random_rows(seed, n, dim=4, step=8):
    rng = random.Random(seed)
    return [
        (k, rng.randrange(3), [rng.randrange(-step, step + 1) / step + 0.2 for _ in range(dim)]) for k in range(n)
    ]


@pytest.mark.parametrize(("seed", "n", "dim", "step"), [(1, 300, 6, 8), (2, 400, 2, 2), (3, 60, 3, 1)])
def test_equals_the_definition(spark, seed, n, dim, step, monkeypatch):
    monkeypatch.setattr(M, "GROUP_BYTES", 700)
    monkeypatch.setattr(M, "BLOCK_ANCHORS", 3)
    monkeypatch.setattr(M, "BLOCK_ROWS", 40)
    rows = random_rows(seed, n, dim, step)
    want = mined(rows, every=10)
    assert found(spark, rows, 10) == want and len(want) > 50


def test_other_numbers_and_windows(spark):
    rows = random_rows(4, 200)
    assert found(spark, rows, 5, positives=3, negatives=2, window=(50, 90)) == mined(rows, 3, 2, 50, 90, 5)
    with pytest.raises(ValueError, match="window"):
        found(spark, rows, 5, window=(50, 120))


def test_odd_rows(spark):
    """Nulls, repeats, equal vectors, short and empty vectors, components that are not finite."""
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, 1, [1.0, 2.0]), (0, 1, [1.0, 2.0]), (0, 1, [2.0, 1.0]), (0, 2, [1.0, 2.0]), (None, 1, [1.0, 2.0]),
        (None, 2, [1.0, 2.0]), (1, None, [1.0, 2.0]), (2, 2, None), (3, 2, [1.0, None]), (4, 2, [nan, 1.0]),
        (5, 2, [1.0, inf]), (6, 2, []), (7, 2, [1.0]), (8, 2, [1.0, 1.9, 3.0]), (100, 2, []), (200, 9, [1.0, 2.0]),
        (300, 1, [-1.0, -2.0]),
    ]
    rows += [(k, k % 2, [0.5, 0.5]) for k in range(1000, 1200)]
    want = mined(rows)
    assert found(spark, rows) == want and any(r[1] is None for r in want) and any(r[3] is None for r in want)
    assert found(spark, rows[:1]) == [] and found(spark, []) == []


def test_scores_beyond_doubles(spark):
    """Inner products above 2**53 are exact, and those above 64 bits do no harm."""
    rng = random.Random(6)
    rows = [(k, k % 2, [float(rng.randrange(2**20, 2**21)), rng.random()]) for k in range(0, 60)]
    want = mined(rows, every=10)
    assert found(spark, rows, 10) == want and max(r[4] for r in want) > 2**55
    assert found(spark, [(k, k % 2, [1e300, 1.0]) for k in range(6)], 1)


def test_columns_with_the_names_of_the_operator(spark):
    rows = random_rows(9, 120)
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA + ", key int, anchor string, slot int")
    got = M.mine_hard_negatives(df, F.col("vec_id") % 10 == 0).collect()
    assert sorted(map(tuple, got), key=repr) == mined(rows, every=10)
