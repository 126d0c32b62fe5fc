import math
import random

import numpy as np
import pytest

from tarifa.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int, n long, anchor string, rank int, v int"


def row(i, v, label):
    return (i, v, label, 1, "a", 2, 3)


def brute(rows, every=100, positives=5, k=10, low=30, high=90):
    """The contract row by row, in Python's integers."""
    use = []
    for i, v, label, *_ in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        use.append((i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * x) for x in v]))
    out = []
    for place, (a, label, v) in enumerate(use):
        if a % every:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w, strict=False)), i, own, j) for j, (i, own, w) in enumerate(use) if j != place]
        near = sorted(s for s in scored if s[2] == label)[:positives]
        for p, pid, _, _ in near:
            far = sorted(s for s in scored if s[2] != label and -low * p <= -100 * s[0] <= -high * p)
            out += [(a, pid, r + 1, i, -p, -s) for r, (s, i, _, _) in enumerate(far[:k])]
    return sorted(out)


def result(df, **kw):
    return sorted(tuple(r) for r in negatives.hard_negatives(df, **kw).collect())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    vector = lambda d=6: [rng.uniform(-1, 1) for _ in range(d)]
    hot = [0.5, 0.25, -0.125, 0.5, 0.0, 0.75]
    out = [row(i, vector(), rng.randrange(10)) for i in range(0, 900)]
    out += [row(1000 + i, hot, i % 3) for i in range(150)]  # one vector many times: ties
    out += [row(300, vector(), 4), row(300, vector(), 4), row(7, out[7][1], 5)]  # repeated ids
    out += [row(2000, vector(3), 1), row(2100, [], 1), row(2200, vector(9), 2), row(2300, [0.0] * 6, 2)]  # other widths, none, zeros
    out += [row(2400, None, 1), row(2500, vector(), None), row(2600, [0.1, None], 1), row(2700, [float("nan")], 1), row(2800, [float("inf")], 1), row(None, vector(), 1), row(-100, vector(), 3)]
    return out


@pytest.mark.parametrize("wave_bytes", [negatives.WAVE_BYTES, 200])
def test_equals_brute_force(spark, rows, wave_bytes):
    """One wave, or several with other partitions: the same rows."""
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert result(df, wave_bytes=wave_bytes) == brute(rows)


def test_general_parameters(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    assert result(df, every=50, positives=2, k=3, low=-20, high=60) == brute(rows, 50, 2, 3, -20, 60)


def test_empty_and_lonely(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    assert result(df.limit(0)) == []
    assert result(df.where("vec_id = 100")) == []
    assert result(df.where("vec_id % 100 != 0")) == []


def test_sums_beyond_doubles_stay_exact(spark):
    rows = [row(i, [4e6 + i % 5, 3e6 - i, 1.0 * (i % 3)], i % 2) for i in range(45)] + [row(100, [4e6, 1.0, 2.0], 0)]
    rows += [row(50 + i, [(0.3 + i / 50) * 4e6, 1.0 * i, 5.0], 1) for i in range(30)]
    assert max(x[4] for x in brute(rows)) > 1 << 53
    assert result(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_best_keeps_the_first_of_equals():
    best = negatives.Best(2, 3)
    ids = np.arange(40)
    best.take(np.array([0, 1]), np.stack([np.full(40, 5.0), np.where(ids % 2, 7.0, -np.inf)]), ids, ids)
    best.take(np.array([0, 1]), np.stack([np.where(ids == 3, 6.0, 5.0), np.full(40, 7.0)]), ids + 100, ids)
    assert best.id.tolist() == [[103, 0, 1], [1, 3, 5]]
    assert best.score.tolist() == [[6, 5, 5], [7, 7, 7]]


def test_candidates_are_not_shuffled(spark, rows):
    """Only tasks' best rows move: no exchange has vectors."""
    df = spark.createDataFrame(rows, SCHEMA)
    plan = negatives.hard_negatives(df)._jdf.queryExecution().executedPlan().toString()
    assert "embedding" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
