import math

import numpy as np
import pytest

from tarifa.llm import topk


def brute(rows, k=20, every=20):
    use = [(i, tuple(math.floor(64 * x) for x in v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (i, q) in enumerate(use):
        if i % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v, strict=False)), j) for m, (j, v) in enumerate(use) if m != n)[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored)]
    return sorted(out)


def result(df, **kw):
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in topk.top_k(df, **kw).collect())


@pytest.mark.parametrize("kw", [{}, {"shard_rows": 50, "block_rows": 4}])
def test_brute_force(spark, kw):
    rng = np.random.default_rng(0)
    rows = [(i, (rng.normal(size=16) / 4).tolist()) for i in range(230)]
    rows += [(1000 + i, rows[3][1]) for i in range(40)]  # ties
    rows += [(2000, None), (2020, [1.0, None]), (2040, [float("nan")] * 16), (2060, [float("inf")] * 16), (None, rows[0][1]), rows[5], (2080, [0.0] * 16), (2100, [0.5, 0.5])]
    rows += [(20, rows[7][1]), rows[40], rows[40]]  # an id with two vectors, and a query row three times
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], "vec_id long, embedding array<double>, score int, key int, rank string")
    assert result(df, **kw) == brute(rows)


def test_large_values_stay_exact(spark):
    rows = [(i, [float(10**6 + i), -3.5, float(i)]) for i in range(41)] + [(60, [1e8, 2.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert result(df) == brute(rows)


def test_fewer_than_k_and_empty(spark):
    rows = [(0, [0.1, 0.2]), (1, [0.3, 0.1]), (2, [0.0, -0.1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert [r[1] for r in result(df)] == [1, 2]
    assert result(df.limit(0)) == []
    assert result(df.where("vec_id = 0")) == []


def test_stops_on_proof_and_rescores():
    """Rows far apart: members are settled before the last segment."""
    rng = np.random.default_rng(1)
    big = rng.integers(-60, 60, (30, 8))
    big[:, 0] = 0
    vectors = np.concatenate([big * 50, rng.integers(-1, 2, (400, 8))])
    ids = np.arange(len(vectors))
    shard = topk.Shard(ids, ids, vectors)
    got = [(i, r.tolist(), s.tolist()) for i, r, s in shard.search(ids[:3], vectors[:3].astype(np.int64), 3)]
    for i, rows, scores in got:
        exact = vectors @ vectors[i]
        order = sorted((-exact[j], j) for j in range(len(vectors)) if j != i)[:3]
        assert (rows, scores) == ([j for _, j in order], [-s for s, _ in order])


def test_queries_stop_one_by_one():
    """A query with a clear answer stops on its proof, while its neighbour in the block goes on; both are exact."""
    rng = np.random.default_rng(2)
    vectors = np.concatenate([[[200 + i, 1, 0, 0] for i in range(10)], [[0, 0, int(x), int(y)] for x, y in rng.integers(1, 60, (300, 2))]])
    ids = np.arange(len(vectors))
    shard, stops = topk.Shard(ids, ids, vectors), []
    for i, rows, scores in shard.search(np.array([0, 10]), vectors[[0, 10]], 3, few=8):
        stops.append(i)
        q = [0, 10][i]
        exact = vectors @ vectors[q]
        want = sorted((-exact[j], j) for j in range(len(vectors)) if j != q)[:3]
        assert (rows.tolist(), scores.tolist()) == ([j for _, j in want], [-s for s, _ in want])
    assert stops == [0, 1]


def test_segments_hold_postings_only():
    vectors = np.array([[40, 0, 1], [0, 0, 1], [0, 3, 0]])
    shard = topk.Shard(np.arange(3), np.arange(3), vectors)
    assert [(r.tolist(), d.tolist(), p.T.tolist()) for r, d, p in shard.segments] == [([0], [0], [[40]]), ([2], [1], [[3]]), ([0, 1], [2], [[1], [1]])]


def test_a_proof_leaves_out_the_own_row():
    vectors = np.array([[100 + i, 1] for i in range(5)] + [[5 + i % 7, i % 3] for i in range(40)])
    ids = np.array([0] * 5 + list(range(1, 41)))
    numbers = np.arange(45)
    got = list(topk.Shard(ids, numbers, vectors).search(numbers[:1], vectors[:1].astype(np.int64), 3))
    exact = vectors @ vectors[0]
    order = sorted((-exact[j], j) for j in range(1, 45))[:3]
    assert [(r.tolist(), s.tolist()) for _, r, s in got] == [([j for _, j in order], [-s for s, _ in order])]
