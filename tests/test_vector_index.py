import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarifa.operators import vector_index

ITEM = "id string, vector array<float>, brand string, sites array<string>"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    centres = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(12)]
    out = [(f"i{i:04d}", [x + rng.gauss(0, 0.3) for x in centres[i % 12]], rng.choice(["", "", "x", "y"]), [rng.choice("abc")] if i % 4 == 0 else []) for i in range(600)]
    out += [(f"h{i:04d}", [1.0] * 8, "", []) for i in range(150)]  # a hot list of equal vectors
    out += [("zero", [0.0] * 8, "", []), ("short", [1.0, 2.0], "", []), ("none", None, "", []), ("hole", [1.0, None], "", []), ("nan", [float("nan")] * 8, "", []), ("empty", [], "", []), (None, [1.0] * 8, "", [])]
    return out


def brute(rows, asked, k, floor=-2.0):
    def fit(v):
        return v is not None and len(v) == 8 and all(x is not None and math.isfinite(x) for x in v)

    items = [(i, np.array(v, np.float32).astype(float), b, s) for i, v, b, s in rows if i is not None and fit(v)]
    length = lambda v: max(np.linalg.norm(v), 1e-12)
    out = []
    for q, v, brand, site in asked:
        if not fit(v):
            continue
        v = np.array(v, np.float32).astype(float)
        scores = [(-round(float(v @ w / length(v) / length(w)), 9), i) for i, w, b, s in items if not (brand and b and brand != b) and site not in s]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(x for x in scores if -x[0] >= floor)[:k])]
    return sorted(out)


def answer(found):
    return sorted((r.query, r.rank, r.id, round(r.score, 9) + 0.0) for r in found.collect())


@pytest.fixture(scope="module")
def index(spark, rows):
    return vector_index.build(spark.createDataFrame(rows, ITEM), brand=F.col("brand"), sites=F.col("sites"))


@pytest.fixture(scope="module")
def asked(rows):
    rng = random.Random(5)
    out = [(f"q{n}", [x + rng.gauss(0, 0.2) for x in rows[n * 17][1]], rng.choice(["", "x", "z"]), rng.choice(["a", "b", None])) for n in range(30)]
    return [*out, ("q-hot", [1.0] * 8, "", None), ("q-zero", [0.0] * 8, "", None), ("q-short", [1.0], "", None), ("q-none", None, "", None)]


def of(spark, asked, **kw):
    frame = spark.createDataFrame(asked, "id string, vector array<float>, brand string, site string")
    return vector_index.asked_of(frame, brand=F.col("brand"), site=F.col("site"), **kw)


@pytest.mark.parametrize("parts", [None, 20])
def test_exact_search_equals_brute_force(spark, rows, asked, index, parts, monkeypatch):
    """Whole lists, or lists cut into small parts that meet blocks of few queries."""
    if parts:
        monkeypatch.setattr(vector_index, "PART_ROWS", parts)
        monkeypatch.setattr(vector_index, "ASKED_ROWS", 3)
        index = vector_index.build(spark.createDataFrame(rows, ITEM), brand=F.col("brand"), sites=F.col("sites"))
        assert index.lists.agg(F.max("parts")).first()[0] > 5
    assert answer(vector_index.search(index, of(spark, asked), 7, probes=2, exact=True)) == brute(rows, asked, 7)


def test_within_a_score(spark, rows, asked, index):
    got = answer(vector_index.within(index, of(spark, asked, floor=0.8), 3))
    assert got == brute(rows, asked, 3, 0.8) and len({q for q, *_ in got}) > 20


def test_lists_that_cannot_reach_the_score_are_not_visited(spark, asked, index):
    centres = index.centres()
    rows = of(spark, asked[:32], floor=0.95).withColumn("least", F.col("floor")).toArrow().to_batches()
    visits = sum(len(x) for b in vector_index._visits(rows, type("B", (), {"value": centres}), 0, False) for x in b.column("lists").to_pylist())
    assert 0 < visits < 0.5 * 32 * len(centres[0])


def test_probing_reaches_its_recall(spark, rows, index):
    probes = vector_index.probes_for(index, 0.95, 5)
    assert 1 <= probes < index.lists.count()
    queries = [(i, v, "", None) for i, v, _, _ in rows[:600:7]]
    exact = {(q, i) for q, _, i, _ in brute(rows, queries, 5)}
    got = {(q, i) for q, _, i, _ in answer(vector_index.search(index, of(spark, queries), 5, probes=probes))}
    assert len(got & exact) >= 0.9 * len(exact)


def test_written_and_read(spark, rows, asked, index, tmp_path):
    index.write(f"file://{tmp_path}/index")
    again = vector_index.VectorIndex.read(spark, f"file://{tmp_path}/index")
    assert answer(vector_index.search(again, of(spark, asked[:5]), 3, exact=True)) == brute(rows, asked[:5], 3)


def test_empty(spark, asked):
    none = vector_index.build(spark.createDataFrame([], ITEM))
    assert answer(vector_index.search(none, of(spark, asked), 3, exact=True)) == []
    assert vector_index.probes_for(none) == 1


def test_centres_cover_lost_members():
    sample = np.eye(4)[[0, 0, 0, 1, 2, 3]]
    centres = vector_index.learned(sample, 4)
    assert sorted((sample @ centres.T).max(axis=1).round(6).tolist()) == [1.0] * 6
