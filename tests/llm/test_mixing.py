import re
from collections import defaultdict

import pytest

from tarifa.llm import mixing


def shares(sizes):
    """Targets by resharing until none is above three times its size."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, full = float(sum(sizes.values())), set()
    while True:
        left = total - sum(3.0 * sizes[s] for s in full)
        open_ = [s for s in order if s not in full]
        w = sum(weight[s] for s in open_)
        share = {s: left * weight[s] / w for s in open_}
        over = {s for s in open_ if share[s] > 3.0 * sizes[s]}
        if not over:
            return share | {s: 3.0 * sizes[s] for s in full}
        full |= over


def check(docs, near=0.03):
    rows = docs.collect()
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0d]+", t or ""))
    sizes = defaultdict(int)
    for r in rows:
        sizes[r["source"]] += count(r["text"])
    want = shares(dict(sizes))
    got = mixing.taken(docs).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size) for r in got) == sorted((r["doc_id"] is None, r["doc_id"] or 0, count(r["text"])) for r in rows)
    assert all(0 <= r.taken <= 3 * r.size for r in got)
    assert all(r.taken % r.size == 0 for r in got if r.size)
    by = defaultdict(int)
    for r in got:
        by[round(r.target, 6), r.source_size] += r.taken
    goal = defaultdict(float)
    for s, t in want.items():
        goal[round(t, 6), sizes[s]] += t
    assert set(by) == set(goal)
    for k, v in goal.items():
        biggest = max((r.size for r in got if (round(r.target, 6), r.source_size) == k), default=0)
        assert abs(by[k] - v) <= max(near * v, biggest)
    return got


def test_nasty(nasty):
    check(nasty)


def test_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    check(docs)


def test_many_small_documents_come_near(spark):
    rows = [(i, "w " * (1 + i * 7919 % 50), ["a", "b", "c", None][i % 7 % 4]) for i in range(6000)]
    got = check(spark.createDataFrame(rows, "doc_id long, text string, source string"), near=0.005)
    again = mixing.taken(spark.createDataFrame(rows[::-1], "doc_id long, text string, source string").repartition(9)).collect()
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in again)


def test_targets_stop_at_three_times_the_size(spark):
    sources = spark.createDataFrame([("a", 1), ("b", 1000), ("c", 5), ("d", 0), (None, 3)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(sources).collect()}
    want = shares({"a": 1, "b": 1000, "c": 5, "d": 0, None: 3})
    assert got == pytest.approx(want)


def test_mix_repeats_rows(nasty):
    mix = mixing.mixed(nasty)
    assert mix.columns == nasty.columns
    words = sum(len(re.findall(r"[^\x20\x09-\x0d]+", r["text"] or "")) for r in mix.collect())
    assert words == sum(r.taken for r in mixing.taken(nasty).collect())


def test_empty(nothing):
    assert mixing.taken(nothing).collect() == [] and mixing.mixed(nothing).collect() == []


def test_rows_alike_differ_by_one_copy(spark):
    rows = [(1, "a b c", "s")] * 50 + [(i, "d e", "t") for i in range(2, 400)]
    got = [r.taken for r in mixing.taken(spark.createDataFrame(rows, "doc_id long, text string, source string")).where("doc_id = 1").collect()]
    assert len(got) == 50 and max(got) - min(got) <= 3


def test_each_document_keeps_its_expected_copies(spark):
    """The same documents of all sizes, largest ones included, in 600 sources: draws with other random numbers."""
    sizes = [900, 400, 250, 100, 60, 40, 20, 10, 5, 3, 2, 1] + [7] * 80
    rows = [(1000 * k + i, "w " * n, f"s{k:03}") for k in range(600) for i, n in enumerate(sizes)]
    got = mixing.copies(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert len(got) == len(rows)
    per, total = defaultdict(list), defaultdict(int)
    for r in got:
        per[round(r.target / r.source_size, 6), r.id % 1000].append(r.copies)
        total[r.source, r.target] += r.copies * r["size"]
    assert len({rate for rate, _ in per}) == 3
    for (rate, _), found in per.items():
        spread = (rate % 1) * (1 - rate % 1)
        assert abs(sum(found) / len(found) - rate) < 4.5 * (spread / len(found)) ** 0.5 + 1e-6
    off = {rate: [abs(words - target) for (_, target), words in total.items() if target == rate * 2351] for rate in (0.5, 1.0, 1.5)}
    assert max(off[1.0]) == 0 and max(off[1.5]) <= 10  # the largest document has 900 words
    assert max(off[0.5]) <= 450 and sum(off[0.5]) / 200 < 40  # taken, the largest ones can leave nothing for the others


def test_ranges_give_the_same_targets(spark):
    rows = [(f"{i * 7919 % 1000:03}", i * i % 9973) for i in range(500)] + [(None, 12)]
    df = spark.createDataFrame(rows, "source string, source_size long")
    assert {r.source: r.target for r in mixing.targets(df.repartition(7)).collect()} == pytest.approx(shares(dict(rows)))


def test_plan_is_native(spark, sf_dir):
    import contextlib
    import io

    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        mixing.taken(spark.read.parquet(f"{sf_dir}/documents.parquet")).explain()
    assert not re.search("Python|Pandas|Arrow", out.getvalue())
