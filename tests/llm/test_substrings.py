import hashlib
import random

import numpy as np
import pytest

from tarifa.llm import substrings


def brute(rows):
    """rows: (doc key, text bytes) in order."""
    seen, out = set(), {}
    for key, text in rows:
        gone = np.zeros(len(text) + 1, bool)
        for s in range(len(text) - 99):
            w = text[s : s + 100]
            if w in seen:
                gone[s : s + 100] = True
            seen.add(w)
        gone = gone[: len(text)]
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out[key] = (len(text), int(gone.sum()), runs, hashlib.sha256(np.frombuffer(text, np.uint8)[~gone].tobytes()).hexdigest())
    return out


def result(df, **kw):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in substrings.removed(df, **kw).collect()}


def texts(seed):
    rng = random.Random(seed)
    part = lambda n: "".join(rng.choice("abcdefghij é\n") for _ in range(n))
    shared = [part(rng.randint(90, 400)) for _ in range(6)]
    out = []
    for _ in range(40):
        pieces = []
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(shared) if rng.random() < 0.6 else part(rng.randint(1, 200))
            a = rng.randint(0, len(p) // 3)
            pieces.append(p[a : len(p) - rng.randint(0, len(p) // 3)])
        out.append("".join(pieces))
    return [*out, "a" * 500, "ab" * 300, "a" * 130, None, "", "x" * 99, "y" * 100, "y" * 100]


@pytest.mark.parametrize("kw", [{}, {"hot": 1}])
def test_brute_force(spark, kw):
    rows = list(enumerate(texts(3)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert result(df, **kw) == brute([(i, (t or "").encode()) for i, t in rows])


def test_a_long_text_in_segments(spark, monkeypatch):
    rng = random.Random(1)
    long_ = "".join(rng.choice("abcd") for _ in range(6000))
    rows = [(0, long_), (1, long_[1000:3000] + "z" + long_[:700]), (2, long_)]
    want = brute([(i, t.encode()) for i, t in rows])
    monkeypatch.setattr(substrings, "SEGMENT", 1000)
    import pyarrow as pa

    found = []
    batch = pa.RecordBatch.from_pydict({"doc": [0, 1, 2], "mark": pa.array([0, 0, 0], pa.int32()), "text": pa.array([t.encode() for _, t in rows], pa.binary())})
    for b in substrings._find(iter([batch])):
        found += b.to_pylist()
    starts = [r["place"] >> 33 for r in found if r["spans"] is None and r["doc"] == 0]
    assert max(starts) > 5000
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(df) == want


def test_repeated_rows_and_null_ids(spark):
    t = "".join(random.Random(4).choices("abcdef", k=300))
    df = spark.createDataFrame([(1, t), (1, t), (None, t), (2, t[:150])], "doc_id long, text string")
    rows = sorted([(r.doc_id, r.n_removed) for r in substrings.removed(df).collect()], key=str)
    assert rows == sorted([(1, 0), (1, 0), (None, 300), (2, 150)], key=str)


def test_nasty_does_not_crash(nasty):
    rows = substrings.removed(nasty).collect()
    assert len(rows) == nasty.count()
    assert all(0 <= r.n_removed <= r.n_bytes for r in rows)


def test_kept_text(spark):
    t = "".join(random.Random(9).choices("abcdef", k=120))
    df = spark.createDataFrame([(1, t), (2, "head " + t + " tail")], "doc_id long, text string")
    assert {r.doc_id: bytes(r.kept) for r in substrings.removed(df, keep_text=True).collect()} == {1: t.encode(), 2: b"head  tail"}


def test_empty(nothing):
    assert substrings.removed(nothing).collect() == []


def test_intervals_give_the_common_prefixes():
    rng = random.Random(8)
    for _ in range(20):
        text = np.array([rng.randint(1, 2) for _ in range(rng.randint(5, 200))] + [0], np.int16)
        order = substrings.suffix_order(text)
        group = substrings.shared_prefixes(text, order, 6)
        strings = [tuple(text[i : i + 6]) for i in order]
        for k in range(1, len(order)):
            whole = len(strings[k]) == 6 and 0 not in strings[k] and len(strings[k - 1]) == 6 and 0 not in strings[k - 1]
            if whole:
                assert (group[k] == group[k - 1]) == (strings[k] == strings[k - 1])


def test_texts_of_one_id_are_told_apart(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(4)] + [(None, "a"), (None, "b"), (2, "c"), (2, "c"), (3, "d")], "doc_id long, text string")
    rows = [(r.doc, r.mark, bytes(r.text)) for r in substrings._numbered(docs, "doc_id", "text").collect()]
    assert len(rows) == 9 and len(set(rows)) == len({r[:2] for r in rows}) == 8
    assert {r[0] for r in rows if r[1] % 2} == {substrings.LAST}


def test_texts_without_an_id_go_on_in_further_ids(spark, monkeypatch):
    monkeypatch.setattr(substrings, "MARKS", 4)
    docs = spark.createDataFrame([(None, f"{i}") for i in range(11)], "doc_id long, text string")
    rows = [(r.doc, r.mark) for r in substrings._numbered(docs, "doc_id", "text").collect()]
    assert len(set(rows)) == 11 and {d for d, _ in rows} == {substrings.LAST - i for i in range(3)} and {m for _, m in rows} == {1, 3, 5, 7}
    with pytest.raises(ValueError, match="texts of the id 7"):
        substrings._numbered(docs.na.fill({"doc_id": 7}), "doc_id", "text")


@pytest.mark.parametrize("id_", [None, 5])
def test_many_rows_of_one_id(spark, id_):
    """100,000 different texts of one id, of which some repeat a passage: as many rows, removed as by hand."""
    rng = random.Random(1)
    passage = "".join(rng.choice("abcdefgh") for _ in range(150))
    rows = [(id_, f"text {i} " + (passage if i % 5000 == 0 else "short")) for i in range(100_000)]
    got = substrings.removed(spark.createDataFrame(rows, "doc_id long, text string"))
    found = [(r.doc_id, r.n_bytes, r.n_removed) for r in got.select("doc_id", "n_bytes", "n_removed").collect()]
    assert len(found) == 100_000 and {r[0] for r in found} == {id_}
    gone = [r for r in found if r[2]]
    assert len(gone) == 19 and all(r[2] >= 150 for r in gone)


def removed_by_hand(rows, length=100):
    """Bytes removed in each document of (doc, text), in order."""
    seen, out = set(), {}
    for doc, text in sorted(rows):
        gone, reach = 0, 0
        for j in range(len(text) - length + 1):
            window = text[j : j + length]
            if window in seen:
                gone, reach = gone + j + length - max(reach, j), j + length
            seen.add(window)
        out[doc] = gone
    return out


def test_the_tables_need_the_index(spark):
    """On the tables: the result is that of brute force, and interning alone, without the transform, misses a tenth of it."""
    import pyarrow as pa

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
    want = removed_by_hand(rows)
    assert {r.doc_id: r.n_removed for r in substrings.removed(docs).collect()} == want
    batch = pa.RecordBatch.from_pydict({"doc": pa.array([d for d, _ in rows], pa.int64()), "mark": pa.array([0] * len(rows), pa.int32()), "text": pa.array([t for _, t in rows], pa.binary())})
    found = pa.Table.from_batches(substrings._find(iter([batch]))).sort_by("key").combine_chunks()
    covered = {d: bytearray(len(t)) for d, t in rows}
    for out in substrings._own(iter(found.to_batches()), substrings.HOT):
        for doc, spans in zip(out.column("doc").to_pylist(), out.column("spans").to_pylist(), strict=True):
            for a, b in np.frombuffer(spans or b"", np.int32).reshape(-1, 2).tolist():
                covered[doc][a:b] = b"\1" * (b - a)
    assert 0.8 * sum(want.values()) < sum(map(sum, covered.values())) < 0.95 * sum(want.values())
