import hashlib
import re
from collections import defaultdict

from tarifa.llm import exact_dedup

SPACE = re.compile(r"[\x20\x09-\x0d]")


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[SPACE.sub("", r["text"] or "")].append(r)
    out = []
    for norm, members in groups.items():
        best = min(members, key=lambda r: (-len(r["text"] or ""), r["doc_id"] is None, r["doc_id"] or 0))
        out += [(r["doc_id"], best["doc_id"], len(members), hashlib.sha256(norm.encode()).hexdigest()) for r in members]
    return sorted(out, key=str)


def check(docs, **kw):
    rows = exact_dedup.decisions(docs, **kw).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows], key=str) == brute(docs.collect())
    kept = [r.text_sha256 for r in rows if r.kept]
    assert len(kept) == len(set(kept)) == len({r.text_sha256 for r in rows})
    assert all(r.doc_id == r.keep_id for r in rows if r.kept)


def test_brute_force(nasty):
    check(nasty)


def test_small_buckets_split(nasty):
    check(nasty, least=300)  # the texts of 60 copies are over an eighth of a bucket: merged by salts first


def test_kept_rows_have_all_columns(nasty):
    rows = exact_dedup.kept_rows(nasty)
    assert rows.columns == nasty.columns
    assert rows.count() == len({SPACE.sub("", r["text"] or "") for r in nasty.collect()})
    assert rows.where("row = 'r' and key = 1").count() == rows.count()


def test_copies_spread_over_many_batches(spark):
    """A third of all rows alike, and long texts, with buckets so small that both are hot hashes."""
    rows = [(i, "the same text again " * 9 if i % 3 == 0 else f"text {i} " * (1 + i % 40)) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(30)
    check(docs, least=1000)
    kept = sorted(r.text for r in exact_dedup.kept_rows(docs, least=1000).collect())
    assert kept == sorted({t for _, t in rows})


def test_empty(nothing):
    assert exact_dedup.decisions(nothing).collect() == []
    assert exact_dedup.kept_rows(nothing).collect() == []


def test_colliding_hashes_are_told_apart(nasty, monkeypatch):
    """With one hash for all, the chains of bytes still decide."""
    import pyarrow as pa

    owners = exact_dedup._owners(pa.schema([("head", pa.int64()), ("keep_rid", pa.int64()), ("keep_id", pa.int64()), ("group_size", pa.int64())]))
    batch = pa.RecordBatch.from_pydict({"head": [1, 2, 3], "hash": [9, 9, 9], "text": [b"a", b"b", b"a"], "n": [1, 1, 2], "id": [4, 5, 6], "points": [1, 1, 1]})
    rows = [r for b in owners(iter([batch])) for r in b.to_pylist()]
    assert sorted((r["head"], r["keep_id"], r["group_size"]) for r in rows) == [(1, 4, 3), (2, 5, 1), (3, 4, 3)]


def test_directory_doubles_until_buckets_fit(spark):
    top = lambda x: (x << 56) - (1 << 64) if x >> 7 else x << 56  # noqa: E731  by the first eight bits
    rows = [(top(0b00010000), 10), (top(0b00011000), 10), (top(0b10000000), 1), (top(0b11110000), 1)]
    slots, _ = exact_dedup.directory(spark.createDataFrame(rows, "hash long, bytes long"), 22, 12, 3)
    found = {r.slot: r.owner for r in slots.collect()}
    assert {0b00010, 0b00011} <= set(found) and all(found[s] >= 1 for s in found if s >= 16)  # five bits tell the first two apart
    assert [found[s] for s in sorted(found)] == sorted(found.values())
    one, _ = exact_dedup.directory(spark.createDataFrame([(5, 99)], "hash long, bytes long"), 99, 200, 4)
    assert [tuple(r) for r in one.collect()] == [(0, 0)]
