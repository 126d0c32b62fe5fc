"""Removal of repeated passages of words across documents.

A word goes if a window of ``WINDOW`` words that covers it also starts in a document with a smaller id.

1. *Super-k-mers.* A window's minimiser is the smallest hash of its ``GRAM``-word
   sequences; it depends on the window's words only. Consecutive windows of a document that share theirs are one
   super-k-mer (cut at ``LONGEST`` windows, of which each is judged by itself). A document is written once,
   with the minimisers, starts and numbers of windows of its super-k-mers.
2. *Buckets in use.* A minimiser that occurs in one document only has no window to compare: the
   smallest and the largest id of each are an aggregate of narrow rows, and all others need not travel.
3. *Strings.* The remaining super-k-mers travel to the bucket of their minimiser as one string, their words
   joined by a space. Those that are equal, byte by byte, meet in the task that cuts them: only those of the smallest id go on,
   as one row with all their places, and the others are removed at once.
4. *Sorting.* In its bucket a string is unpacked to numbers of words, windows are ranked by doubling
   (1, 2, 4 ... 32, then 50 words) and sorted by rank and id: of equal windows all go whose id is
   above the smallest. Whole buckets are taken in blocks of about ``BLOCK`` words.
5. *Hot buckets.* Buckets are counted first. One of more than ``hot`` strings is dealt
   out again, each window as a string of its own in a bucket by the hash of all its words; equal ones
   meet in the dealing task, as above.

Hashes only choose buckets; words decide.

Defined cases: a null text has no words; a null id is larger than every other, and null ids are no smaller than one
another; rows that repeat an id are documents of their own, of which neither is smaller, so they
remove nothing from one another; a document repeats nothing of itself; documents of fewer than ``WINDOW`` words
lose nothing; an empty table gives an empty table; further columns never matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarifa.llm.common import as_bytes, by_bytes, numbered, partitions
from tarifa.session import written

WINDOW = 50
GRAM = 8
LONGEST = 256
HOT = 2_000
BLOCK = 1 << 20
HELD = 32 << 20
LAST = (1 << 63) - 1
BASE = np.uint64(0x9E3779B97F4A7C15)
CUT = "n bigint, doc bigint, text binary, keys array<bigint>, starts array<int>, windows array<int>"
ROW = "key bigint, doc bigint, places binary, words binary, n bigint, a int, b int"
SPAN = "n bigint, a int, b int"


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and where each begins, and the last ends."""
    return np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)]).astype(np.int64)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends) of all words `[^\\x20\\x09-\\x0D]+`, none across texts, and the number of the first word of each text (and of all)."""
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    before, after = np.ones(len(data), bool), np.ones(len(data), bool)
    before[1:] = ~inside[:-1]
    after[:-1] = ~inside[1:]
    starts = np.flatnonzero(inside & (before | cut[:-1]))
    ends = np.flatnonzero(inside & (after | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def distinct(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """A number for each word, and the words by number."""
    codes, found = numbered(data[~((data == 32) | ((data >= 9) & (data <= 13)))], ends - starts)
    return codes, found.to_pylist()


def minimisers(hashes: np.ndarray, gram: int = GRAM, window: int = WINDOW) -> np.ndarray:
    """The smallest hash of a gram (a power of two) in the window at each word."""
    size, power, low = 1, BASE, hashes
    with np.errstate(over="ignore"):
        while size < gram:
            low = low[:-size] * power + low[size:]
            power, size = power * power, size * 2
        low = (low ^ (low >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    low ^= low >> np.uint64(29)
    size, most = 1, window - gram + 1
    while size * 2 <= most:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    return np.minimum(low[: len(low) - (most - size)], low[most - size :]) if size < most else low


def super_kmers(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """(text, start, windows, minimiser) of each run of windows with one minimiser, starts in words of the text."""
    data, offsets = joined(texts)
    starts, ends, first = words(data, offsets)
    none = np.zeros(0, np.int64)
    if len(starts) < WINDOW:
        return none, none, none, none
    codes, different = distinct(data, starts, ends)
    low = minimisers(np.fromiter((xxhash.xxh64_intdigest(w) for w in different), np.uint64, len(different))[codes])
    fits = np.flatnonzero(np.diff(first) >= WINDOW)
    change = np.zeros(len(low) + 1, np.int64)
    change[first[fits]] += 1
    np.subtract.at(change, first[fits + 1] - WINDOW + 1, 1)
    valid = np.cumsum(change[:-1]).astype(bool)
    fresh = valid.copy()
    fresh[1:] &= (low[1:] != low[:-1]) | ~valid[:-1]
    at = np.flatnonzero(fresh)
    stop = valid.copy()
    stop[:-1] &= (low[1:] != low[:-1]) | ~valid[1:]
    sizes = np.flatnonzero(stop) - at + 1
    pieces = -(-sizes // LONGEST)
    part = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    at = np.repeat(at, pieces) + part * LONGEST
    sizes = np.minimum(np.repeat(sizes, pieces) - part * LONGEST, LONGEST)
    text = np.searchsorted(first, at, side="right") - 1
    return text, at - first[text], sizes, low[at].view(np.int64)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with a number of their own (odd: without an id) and their super-k-mers."""
    number = TaskContext.get().partitionId() << 32
    for batch in by_bytes(batches, "text"):
        texts, rows = as_bytes(batch.column("text")), batch.num_rows
        doc = batch.column("doc").to_numpy(zero_copy_only=False)
        n = ((number + np.arange(rows)) << 1) + batch.column("lost").to_numpy(zero_copy_only=False)
        number += rows
        text, start, windows, key = super_kmers(texts)
        cuts = pa.array(np.searchsorted(text, np.arange(rows + 1)), pa.int32())
        lists = [pa.ListArray.from_arrays(cuts, pa.array(x, t)) for x, t in ((key, pa.int64()), (start, pa.int32()), (windows, pa.int32()))]
        yield pa.RecordBatch.from_arrays([pa.array(n, pa.int64()), pa.array(doc, pa.int64()), pa.array(texts, pa.binary()), *lists], names=["n", "doc", "text", "keys", "starts", "windows"])


class _Held:
    """Equal strings meet: those of the smallest id wait to travel, the others' words are removed."""

    def __init__(self):
        self.rows: dict[bytes, list] = {}
        self.size = 0
        self.spans: list[tuple] = []

    def add(self, key: int, doc: int, places: list[tuple], string: bytes, length: int) -> None:
        """``length``: words of the string; places: (document's number, first word)."""
        held = self.rows.get(string)
        if held is None:
            self.rows[string] = [key, doc, places, length]
            self.size += len(string) + 200
        elif doc == held[1]:
            held[2].extend(places)
            self.size += 100 * len(places)
        else:
            if doc < held[1]:
                held[1], held[2], places = doc, places, held[2]
            self.spans += [(n, at, at + length) for n, at in places]

    def full(self) -> bool:
        return self.size + 200 * len(self.spans) > HELD

    def out(self) -> pa.RecordBatch:
        rows, spans = list(self.rows.items()), self.spans
        k, s = len(rows), len(spans)
        columns = [
            pa.array([r[0] for _, r in rows] + [None] * s, pa.int64()),
            pa.array([r[1] for _, r in rows] + [None] * s, pa.int64()),
            pa.array([np.array(r[2], np.int64).tobytes() for _, r in rows] + [None] * s, pa.binary()),
            pa.array([w for w, _ in rows] + [None] * s, pa.binary()),
            *[pa.array([None] * k + [x[i] for x in spans], t) for i, t in enumerate((pa.int64(), pa.int32(), pa.int32()))],
        ]
        self.__init__()
        return pa.RecordBatch.from_arrays(columns, names=["key", "doc", "places", "words", "n", "a", "b"])


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = _Held()
    for batch in by_bytes(batches, "text"):
        texts = as_bytes(batch.column("text"))
        starts, ends, first = words(*joined(texts))
        begin = np.cumsum([0, *map(len, texts)])
        asked = batch.column("asked")
        where = asked.offsets.to_numpy()
        key, start, windows = (asked.values.field(f).to_numpy() for f in ("key", "start", "windows"))
        for i, (n, doc) in enumerate(zip(batch.column("n").to_pylist(), batch.column("doc").to_pylist(), strict=True)):
            for j in range(where[i], where[i + 1]):
                a, length = first[i] + start[j], int(windows[j]) + WINDOW - 1
                piece = texts[i][starts[a] - begin[i] : ends[a + length - 1] - begin[i]]
                held.add(int(key[j]), doc, [(n, int(start[j]))], b" ".join(piece.split()), length)
            if held.full():
                yield held.out()
    yield held.out()


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each window of a hot bucket's strings as a string of its own."""
    held = _Held()
    for batch in batches:
        for doc, places, string in zip(*[batch.column(c).to_pylist() for c in ("doc", "places", "words")], strict=True):
            pairs, parts = np.frombuffer(places, np.int64).reshape(-1, 2).tolist(), string.split(b" ")
            for i in range(len(parts) - WINDOW + 1):
                window = b" ".join(parts[i : i + WINDOW])
                held.add(xxhash.xxh64_intdigest(window, 1) - (1 << 63), doc, [(n, at + i) for n, at in pairs], window, WINDOW)
                if held.full():
                    yield held.out()
    yield held.out()


def window_ranks(codes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """A number for the window at each word, the same for equal ones."""
    rank, size = np.unique(codes, return_inverse=True)[1].astype(np.int64), 1
    while size < window:
        step = min(size, window - size)
        rank = np.unique(rank[:-step] * (len(codes) + 1) + rank[step:], return_inverse=True)[1].astype(np.int64)
        size += step
    return rank


def _judged(doc: list[int], places: list[bytes], strings: list[bytes]) -> pa.RecordBatch:
    """Spans of words whose windows have an equal one in a smaller document of the block."""
    data, offsets = joined(strings)
    starts, ends, first = words(data, offsets)
    rank = window_ranks(distinct(data, starts, ends)[0])
    counts = np.diff(first) - WINDOW + 1
    row = np.repeat(np.arange(len(strings)), counts)
    inner = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    rank, own = rank[first[row] + inner], np.array(doc, np.int64)[row]
    order = np.lexsort((own, rank))
    fresh = np.ones(len(order), bool)
    fresh[1:] = rank[order][1:] != rank[order][:-1]
    least = own[order][np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
    gone = np.zeros(len(order), bool)
    gone[order] = own[order] > least
    edge = np.ones(len(row), bool)
    edge[1:] = (row[1:] != row[:-1]) | ~gone[:-1]
    a = np.flatnonzero(gone & edge)
    edge = np.ones(len(row), bool)
    edge[:-1] = (row[1:] != row[:-1]) | ~gone[1:]
    b = np.flatnonzero(gone & edge)
    out_n, out_a, out_b = [], [], []
    for r, i, j in zip(row[a].tolist(), inner[a].tolist(), (inner[b] + WINDOW).tolist(), strict=True):
        pairs = np.frombuffer(places[r], np.int64).reshape(-1, 2)
        out_n.append(pairs[:, 0])
        out_a.append(pairs[:, 1] + i)
        out_b.append(pairs[:, 1] + j)
    join = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    return pa.RecordBatch.from_arrays([pa.array(join(out_n), pa.int64()), pa.array(join(out_a).astype(np.int32)), pa.array(join(out_b).astype(np.int32))], names=["n", "a", "b"])


def _sorted(batches: Iterator[pa.RecordBatch], block: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """Rows come in order of their bucket; whole buckets are judged, as many as make up a block."""
    doc, places, strings, size, at = [], [], [], 0, None
    for batch in batches:
        for key, d, p, w in zip(*[batch.column(c).to_pylist() for c in ("key", "doc", "places", "words")], strict=True):
            if size > block * 6 and key != at:  # a word and its space have about six bytes
                yield _judged(doc, places, strings)
                doc, places, strings, size = [], [], [], 0
            at = key
            doc.append(d)
            places.append(p)
            strings.append(w)
            size += len(w)
    if strings:
        yield _judged(doc, places, strings)


def _remove(batches: Iterator[pa.RecordBatch], keep_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in by_bytes(batches, "text"):
        number, removed, digests, kept = [], [], [], []
        for text, spans in zip(as_bytes(batch.column("text")), batch.column("spans").to_pylist(), strict=True):
            parts = text.split()
            stay = np.ones(len(parts), bool)
            for x in spans or ():
                stay[x["a"] : x["b"]] = False
            rest = b" ".join([w for w, s in zip(parts, stay.tolist(), strict=True) if s] if spans else parts)
            number.append(len(parts))
            removed.append(int(len(parts) - stay.sum()))
            digests.append(hashlib.sha256(rest).hexdigest())
            kept.append(rest if keep_text else None)
        yield pa.RecordBatch.from_arrays([batch.column("n"), batch.column("doc"), pa.array(number, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests), pa.array(kept, pa.binary())], names=["n", "doc", "n_words", "n_removed", "kept_sha256", "kept"])


def removed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False, hot: int = HOT) -> DataFrame:
    """One row a document: id, n_words, n_removed, kept_sha256 (and ``kept``, the words that remain, joined by a space)."""
    share = partitions(docs.sparkSession)
    id_ = F.col(id_col).cast("long")
    source = docs.select(F.coalesce(id_, F.lit(LAST)).alias("doc"), id_.isNull().cast("long").alias("lost"), F.col(text_col).cast("binary").alias("text"))
    cut = written(source.mapInArrow(_cut, CUT), "superkmers-cut")
    ends = cut.select("doc", F.explode("keys").alias("key")).groupBy("key").agg(F.min("doc").alias("low"), F.max("doc").alias("high"))
    shared = written(ends.where("low < high").select("key"), "superkmers-shared")
    runs = cut.select("n", F.explode(F.arrays_zip("keys", "starts", "windows")).alias("r")).select("n", F.col("r.keys").alias("key"), F.col("r.starts").alias("start"), F.col("r.windows").alias("windows"))
    asked = runs.join(shared, "key").groupBy("n").agg(F.collect_list(F.struct("key", "start", "windows")).alias("asked"))
    strings = written(cut.select("n", "doc", "text").join(asked, "n").mapInArrow(_strings, ROW), "superkmers-strings")

    def judged(rows: DataFrame) -> DataFrame:
        return rows.repartition(share, "key").sortWithinPartitions("key").mapInArrow(_sorted, SPAN)

    travel = strings.where("key is not null").select("key", "doc", "places", "words")
    many = written(travel.groupBy("key").agg(F.count("*").alias("k")).where(F.col("k") > hot).select("key"), "superkmers-hot")  # at most a hot-th of the strings
    spans = strings.where("n is not null").select("n", "a", "b")
    if many.isEmpty():
        spans = spans.unionByName(judged(travel))
    else:
        fine = written(travel.join(many, "key", "left_semi").mapInArrow(_windows, ROW), "superkmers-windows")
        spans = spans.unionByName(judged(travel.join(many, "key", "left_anti"))).unionByName(judged(fine.where("key is not null").select("key", "doc", "places", "words"))).unionByName(fine.where("n is not null").select("n", "a", "b"))
    spans = spans.groupBy("n").agg(F.collect_list(F.struct("a", "b")).alias("spans"))
    out = cut.select("n", "doc", "text").join(spans, "n", "left").mapInArrow(partial(_remove, keep_text=keep_text), "n bigint, doc bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept binary")
    return out.select(F.when(F.col("n") % 2 == 0, F.col("doc")).alias(id_col), "n_words", "n_removed", "kept_sha256", *(["kept"] if keep_text else []))
