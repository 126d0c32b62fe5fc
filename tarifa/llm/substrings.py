"""Removal of repeated byte strings across documents.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts earlier:
in a document with a smaller id, or further left in the same one.

1. *Anchors.* A window of LENGTH bytes has an anchor: the leftmost of its
   ``GRAM``-byte substrings with the smallest hash. It depends on the window's
   bytes only, so equal windows have equal anchors, and neighbouring
   windows mostly share theirs. A text has one anchor in 35 bytes; a row holds its
   hash and that of its *context*, the bytes of all windows that it anchors.
2. *Owners.* Rows meet by the anchor's hash. Copies of a context are interned:
   all but the first start earlier elsewhere, whole. Most already meet in the
   scanning task and never travel. If an anchor has one context only, that is all.
3. *Index.* Else the distinct contexts are fetched from the documents and
   joined to a text, in order of their positions, by blocks of whole anchors. Its suffix
   array (sorted to 112 bytes) gives the Burrows-Wheeler transform, on which
   intervals are extended backward, breadth first: all intervals of l-byte strings
   become those of (l + 1)-byte strings, and a right end that is met for the first time is a
   common prefix of exactly l bytes. At l = LENGTH - 1 this stops. Ends that were never met
   join suffixes that share LENGTH bytes; of those the leftmost start is the first, the others go.
4. An anchor with more than ``hot`` distinct contexts does not go to one task:
   its windows are dealt out once more by the hash of all of their LENGTH bytes,
   where each window is its own context.

Hashes of 64 bits for the anchor and 64 for the context decide on interning; all
else is decided by bytes. Documents cross the network once for both uses.

Defined cases: a null text is empty and nothing is removed from it; a null id
ranks behind every other id; rows that repeat an id, or have none, are numbered and ordered by their text's SHA-256 (at most
``MARKS`` different texts of one id, else an error; any number without an id), so rows alike in id and text count as one document and all get its result;
an empty table gives an empty table; further columns never matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarifa.llm.common import as_bytes, by_bytes, partitions, running
from tarifa.session import written

LENGTH = 100
GRAM = 32
WINDOW = LENGTH - GRAM + 1
HOT = 20_000
BLOCK = 1 << 20
SEGMENT = 1 << 20
FLUSH = 1 << 19
MARKS = 1 << 25  # of 26 bits one is for rows without an id
LAST = (1 << 63) - 1
BASE = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1


# anchors


def gram_hashes(data: np.ndarray, length: int = GRAM) -> np.ndarray:
    """Mixed polynomial hashes of all substrings of ``length`` (a power of two) bytes."""
    h = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    size, power = 1, BASE
    while size < length:
        h = h[:-size] * np.uint64(power) + h[size:]
        power, size = power * power & MASK, size * 2
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return h


def anchors(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, ...]:
    """(document, first window, windows, anchor's hash) of each run of windows with one anchor.

    ``starts``, ``stops``: where documents begin and end in ``data``.
    """
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none, none, none, np.zeros(0, np.uint64)
    h = gram_hashes(data)
    low = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)  # the leftmost of equal hashes
    size = 1
    while size * 2 <= WINDOW:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < WINDOW:
        low = np.minimum(low[: len(low) - (WINDOW - size)], low[WINDOW - size :])
    at = low.astype(np.uint32)  # the anchor of the window at each start
    fits = np.flatnonzero(stops - starts >= LENGTH)
    valid = np.zeros(len(at) + 1, np.int8)
    valid[starts[fits]] += 1
    np.subtract.at(valid, stops[fits] - LENGTH + 1, 1)
    valid = np.cumsum(valid[:-1], dtype=np.int8).astype(bool)
    fresh = valid.copy()
    fresh[1:] &= (at[1:] != at[:-1]) | ~valid[:-1]
    first = np.flatnonzero(fresh)
    ends = valid.copy()
    ends[:-1] &= (at[1:] != at[:-1]) | ~valid[1:]
    last = np.flatnonzero(ends)
    return np.searchsorted(starts, first, side="right") - 1, first, last - first + 1, h[at[first]]


def _pack(position: np.ndarray, mark: np.ndarray, windows: np.ndarray) -> np.ndarray:
    return position.astype(np.int64) << 33 | mark.astype(np.int64) << 7 | windows  # 31, 26 and 7 bits


def _spans(doc: np.ndarray, mark: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """Rows (doc, mark, spans) with the merged spans of each document as int32 pairs."""
    order = np.lexsort((a, mark, doc))
    doc, mark, a, b = doc[order], mark[order], a[order], b[order]
    other = np.ones(len(doc), bool)
    other[1:] = (doc[1:] != doc[:-1]) | (mark[1:] != mark[:-1])
    group = np.cumsum(other) - 1
    reach = np.maximum.accumulate(b + group * (1 << 33)) - group * (1 << 33)  # documents don't reach into each other
    fresh = other.copy()
    fresh[1:] |= a[1:] > reach[:-1]
    begin = np.flatnonzero(fresh)
    stop = np.append(begin[1:], len(doc)) - 1
    pairs = np.stack([a[begin], reach[stop]], axis=1).astype(np.int32) if len(begin) else np.zeros((0, 2), np.int32)
    of = np.flatnonzero(other)
    cut = np.append(np.searchsorted(begin, of), len(begin))
    blobs = [pairs[x:y].tobytes() for x, y in zip(cut[:-1], cut[1:], strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(doc[of].astype(np.int64)), pa.array(mark[of].astype(np.int32)), pa.array(blobs, pa.binary())], names=["doc", "mark", "spans"])


ROW = "key bigint, context bigint, doc bigint, place bigint, spans binary"


def _rows(key, context, doc, place) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(key), pa.array(context), pa.array(doc), pa.array(place), pa.nulls(len(key), pa.binary())], names=["key", "context", "doc", "place", "spans"])


def _settled(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Spans on their way to their documents, in the form of anchor rows, spread by document."""
    doc, mark = np.asarray(batch.column("doc")), np.asarray(batch.column("mark")).astype(np.int64)
    spread = (doc.view(np.uint64) * np.uint64(BASE)).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(spread), pa.array(np.zeros(len(doc), np.int64)), batch.column("doc"), pa.array(mark << 7), batch.column("spans")], names=["key", "context", "doc", "place", "spans"])


def _ordered(*columns: np.ndarray) -> list[np.ndarray]:
    """Rows (key, context, doc, place) in order, the anchors of rows that are alike once."""
    key, context, doc, place = columns
    order = np.lexsort((place >> 33, place >> 7 & 0x3FFFFFF, doc, context, key))
    columns = [c[order] for c in columns]
    fresh = np.ones(len(key), bool)
    fresh[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return [c[fresh] for c in columns]


def _intern(parts: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
    """Of equal (key, context) the first travels; the others are settled."""
    key, context, doc, place = (np.concatenate(x) for x in zip(*parts, strict=True))
    key, context, doc, place = _ordered(key, context, doc, place)
    first = np.ones(len(key), bool)
    first[1:] = (key[1:] != key[:-1]) | (context[1:] != context[:-1])
    yield _rows(key[first], context[first], doc[first], place[first])
    rest = ~first
    if rest.any():
        a = place[rest] >> 33
        yield _settled(_spans(doc[rest], place[rest] >> 7 & 0x3FFFFFF, a, a + (place[rest] & 127) + LENGTH - 1))


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, number = [], 0
    digest = xxhash.xxh3_64_intdigest

    def add(texts: list[bytes], docs: np.ndarray, marks: np.ndarray, shift: int = 0):
        nonlocal number
        joined = b"".join(texts)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        stops = np.cumsum(sizes)
        owner, first, windows, hashes = anchors(np.frombuffer(joined, np.uint8), stops - sizes, stops)
        if len(first):
            ends = (first + windows + LENGTH - 1).tolist()
            context = np.array([digest(joined[a:b]) for a, b in zip(first.tolist(), ends, strict=True)], np.uint64)
            held.append((hashes.view(np.int64), context.view(np.int64), docs[owner], _pack(first - (stops - sizes)[owner] + shift, marks[owner], windows)))
            number += len(first)

    for batch in by_bytes(batches, "text", SEGMENT):
        texts, docs, marks = as_bytes(batch.column("text")), np.asarray(batch.column("doc")), np.asarray(batch.column("mark"))
        if batch.num_rows == 1 and len(texts[0]) > 2 * SEGMENT:  # a very long text, by overlapping segments
            for at in range(0, len(texts[0]) - LENGTH + 1, SEGMENT):
                add([texts[0][at : at + SEGMENT + LENGTH - 1]], docs, marks, at)
        else:
            add(texts, docs, marks)
        if number > FLUSH:
            yield from _intern(held)
            held, number = [], 0
    if held:
        yield from _intern(held)


# owners


def _groups(batches: Iterator[pa.RecordBatch], columns: list[str], rows: int) -> Iterator[list[np.ndarray]]:
    """Columns of a sorted stream, in blocks of ``rows`` or more that end with a whole key (the first column)."""
    held, number = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append([np.asarray(batch.column(c)) if not pa.types.is_binary(batch.column(c).type) else np.array(batch.column(c).to_pylist(), object) for c in columns])
            number += batch.num_rows
        if number >= rows:
            whole = [np.concatenate(x) for x in zip(*held, strict=True)]
            cut = int(np.searchsorted(whole[0], whole[0][-1]))
            if cut:
                yield [x[:cut] for x in whole]
            held, number = [[x[cut:] for x in whole]], 0  # the rest counts anew, so that a large key isn't copied at each batch
    if held:
        yield [np.concatenate(x) for x in zip(*held, strict=True)]


ASKED = "doc bigint, mark int, spans binary, key bigint, start int, windows int, hot boolean"


def _own(batches: Iterator[pa.RecordBatch], hot: int) -> Iterator[pa.RecordBatch]:
    """Settled spans, and requests for the distinct contexts of a key that has several."""

    def out(spans: pa.RecordBatch) -> pa.RecordBatch:
        n = spans.num_rows
        return pa.RecordBatch.from_arrays([spans.column("doc"), spans.column("mark"), spans.column("spans"), *[pa.nulls(n, t) for t in (pa.int64(), pa.int32(), pa.int32(), pa.bool_())]], names=["doc", "mark", "spans", "key", "start", "windows", "hot"])

    for key, context, doc, place, spans in _groups(batches, ["key", "context", "doc", "place", "spans"], 100_000):
        done = np.array([x is not None for x in spans], bool)
        if done.any():
            yield out(pa.RecordBatch.from_arrays([pa.array(doc[done]), pa.array((place[done] >> 7 & 0x3FFFFFF).astype(np.int32)), pa.array(spans[done].tolist(), pa.binary())], names=["doc", "mark", "spans"]))
        key, context, doc, place = key[~done], context[~done], doc[~done], place[~done]
        key, context, doc, place = _ordered(key, context, doc, place)
        if not len(key):
            continue
        new_key, first = np.ones(len(key), bool), np.ones(len(key), bool)
        new_key[1:] = key[1:] != key[:-1]
        first[1:] = new_key[1:] | (context[1:] != context[:-1])
        start, mark, windows = place >> 33, place >> 7 & 0x3FFFFFF, place & 127
        if not first.all():
            rest = ~first
            yield out(_spans(doc[rest], mark[rest], start[rest], start[rest] + windows[rest] + LENGTH - 1))
        at = np.flatnonzero(new_key)
        contexts = np.add.reduceat(first.astype(np.int64), at)
        many = np.repeat(contexts, np.diff(np.append(at, len(key))))
        ask = first & (many > 1)
        if ask.any():
            n = int(ask.sum())
            yield pa.RecordBatch.from_arrays([pa.array(doc[ask]), pa.array(mark[ask].astype(np.int32)), pa.nulls(n, pa.binary()), pa.array(key[ask]), pa.array(start[ask].astype(np.int32)), pa.array(windows[ask].astype(np.int32)), pa.array(many[ask] > hot)], names=["doc", "mark", "spans", "key", "start", "windows", "hot"])


FETCHED = "key bigint, doc bigint, mark int, start int, hot boolean, context binary"


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = set()  # rows that are alike are read once
    for batch in batches:
        key, doc, mark, start, hot, context = [], [], [], [], [], []
        docs, marks = batch.column("doc").to_pylist(), batch.column("mark").to_pylist()
        for i, asked in enumerate(batch.column("asked").to_pylist()):
            if (docs[i], marks[i]) in seen:
                continue
            seen.add((docs[i], marks[i]))
            text = batch.column("text")[i].as_buffer()
            for x in asked:
                key.append(x["key"])
                doc.append(docs[i])
                mark.append(marks[i])
                start.append(x["start"])
                hot.append(x["hot"])
                context.append(text[x["start"] : x["start"] + x["windows"] + LENGTH - 1].to_pybytes())
        yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(doc, pa.int64()), pa.array(mark, pa.int32()), pa.array(start, pa.int32()), pa.array(hot, pa.bool_()), pa.array(context, pa.binary())], names=["key", "doc", "mark", "start", "hot", "context"])


# the index


def suffix_order(text: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """Suffixes in order of their first ``depth`` symbols at least (symbols below 512); equal ones in any order."""
    n = len(text)
    key = np.zeros(n, np.int64)
    for j in range(7):
        key[: n - j] |= text[j:].astype(np.int64) << 9 * (6 - j)
    size = 7
    while True:
        order = np.argsort(key)
        sorted_ = key[order]
        fresh = np.ones(n, np.int64)
        fresh[1:] = sorted_[1:] != sorted_[:-1]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(fresh)
        if size >= depth or fresh.all():
            return order
        key = rank * (n + 1)
        key[: n - size] += rank[size:]
        size *= 2


def shared_prefixes(text: np.ndarray, order: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Group of each place in ``order``: a group's suffixes share their first ``length`` symbols.

    Symbol 0 ends strings: those that run over one are told from others, not from each other.
    """
    n = len(text)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    before = order - 1
    symbol = np.where(before >= 0, text[before], 0).astype(np.int64)  # the transform; before the text's start nothing is extended
    step = place[before]  # where the extension of the suffix by that symbol stands
    ends = np.zeros(n + 1, bool)
    ends[n] = ends[0] = True
    edge = np.flatnonzero(np.diff(text[order], prepend=-1, append=-1))
    left, right = edge[:-1], edge[1:]
    ends[right] = True  # common prefixes of length 0
    for _ in range(1, length):  # common prefixes of this length
        size = right - left
        one = size == 1
        rows = left[one]
        rows = rows[symbol[rows] > 0]
        new_left = [step[rows]]
        new_right = [step[rows] + 1]
        left, size = left[~one], size[~one]
        if len(left):
            of = np.repeat(np.arange(len(left)), size)
            rows = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size) + left[of]
            c = symbol[rows]
            keep = c > 0
            key, to = of[keep] * 512 + c[keep], step[rows[keep]]
            by = np.argsort(key)
            key, to = key[by], to[by]
            if len(key):
                at = np.flatnonzero(np.diff(key, prepend=-1))
                new_left.append(np.minimum.reduceat(to, at))
                new_right.append(np.maximum.reduceat(to, at) + 1)
        left, right = np.concatenate(new_left), np.concatenate(new_right)
        fresh = ~ends[right]
        left, right = left[fresh], right[fresh]
        ends[right] = True
        if not len(left):
            break
    return np.cumsum(ends[:-1])


def repeated_starts(contexts: list[bytes]) -> list[np.ndarray]:
    """Of each context, in order, the windows that also start earlier in it or in one before it."""
    sizes = np.fromiter(map(len, contexts), np.int64, len(contexts))
    joined = np.frombuffer(b"\0".join([*contexts, b""]), np.uint8).astype(np.int16) + 1
    stops = np.cumsum(sizes + 1) - 1
    joined[stops] = 0
    starts = stops - sizes
    order = suffix_order(joined)
    group = shared_prefixes(joined, order)
    valid = np.zeros(len(joined) + 1, np.int8)
    np.add.at(valid, starts, 1)
    np.subtract.at(valid, np.maximum(starts, stops - LENGTH + 1), 1)
    valid = np.cumsum(valid[:-1]).astype(bool)
    keep = valid[order]
    rows, group = order[keep], group[keep]
    first = np.full(group.max(initial=0) + 1, len(joined), np.int64)
    np.minimum.at(first, group, rows)
    again = np.zeros(len(joined), bool)
    again[rows[rows != first[group]]] = True
    return [np.flatnonzero(again[a:b]) for a, b in zip(starts.tolist(), stops.tolist(), strict=True)]


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for key, doc, mark, start, context in _groups(batches, ["key", "doc", "mark", "start", "context"], BLOCK // 128):
        order = np.lexsort((key, start, mark, doc))
        same = [c[order] for c in (key, start, mark, doc)]
        fresh = np.ones(len(order), bool)
        fresh[1:] = np.any([c[1:] != c[:-1] for c in same], axis=0)
        order = order[fresh]
        found = repeated_starts([context[i] for i in order])
        number = np.fromiter(map(len, found), np.int64, len(found))
        if number.sum():
            who = np.repeat(order, number)
            a = np.concatenate(found) + start[who]
            yield _spans(doc[who], mark[who].astype(np.int64), a, a + LENGTH)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A hot anchor's windows, each its own context."""
    for batch in batches:
        held = []
        docs, marks, starts = (np.asarray(batch.column(c)) for c in ("doc", "mark", "start"))
        for i, context in enumerate(batch.column("context").to_pylist()):
            n = len(context) - LENGTH + 1
            whole = [xxhash.xxh3_128_intdigest(context[j : j + LENGTH]) for j in range(n)]
            a = np.array([h & MASK for h in whole], np.uint64).view(np.int64)
            b = np.array([h >> 64 for h in whole], np.uint64).view(np.int64)
            held.append((a, b, np.full(n, docs[i]), _pack(starts[i] + np.arange(n), np.full(n, marks[i]), np.ones(n, np.int64))))
        if held:
            yield from _intern(held)


# results


def _remove(batches: Iterator[pa.RecordBatch], keep_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in by_bytes(batches, "text"):
        n_bytes, removed, number, digests, kept = [], [], [], [], []
        for text, lists in zip(as_bytes(batch.column("text")), batch.column("lists").to_pylist(), strict=True):
            parts, at, gone, runs = [], 0, 0, 0
            if lists:
                pairs = np.concatenate([np.frombuffer(x, np.int32).reshape(-1, 2) for x in lists])
                for a, b in pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))].tolist():
                    if a > at or not runs:
                        parts.append(text[at:a])
                        runs, gone = runs + 1, gone + b - a
                    elif b > at:
                        gone += b - at
                    at = max(at, b)
            parts.append(text[at:])
            rest = b"".join(parts)
            n_bytes.append(len(text))
            removed.append(gone)
            number.append(runs)
            digests.append(hashlib.sha256(rest).hexdigest())
            kept.append(rest if keep_text else None)
        yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("mark"), pa.array(n_bytes, pa.int64()), pa.array(removed, pa.int64()), pa.array(number, pa.int64()), pa.array(digests, pa.string()), pa.array(kept, pa.binary())], names=["doc", "mark", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def _numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, mark, text): texts of one id have numbers in order of their digest, an even one, or an odd one for those without an id.

    Only ids of several rows are looked at. A mark has ``MARKS`` numbers; texts without an id go on in further ids behind all others.
    """
    id_ = F.col(id_col).cast("long")
    source = docs.select(id_.alias("doc"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    null = F.col("doc").isNull()
    repeated = written(source.groupBy("doc").agg(F.count("*").alias("k")).where("k > 1").select(F.col("doc").alias("r")), "substrings-repeated")
    if repeated.isEmpty():
        return source.select(F.coalesce("doc", F.lit(LAST)).alias("doc"), null.cast("int").alias("mark"), "text")
    own = source.join(repeated, F.col("doc").eqNullSafe(F.col("r")), "left_semi").select("doc", F.sha2("text", 256).alias("sha")).distinct()
    before = written(running(own, [F.col("doc").asc_nulls_last(), F.col("sha")], {"number": F.lit(1).cast("long")}), "substrings-numbers")
    first = before.groupBy(F.col("doc").alias("r")).agg(F.min("number").alias("low"), F.max("number").alias("high"))
    many = first.where(f"r is not null and high - low >= {MARKS}").first()
    if many is not None:
        raise ValueError(f"more than {MARKS} different texts of the id {many.r}: give them ids of their own")
    rank = F.col("number") - F.col("low")
    ranks = before.join(first, F.col("doc").eqNullSafe(F.col("r"))).select(F.coalesce("doc", F.lit(LAST)).alias("r"), "sha", rank.alias("rank"), F.floor((F.col("high") - F.col("low")) / MARKS).alias("more"))
    keyed = source.select(F.coalesce("doc", F.lit(LAST)).alias("doc"), null.alias("lost"), F.sha2("text", 256).alias("sha"), "text")
    both = keyed.join(written(ranks, "substrings-ranks").withColumnRenamed("sha", "s"), (F.col("doc") == F.col("r")) & (F.col("sha") == F.col("s")), "left")
    number = F.coalesce("rank", F.lit(0).cast("long"))
    doc = F.when(F.col("lost"), F.col("doc") - F.coalesce("more", F.lit(0).cast("long")) + F.floor(number / MARKS)).otherwise(F.col("doc"))
    return written(both.select(doc.alias("doc"), (number % MARKS * 2 + F.col("lost").cast("long")).cast("int").alias("mark"), "text"), "substrings-numbered")


def removed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False, hot: int = HOT) -> DataFrame:
    """One row a document: id, n_bytes, n_removed, n_spans, kept_sha256 (and ``kept``, the bytes that remain)."""
    share = partitions(docs.sparkSession)
    source = _numbered(docs, id_col, text_col)
    dealt = source.repartition(share, "doc", "mark")

    def owned(rows: DataFrame) -> DataFrame:
        return rows.repartition(share, "key").sortWithinPartitions("key").mapInArrow(partial(_own, hot=hot), ASKED)

    found = written(owned(source.mapInArrow(_find, ROW)), "substrings")
    asked = found.where("key is not null").groupBy("doc", "mark").agg(F.collect_list(F.struct("key", "start", "windows", "hot")).alias("asked"))
    fetched = dealt.join(asked, ["doc", "mark"]).mapInArrow(_fetch, FETCHED)  # Spark reuses the exchange of the documents below
    spans = "doc bigint, mark int, spans binary"
    indexed = fetched.where("not hot").repartition(share, "key").sortWithinPartitions("key").mapInArrow(_index, spans)
    every = found.where("spans is not null").select("doc", "mark", "spans").unionByName(indexed)
    if not found.where("hot").isEmpty():
        windows = owned(fetched.where("hot").mapInArrow(_windows, ROW))
        every = every.unionByName(windows.where("spans is not null").select("doc", "mark", "spans"))
    lists = every.groupBy("doc", "mark").agg(F.collect_list("spans").alias("lists"))
    out = dealt.join(lists, ["doc", "mark"], "left").mapInArrow(partial(_remove, keep_text=keep_text), "doc bigint, mark int, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")
    id_ = F.when(F.col("mark") % 2 == 0, F.col("doc")).alias(id_col)
    return out.select(id_, "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept"] if keep_text else []))
