"""Collocations by hierarchical pair naming.

Texts are cut into words and pieces, and written as *chunks*: the words of some documents of one
language as numbers, with a mark wherever the next word is not adjacent.

1. Each chunk sends its distinct words with their counts to buckets by their hash. A bucket sums the counts,
   gives each frequent word an id, and returns to each chunk the ids of those of its words that are frequent.
2. A chunk replaces its words by these ids; all else becomes a mark. What is adjacent are pairs of frequent words. They go
   to buckets in the same way, and get an id each where they are frequent.
3. The chunk replaces its words by pair ids, and pairs of adjacent pair ids are phrases of three words: a
   phrase of k words is the pair of the ids of its first and its last k - 1 words. And so on.

A phrase that is frequent has frequent parts only, so nothing is lost. The pair that an id stands for is its
*parent pointer*: f of the first and the last words of a phrase, which its cuts ask for,
are found by joining along the pointers, and so are the phrases that it covers. A phrase of k + 2 or more words needs no look: the
longer phrase between them is frequent at least as often.

A bucket and a chunk are one task's memory; neither grows with a word's count. There are ``PER_TASK``
buckets for each shuffle partition, chunks have about ``chunk`` bytes of text (one whole text at least).

Defined cases: a null text is empty, a null language is ``und`` and counts together with rows of that name; rows that
repeat an id count each; of equal scores the more frequent phrase comes first, then the one that is smaller in UTF-8 bytes;
a language without candidates has no rows; an empty table gives an empty table; further columns never matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarifa.llm.common import as_bytes, by_bytes, numbered, partitions, running, trim
from tarifa.session import written

CHUNK = 4 << 20
PER_TASK = 2
#: seq rows have ``number`` (of words) and ``keys`` (the sequence); bucket rows have ``first`` (the number of their first key)
CHUNKS = "chunk bigint, bucket int, first int, lang string, keys binary, more binary, counts binary, number bigint"
NAMES = "chunk bigint, codes binary, ids binary, id bigint, lang string, word string, left bigint, right bigint, a bigint"



def packed(values: np.ndarray, sorted_: bool = False) -> bytes:
    """Integers as zstd of their bytes by place, high bytes of small numbers together; ``sorted_``: of their differences."""
    values = np.diff(values, prepend=values.dtype.type(0)) if sorted_ else values
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes())


def unpacked(data: bytes, kind: type, sorted_: bool = False) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    values = np.ascontiguousarray(planes.T).view(kind).ravel()
    return np.cumsum(values, dtype=kind) if sorted_ else values


KINDS = np.zeros(256, np.uint8)  # 0: of a word, 1: between words, 2: between pieces
KINDS[list(b"\t ")] = 1
KINDS[list(b".,;:!?\n\x0b\x0c\r")] = 2
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def sequence(texts: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """The words of all texts as numbers, -1 between words that are not adjacent, and the words by number."""
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    kinds = KINDS[data]
    inside = np.concatenate([[0], (kinds == 0).view(np.int8), [0]])
    edges = np.diff(inside)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    codes, distinct = numbered(LOWER[data[kinds == 0]], ends - starts)
    piece = np.searchsorted(np.flatnonzero(kinds == 2), starts)
    place = np.arange(len(codes)) + np.concatenate([[0], np.cumsum(piece[1:] != piece[:-1])]).astype(np.int64)[: len(codes)]
    out = np.full(place[-1] + 1 if len(place) else 0, -1, np.int32)
    out[place] = codes
    return out, distinct.to_pylist()


def _table(schema: str, rows: list[dict]) -> pa.Table:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    return pa.Table.from_pylist(rows, pa.schema([(n, kinds[t]) for n, t in (c.strip().split(" ") for c in schema.split(","))]))


def _dealt(chunk: int, codes: np.ndarray, buckets: np.ndarray, number: int, lang: str | None, keys) -> list[dict]:
    """The rows of a chunk: its sequence, numbered anew by bucket, and a row for each bucket with its distinct entries, ``keys(places)``."""
    order = np.argsort(buckets, kind="stable")
    place = np.empty(len(order) + 1, np.int32)
    place[order] = np.arange(len(order))
    place[-1] = -1  # of the mark
    seq = place[codes]
    counts = np.bincount(seq[seq >= 0], minlength=len(order)).astype(np.int32)
    rows = [{"chunk": chunk, "lang": lang, "keys": packed(seq), "number": number}]
    cuts = np.flatnonzero(np.concatenate([[True], buckets[order][1:] != buckets[order][:-1], [True]])) if len(order) else []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        rows.append({"chunk": chunk, "bucket": int(buckets[order[a]]), "first": int(a), "lang": lang, **keys(order[a:b]), "counts": packed(counts[a:b])})
    return rows


def _chunks(batches: Iterator[pa.RecordBatch], buckets: int, size: int) -> Iterator[pa.RecordBatch]:
    """Chunks of words, each of one language."""
    held: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    at = TaskContext.get().partitionId() << 32

    def out(lang: str) -> Iterator[pa.RecordBatch]:
        nonlocal at
        seed = xxhash.xxh64_intdigest(lang.encode())
        codes, words = sequence(held.pop(lang))
        del sizes[lang]
        bucket = np.fromiter((xxhash.xxh64_intdigest(w, seed) % buckets for w in words), np.int32, len(words))
        rows = _dealt(at, codes, bucket, int((codes >= 0).sum()), lang, lambda places: {"keys": b"\n".join([words[i] for i in places.tolist()])})
        at += 1
        yield from _table(CHUNKS, rows).to_batches()
        trim()

    for batch in by_bytes(batches, "text"):
        for lang, text in zip(batch.column("lang").to_pylist(), as_bytes(batch.column("text")), strict=True):
            held.setdefault(lang, []).append(text)
            sizes[lang] = sizes.get(lang, 0) + len(text)
        for lang in [x for x in sizes if sizes[x] >= size] if sum(sizes.values()) < 4 * size else list(sizes):
            yield from out(lang)
    for lang in list(sizes):
        yield from out(lang)


def _blobs(column: pa.ChunkedArray, kind: type, sorted_: bool = False) -> tuple[np.ndarray, np.ndarray]:
    parts = [unpacked(x, kind, sorted_) for x in column.to_pylist()]
    return np.concatenate(parts), np.array([len(p) for p in parts])


def _named(table: pa.Table, least: int, buckets: int) -> pa.Table:
    """A bucket: names for its entries that occur ``least`` times, and the ids that each chunk asked for."""
    bucket = table["bucket"][0].as_py()
    counts, sizes = _blobs(table["counts"], np.int32)
    row = np.repeat(np.arange(len(sizes)), sizes)
    langs = table["lang"].combine_chunks().dictionary_encode()
    if langs.null_count:  # pairs of ids, which are of one language
        pairs = np.stack([_blobs(table["keys"], np.int64, True)[0], _blobs(table["more"], np.int64)[0]], axis=1)
        ids, ranks = np.unique(pairs, return_inverse=True)
        ranks = ranks.reshape(-1, 2)
        key = ranks[:, 0] * len(ids) + ranks[:, 1]
    else:
        words = pa.array(b"\n".join(table["keys"].to_pylist()).split(b"\n"), pa.binary()).dictionary_encode()
        key = langs.indices.to_numpy().astype(np.int64)[row] * len(words.dictionary) + words.indices.to_numpy()
    _, one, entry = np.unique(key, return_index=True, return_inverse=True)
    total = np.zeros(len(one), np.int64)
    np.add.at(total, entry, counts)
    often = np.flatnonzero(total >= least)
    id_of = np.full(len(one), -1, np.int64)
    id_of[often] = np.arange(len(often)) * buckets + bucket
    names: dict[str, list] = {"id": id_of[often].tolist(), "a": total[often].tolist()}
    if langs.null_count:
        names |= {"left": pairs[one[often], 0].tolist(), "right": pairs[one[often], 1].tolist()}
    else:
        names |= {"lang": langs.take(pa.array(row[one[often]])).to_pylist(), "word": words.take(pa.array(one[often])).cast(pa.string()).to_pylist()}
    rows = [dict(zip(names, x, strict=True)) for x in zip(*names.values(), strict=True)]
    begin = np.concatenate([[0], np.cumsum(sizes)])
    for i, (chunk, first) in enumerate(zip(table["chunk"].to_pylist(), table["first"].to_pylist(), strict=True)):
        ids = id_of[entry[begin[i] : begin[i + 1]]]
        known = np.flatnonzero(ids >= 0)
        if len(known):
            rows.append({"chunk": chunk, "codes": packed((known + first).astype(np.int32), True), "ids": packed(ids[known])})
    trim()
    return _table(NAMES, rows)


def paired(codes: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of a sequence whose entries have ids (-1: none): the sequence of adjacent pairs by number, -1 between such as don't overlap, and the pairs by number."""
    ids = np.append(names, -1)[codes]
    live = ids >= 0
    keep = live.copy()
    keep[1:] |= live[:-1]  # one mark behind each run is enough
    ids = ids[keep]
    both = (ids[:-1] >= 0) & (ids[1:] >= 0)
    distinct, rank = np.unique(ids, return_inverse=True)
    key = rank[:-1][both] * len(distinct) + rank[1:][both]
    found, number = np.unique(key, return_inverse=True)
    out = np.full(len(both), -1, np.int32)
    out[both] = number
    return out, np.stack([distinct[found // max(1, len(distinct))], distinct[found % max(1, len(distinct))]], axis=1) if len(found) else np.zeros((0, 2), np.int64)


def _paired(own: pa.Table, replies: pa.Table, buckets: int) -> pa.Table:
    """A chunk with the ids of its frequent entries: the chunk of their pairs."""
    if not own.num_rows or not replies.num_rows:
        return _table(CHUNKS, [])
    codes = unpacked(own["keys"][0].as_py(), np.int32)
    names = np.full(max(codes.max(initial=-1) + 1, 0), -1, np.int64)
    names[_blobs(replies["codes"], np.int32, True)[0]] = _blobs(replies["ids"], np.int64)[0]
    seq, pairs = paired(codes, names)
    mixed = pairs.astype(np.uint64) * np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)
    mixed = (mixed[:, 0] ^ (mixed[:, 1] >> np.uint64(29)) ^ mixed[:, 1]) * np.uint64(0xBF58476D1CE4E5B9)
    bucket = ((mixed >> np.uint64(33)) % np.uint64(buckets)).astype(np.int32)
    rows = _dealt(own["chunk"][0].as_py(), seq, bucket, 0, None, lambda places: {"keys": packed(pairs[places, 0], True), "more": packed(pairs[places, 1])})
    trim()
    return _table(CHUNKS, rows if len(rows) > 1 else [])


def phrases(docs: DataFrame, most: int = 4, least: int = 30, text_col: str = "text", lang_col: str = "lang", chunk: int = CHUNK) -> tuple[list[DataFrame], DataFrame]:
    """A table of phrases for each number of words from 1 to ``most``, and (lang, n).

    (id, lang, phrase, last, a, heads, tails, left, right): last is the last word, a the phrase's count, heads[i] and tails[i] the counts
    of its first and last i + 1 words, left and right the ids of its first and last words but one.
    """
    buckets = PER_TASK * partitions(docs.sparkSession)
    source = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("binary").alias("text"))
    chunks = written(source.mapInArrow(partial(_chunks, buckets=buckets, size=chunk), CHUNKS), "collocations-words")
    totals = chunks.where("bucket is null").groupBy("lang").agg(F.sum("number").alias("n"))
    levels: list[DataFrame] = []
    for k in range(1, most + 1):
        asked = chunks.where("bucket is not null").select("chunk", "bucket", "first", "lang", "keys", "more", "counts")
        named = written(asked.groupBy("bucket").applyInArrow(lambda bucket: _named(bucket, least, buckets), NAMES), "collocations-named")
        found = named.where("id is not null")
        if k == 1:
            grown = found.select("id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "a", F.array("a").alias("heads"), F.array("a").alias("tails"), "left", "right")
        else:
            grown = _grown(found.select("id", "left", "right", "a"), levels[-1])
        levels.append(written(grown, "collocations-phrases"))
        if k < most:
            own, replies = chunks.where("bucket is null").select("chunk", "keys"), named.where("chunk is not null").select("chunk", "codes", "ids")
            chunks = written(own.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(lambda own, replies: _paired(own, replies, buckets), CHUNKS), "collocations-pairs")
    return levels, totals


def _grown(found: DataFrame, shorter: DataFrame) -> DataFrame:
    """Pairs of ids to phrases, along both parent pointers."""
    first = shorter.select(F.col("id").alias("left"), "lang", F.col("phrase").alias("_phrase"), F.col("heads").alias("_heads"))
    last = shorter.select(F.col("id").alias("right"), "last", F.col("tails").alias("_tails"))
    both = found.join(first, "left").join(last, "right")
    more = lambda c: F.concat(c, F.array("a"))
    return both.select("id", "lang", F.concat_ws(" ", "_phrase", "last").alias("phrase"), "last", "a", more("_heads").alias("heads"), more("_tails").alias("tails"), "left", "right")


def _cut(k: int, unit: int) -> Column:
    """The lowest of the cuts' scores floor(unit * a / (l + r)) with its l and r, in decimals."""
    cuts = []
    for i in range(1, k):
        left, right = f"heads[{i - 1}]", f"tails[{k - i - 1}]"
        score = f"(cast(a as decimal(19, 0)) * {unit}BD) div (cast({left} as decimal(19, 0)) + cast({right} as decimal(19, 0)))"
        cuts.append(f"named_struct('score', {score}, 'k', {i}, 'l', {left}, 'r', {right})")
    return F.expr(f"array_min(array({', '.join(cuts)}))")


def collocations(docs: DataFrame, top: int = 2000, most: int = 4, least: int = 30, unit: int = 2_000_000, cover: int = 80, text_col: str = "text", lang_col: str = "lang", chunk: int = CHUNK) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of 2 to ``most`` words.

    A phrase that lies in a longer one which has at least ``cover`` hundredths of its count is left out.
    """
    levels, totals = phrases(docs, most, least, text_col, lang_col, chunk)
    parts = []
    for k, level in enumerate(levels[1:], 2):
        scored = level.withColumn("cut", _cut(k, unit))
        if k < most:
            longer = levels[k].select(F.explode(F.array("left", "right")).alias("id"), F.col("a").alias("_a")).groupBy("id").agg(F.max("_a").alias("_a"))
            scored = scored.join(longer, "id", "left").where(f"_a is null or cast(_a as decimal(19, 0)) * 100BD < cast(a as decimal(19, 0)) * {cover}BD")
        parts.append(scored.select("lang", "phrase", "a", "cut.score", "cut"))
    rows = reduce(DataFrame.unionByName, parts)
    # ranks by ranges of the whole order, so that one language with most of the phrases is not one task's
    before = written(running(rows, [F.col("lang"), F.col("score").desc(), F.col("a").desc(), F.col("phrase")], {"_before": F.lit(1).cast("long")}), "collocations-order")
    starts = before.groupBy("lang").agg(F.min("_before").alias("_first"))
    ranked = before.join(starts, "lang").withColumn("rank", F.col("_before") - F.col("_first") + 1).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "cut.l", "cut.r", "n", "score")
