"""SimHash near-duplicates by Golay-code fuzzy hashing.

1. *Fingerprints.* 64 bits of a text's 3-word shingles: a bit is set where it is
   set in over half of the shingles' hashes (XXH64, seed 42). One pass, whole texts.
   From here on only the distinct fingerprints count, so copies cost nothing.
2. *Keys.* A fingerprint has segments of 22, 21 and 21 bits. With two errors or
   fewer, one of three segments has none (pigeonhole) and the next one has two at most.
   The perfect Golay code (23, 12, 7) decodes each 23-bit word to one codeword;
   a word's keys are the codewords to which it and its 23 neighbours decode,
   which are one or six. Two words two errors apart have a common neighbour,
   hence a common key. A fingerprint's keys are each exact segment together with
   each codeword index of the next segment: 18 at most, none of which can miss a link.
3. *Join and verify.* Fingerprints that share a key meet in one task, which
   counts differing bits and emits a spanning forest of the links it finds, never
   all pairs. A key with more than ``hot`` fingerprints is dealt out once more by
   the codeword indices of the third segment, in which two errors at most remain. A
   large group is not compared pair by pair but by looking up each of the words
   at a distance of two, so that its cost is linear.
4. *Components.* Large-star and small-star rounds on the forests' edges, each
   written to the shared folder, until nothing changes.

Defined cases: a null text is an empty one; a text without words has fingerprint
zero and is linked like any other; rows that repeat an id are rows of their own;
a null id is ignored where a smallest id is looked for (a component of null ids
only has a null component); an empty table gives an empty table; further columns never matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarifa.llm.common import as_bytes, by_bytes, partitions, type_of
from tarifa.session import written

WIDTH = 3
LENGTHS = (22, 21, 21)
STARTS = (0, 22, 43)
HOT = 100_000
PAIRWISE = 20_000
GENERATOR = 0b110001110101  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1


# fingerprints


def shingle_hashes(text: bytes, width: int = WIDTH) -> list[int]:
    words = text.lower().split()  # of bytes: A-Z, and [\x20\x09-\x0D], only
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= width:
        return [xxhash.xxh64_intdigest(joined, 42)]
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes) - 1
    starts = ends - sizes + 1
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], 42) for a, b in zip(starts[: 1 - width].tolist(), ends[width - 1 :].tolist(), strict=True)]


def fingerprints_of(texts: list[bytes], block: int = 1 << 16) -> np.ndarray:
    """uint64 fingerprints."""
    counts, number = np.zeros((len(texts), 64), np.int64), np.zeros(len(texts), np.int64)
    held, owner, size = [], [], 0

    def add():
        nonlocal held, owner, size
        if size:
            hashes = np.concatenate(held)
            who = np.repeat(np.array([o for o, _ in owner]), np.array([n for _, n in owner]))
            for at in range(0, len(hashes), block):
                bits = np.unpackbits(hashes[at : at + block].astype("<u8").view(np.uint8), bitorder="little").reshape(-1, 64)
                part = who[at : at + block]
                first = np.flatnonzero(np.diff(part, prepend=-1))
                counts[part[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int32)
        held, owner, size = [], [], 0

    for i, text in enumerate(texts):
        hashes = shingle_hashes(text)
        number[i] = len(hashes)
        if hashes:
            held.append(np.array(hashes, np.uint64))
            owner.append((i, len(hashes)))
            size += len(hashes)
        if size >= block:
            add()
    add()
    bits = (counts * 2 > number[:, None]).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel().astype(np.uint64)


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in by_bytes(batches, "text"):
        prints = fingerprints_of(as_bytes(batch.column("text")))
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("mark"), pa.array(prints.view(np.int64))], names=["id", "mark", "print"])


# the Golay code


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Syndromes of each byte at each of three places, and the error of each syndrome."""

    def remainder(word: int) -> int:
        for bit in range(22, 10, -1):
            if word >> bit & 1:
                word ^= GENERATOR << (bit - 11)
        return word

    of_byte = np.array([[remainder(b << (8 * place) & 0x7FFFFF) for b in range(256)] for place in range(3)], np.int64)
    errors = np.zeros(1 << 11, np.int64)
    ones = [1 << i for i in range(23)]
    for i in range(23):
        errors[remainder(ones[i])] = ones[i]
        for j in range(i):
            errors[remainder(ones[i] | ones[j])] = ones[i] | ones[j]
            for k in range(j):
                errors[remainder(ones[i] | ones[j] | ones[k])] = ones[i] | ones[j] | ones[k]
    return of_byte, errors


def decode(words: np.ndarray) -> np.ndarray:
    """The index (12 bits) of the codeword within three errors of each 23-bit word."""
    of_byte, errors = _tables()
    syndrome = of_byte[0][words & 255] ^ of_byte[1][words >> 8 & 255] ^ of_byte[2][words >> 16]
    return (words ^ errors[syndrome]) >> 11


def code_keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which word, index): all codewords to which a word or a neighbour decodes, each once."""
    flips = np.array([0, *(1 << i for i in range(23))], np.int64)
    found = np.sort(decode(words[:, None] ^ flips[None, :]), axis=1)
    fresh = np.ones(found.shape, bool)
    fresh[:, 1:] = found[:, 1:] != found[:, :-1]
    return np.nonzero(fresh)[0], found[fresh]


def _segment(prints: np.ndarray, i: int) -> np.ndarray:
    return (prints >> np.uint64(STARTS[i]) & np.uint64((1 << LENGTHS[i]) - 1)).astype(np.int64)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = np.asarray(batch.column("print")).view(np.uint64)
        for i in range(3):
            which, index = code_keys(_segment(prints, (i + 1) % 3))
            key = (i << 34) | (_segment(prints, i)[which] << 12) | index
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(prints[which].view(np.int64))], names=["key", "print"])


def _finer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys with the third segment's index appended; bit 48 keeps them apart from the others."""
    for batch in batches:
        prints, key = np.asarray(batch.column("print")).view(np.uint64), np.asarray(batch.column("key"))
        for i in range(3):
            own = np.flatnonzero(key >> 34 == i)
            which, index = code_keys(_segment(prints[own], (i + 2) % 3))
            yield pa.RecordBatch.from_arrays([pa.array(1 << 48 | key[own][which] << 12 | index), pa.array(prints[own][which].view(np.int64))], names=["key", "print"])


# links within a key


def unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after the links a-b; a label is its component's smallest position."""
    while True:
        x, y = label[a], label[b]
        open_ = x != y
        if not open_.any():
            return label
        a, b = a[open_], b[open_]
        low, high = np.minimum(x, y)[open_], np.maximum(x, y)[open_]
        np.minimum.at(label, high, low)
        while True:
            shorter = label[label]
            if (shorter == label).all():
                break
            label = shorter


def _near(x: np.ndarray, y: np.ndarray, most: int) -> np.ndarray:
    return np.bitwise_count(x ^ y) <= most


def linked(key: np.ndarray, prints: np.ndarray, most: int = 2, pairwise: int = PAIRWISE) -> tuple[np.ndarray, np.ndarray]:
    """A forest of the links among equal keys; both arrays sorted by (key, print), no row twice."""
    n = len(key)
    label = np.arange(n)
    bounds = np.flatnonzero(np.diff(key, prepend=key[:1] - 1)) if n else np.zeros(0, int)
    sizes = np.diff(np.append(bounds, n))
    small = np.repeat(sizes <= pairwise, sizes)
    at = np.flatnonzero(small)
    step = 1
    while len(at):
        at = at[at + step < n]
        at = at[key[at] == key[at + step]]
        hit = at[_near(prints[at], prints[at + step], most)]
        if len(hit):
            label = unite(label, hit, hit + step)
        step += 1
    if (sizes > pairwise).any():
        masks = [1 << i for i in range(64)]
        masks = np.array(masks + [a | b for i, a in enumerate(masks) for b in masks[:i]], np.uint64) if most == 2 else None
        for start, size in zip(bounds[sizes > pairwise], sizes[sizes > pairwise], strict=True):
            group = prints[start : start + size]
            if masks is None:
                raise ValueError("large groups are looked up at a distance of two")
            for mask in masks:
                want = group ^ mask
                place = np.minimum(np.searchsorted(group, want), size - 1)
                hit = np.flatnonzero(group[place] == want)
                if len(hit):
                    label = unite(label, hit + start, place[hit] + start)
    child = np.flatnonzero(label != np.arange(n))
    return prints[child], prints[label[child]]


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams keys in order; the last key of a batch waits for the next one."""
    held_key, held = np.zeros(0, np.int64), np.zeros(0, np.uint64)

    def out(key, prints):
        order = np.lexsort((prints, key))
        key, prints = key[order], prints[order]
        fresh = np.ones(len(key), bool)
        fresh[1:] = (key[1:] != key[:-1]) | (prints[1:] != prints[:-1])
        a, b = linked(key[fresh], prints[fresh])
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    for batch in batches:
        key = np.concatenate([held_key, np.asarray(batch.column("key"))])
        prints = np.concatenate([held, np.asarray(batch.column("print")).view(np.uint64)])
        if not len(key):
            continue
        cut = int(np.searchsorted(key, key[-1]))
        if cut:
            yield out(key[:cut], prints[:cut])
        held_key, held = key[cut:], prints[cut:]
    if len(held):
        yield out(held_key, held)


# components


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of all nodes but the roots, from edges (a, b); the root is the smallest node.

    Large-star, then small-star: every node passes its larger, then its smaller
    neighbours on to the smallest node that it knows. A hub's neighbours are
    never gathered: its minimum comes from a partial aggregate, and the join back
    can be split by Spark.
    """

    def least(pairs: DataFrame) -> DataFrame:  # (u, v): v a neighbour of u
        low = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        return pairs.join(low, "u")

    edges = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), "cc")
    number = edges.count()
    while number:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        small = least(large)
        small = small.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(small.select(F.col("u").alias("a"), F.col("m").alias("b")))
        before, edges = edges, written(small.where("a != b").distinct(), "cc")
        had, number = number, edges.count()
        if number == had and edges.join(before, ["a", "b"], "left_anti").isEmpty():  # the same edges
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """One row a document: id, mark (XXH64 of the text), fingerprint, component_id, kept."""
    spark = docs.sparkSession
    kind = type_of(docs, id_col)
    source = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("mark"), F.col(text_col).alias("text"))
    prints = written(source.mapInArrow(_prints, f"id {kind}, mark bigint, print bigint"), "simhash-prints")
    first = F.min(F.when(F.col("id").isNotNull(), F.struct("id", "mark")))
    nodes = written(prints.groupBy("print").agg(first.alias("first"), F.min("mark").alias("mark"), F.count("*").alias("n")), "simhash-nodes")

    keys = nodes.select("print").mapInArrow(_keys, "key bigint, print bigint")
    many = written(keys.groupBy("key").count().where(F.col("count") > hot).select("key"), "simhash-hot")
    if many.isEmpty():
        dealt = keys
    else:
        flagged = keys.join(many.withColumn("hot", F.lit(True)), "key", "left")
        dealt = flagged.where("hot is null").select("key", "print").unionByName(flagged.where("hot").select("key", "print").mapInArrow(_finer, "key bigint, print bigint"))
    links = dealt.repartition(partitions(spark), "key").sortWithinPartitions("key").mapInArrow(_links, "a bigint, b bigint")
    roots = components(links)

    joined = nodes.join(roots, nodes["print"] == roots["node"], "left").withColumn("root", F.coalesce("root", "print"))
    whole = joined.groupBy("root").agg(F.min("first").alias("keep"), F.min("mark").alias("least"), F.count("*").alias("k"), F.sum("n").alias("rows"))
    groups = whole.where("rows > 1").select(F.col("root").alias("r"), "keep", "least", F.col("rows"))
    member = joined.join(groups, F.col("root") == F.col("r")).select(F.col("print").alias("p"), "keep", "least", "rows")
    alone = F.col("rows").isNull()
    kept = alone | F.coalesce((F.col("id") == F.col("keep.id")) & (F.col("mark") == F.col("keep.mark")), F.col("keep").isNull() & (F.col("mark") == F.col("least")))
    return prints.join(member, F.col("print") == F.col("p"), "left").select(
        F.col("id").alias(id_col), "mark", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), F.when(alone, F.col("id")).otherwise(F.col("keep.id")).alias("component_id"), kept.alias("kept")
    )


def kept_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group, the one with the smallest id, with all its columns."""
    key = lambda id_, mark: F.to_json(F.struct(id_.alias("id"), mark.alias("mark")))  # noqa: E731  one column, never null: the join and what follows are dealt alike
    keep = near_duplicates(docs, id_col, text_col).where("kept").select(key(F.col(id_col), F.col("mark")).alias("k"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key(F.col(id_col), F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))).alias("k"))
    return rows.join(keep, "k", "left_semi").dropDuplicates(["k"]).select("row.*")
