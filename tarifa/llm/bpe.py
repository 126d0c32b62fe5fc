"""Byte-level BPE without regular expressions.

*Boundaries.* The texts of a batch become one array of code points, with a mark
between texts, and one of classes (letter, number, white space, other; what
follows decides the kind of white space and of apostrophe). A pre-token's state
has eight values, and each class is a function from states to states. Functions
compose associatively: the array is cut into rows of ``ROW`` positions, the
functions of all rows are composed side by side, a doubling scan over the rows gives
each row its first state, and a second pass along all rows gives the states,
and with them where pre-tokens start.

*Merging.* Each slice is looked up in a cache of merged slices. A miss is merged
by rank, the leftmost of the lowest ranks first; a slice of over ``LONG`` bytes
with a heap over linked neighbours, so that n bytes cost n log n. The cache is
emptied when it has ``CACHED`` slices.

*Decoding.* The encoder keeps each token's end in the bytes of its text. The decoder puts
the vocabulary's entries, which are one array with offsets, at these places, all at
once for all texts of a batch. Ids without offsets get them from their entries' sizes. The
vocabulary's file is shipped to the executors.

Defined cases: a null or empty text has no tokens; an empty table gives an empty table; a text is
always taken whole; rows that repeat an id are rows of their own; further
columns never matter.
"""

from __future__ import annotations

import base64
import heapq
import os
import unicodedata
from collections.abc import Iterator
from functools import cache, partial
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarifa.llm.common import by_bytes, type_of

ROW = 128
LONG = 256
CACHED = 1 << 17

# Code points with the White_Space property, and the endings split off after an apostrophe.
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")

LETTER, NUMBER, OTHER, WHITE_SPACE = range(4)
# Symbols of the scan: a mark between texts; the classes; an apostrophe before an ending of one or two
# letters; white space before white space or the text's end; a space, and other white space, before anything else.
MARK, LET, NUM, OTH, ONE, TWO, INNER, SPACE, LAST = range(9)
# States: what the pre-token so far is. FRESH: none is open; LEFT1, LEFT2: letters of an ending still to come.
FRESH, PREFIX, IN_LET, IN_NUM, IN_OTH, IN_WHITE, LEFT1, LEFT2 = range(8)


def _machine() -> tuple[np.ndarray, np.ndarray]:
    """(next state, whether a pre-token starts), by symbol and state."""
    to, starts = np.zeros((9, 8), np.uint8), np.ones((9, 8), bool)
    for symbol, run in ((LET, IN_LET), (NUM, IN_NUM), (OTH, IN_OTH), (INNER, IN_WHITE)):
        to[symbol] = run
        starts[symbol, run] = False
        if symbol != INNER:
            starts[symbol, PREFIX] = False
    for symbol, left in ((ONE, LEFT1), (TWO, LEFT2)):
        to[symbol] = left
        to[symbol, [PREFIX, IN_OTH]] = IN_OTH
        starts[symbol, [PREFIX, IN_OTH]] = False
    to[SPACE], to[LAST], to[MARK] = PREFIX, FRESH, FRESH
    to[LET, LEFT1], to[LET, LEFT2] = FRESH, LEFT1
    starts[LET, [LEFT1, LEFT2]] = False
    return to, starts


@cache
def _classes() -> np.ndarray:
    table = np.full(0x110000, OTHER, np.uint8)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))[0]
        if kind == "L":
            table[c] = LETTER
        elif kind == "N":
            table[c] = NUMBER
    table[WHITE] = WHITE_SPACE
    return table


def symbols(points: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """The scan's symbol of each code point; ``marks``: positions between texts."""
    n = len(points)
    kind = _classes()[points]
    out = np.array([LET, NUM, OTH, INNER], np.uint8)[kind]
    mark = np.zeros(n + 2, bool)
    mark[marks] = mark[n:] = True
    at = np.flatnonzero(kind == WHITE_SPACE)
    after = np.minimum(at + 1, n - 1)
    inner = mark[at + 1] | (kind[after] == WHITE_SPACE)
    at = at[~inner]
    out[at] = np.where(points[at] == 0x20, SPACE, LAST)
    at = np.flatnonzero(points == 0x27)
    one, two = points[np.minimum(at + 1, n - 1)], points[np.minimum(at + 2, n - 1)]
    inside1, inside2 = ~mark[at + 1], ~mark[at + 1] & ~mark[at + 2]
    for ending in ENDINGS:
        if len(ending) == 1:
            out[at[inside1 & (one == ord(ending))]] = ONE
        else:
            out[at[inside2 & (one == ord(ending[0])) & (two == ord(ending[1]))]] = TWO
    out[marks] = MARK
    return out


def starts_of(symbol: np.ndarray) -> np.ndarray:
    """Whether a pre-token starts at each position."""
    to, starts = _machine()
    flat, n = to.ravel(), len(symbol)
    rows = -(-n // ROW)
    padded = np.zeros(rows * ROW, np.uint8)
    padded[:n] = symbol
    columns = np.ascontiguousarray(padded.reshape(rows, ROW).T).astype(np.int64) * 8
    whole = np.tile(np.arange(8, dtype=np.uint8), (rows, 1))  # each row's function
    for column in columns:
        whole = flat[column[:, None] + whole]
    step = 1
    while step < rows:  # afterwards: the function of all rows up to each
        whole[step:] = np.take_along_axis(whole[step:], whole[:-step].astype(np.int64), axis=1)
        step *= 2
    state = np.full(rows, FRESH, np.uint8)
    state[1:] = whole[:-1, FRESH]
    found, begins = np.empty((ROW, rows), bool), starts.ravel()
    for j, column in enumerate(columns):
        at = column + state
        found[j] = begins[at]
        state = flat[at]
    return found.T.ravel()[:n]


class _Cache(dict):
    """Merged slices; a slice that is missing is merged when it is asked for."""

    def __init__(self, merge):
        self.merge = merge

    def __missing__(self, piece: str) -> tuple[int, ...]:
        found = self[piece] = self.merge(piece.encode())
        return found


class Vocabulary:
    """Ranks of a file of lines ``base64 rank``."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ranks = {base64.b64decode(a): int(b) for a, b in pairs}
        self.tokens: list[bytes] = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.flat = np.frombuffer(b"".join(self.tokens), np.uint8)
        self.sizes = np.fromiter(map(len, self.tokens), np.int64, len(self.tokens))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = [bytes([b]) for b in range(256)]
        self.cache = _Cache(self.merge)

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """By rank, the leftmost of the lowest first."""
        rank = self.ranks.get(piece)
        if rank is not None:
            return (rank,)
        if len(piece) > LONG:
            return self.merge_long(piece)
        get, last = self.ranks.get, len(self.tokens)
        parts = [self.bytes[b] for b in piece]
        pairs = [get(a + b, last) for a, b in zip(parts, parts[1:])]
        while pairs and (low := min(pairs)) < last:
            i = pairs.index(low)
            parts[i] += parts.pop(i + 1)
            pairs.pop(i)
            if i:
                pairs[i - 1] = get(parts[i - 1] + parts[i], last)
            if i < len(pairs):
                pairs[i] = get(parts[i] + parts[i + 1], last)
        return tuple([get(p) for p in parts])

    def merge_long(self, piece: bytes) -> tuple[int, ...]:
        """The same with a heap over linked neighbours."""
        ranks = self.ranks
        n = len(piece)
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # of the part that begins at each byte
        alive = [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i] if alive[i] else n
            if j >= n or end[j] != stop:
                continue
            alive[j] = False
            end[i] = stop
            if stop < n:
                before[stop] = i
                if (r := ranks.get(piece[i : end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            h = before[i]
            if h >= 0 and (r := ranks.get(piece[h:stop])) is not None:
                heapq.heappush(heap, (r, h, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : end[i]]])
            i = end[i]
        return tuple(out)

    def pieces(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """All pre-tokens, and how many each text has."""
        joined = "\0".join(["", *texts])  # a mark before each text
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        marks = np.cumsum(sizes + 1) - sizes - 1
        begin = np.flatnonzero(starts_of(symbols(points, marks))) if len(points) else np.zeros(0, int)
        stop = np.append(begin[1:], len(points))
        real = np.ones(len(points) + 1, bool)
        real[marks] = False
        number = np.add.reduceat(real[begin].astype(np.int64), np.searchsorted(begin, marks)) if len(texts) else np.zeros(0, int)
        keep = real[begin]
        return [joined[a:b] for a, b in zip(begin[keep].tolist(), stop[keep].tolist(), strict=True)], number

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where those of each text begin and end."""
        pieces, number = self.pieces(texts)
        cached = self.cache
        if len(cached) > CACHED:
            cached.clear()
        found = list(map(cached.__getitem__, pieces))
        ids = np.fromiter(chain.from_iterable(found), np.int32)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        upto = np.append(0, np.cumsum(sizes))
        return ids, upto[np.append(0, np.cumsum(number))]

    def ends(self, ids: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """Each token's end in the bytes of its text; ``upto``: where the texts' ids begin and end."""
        total = np.append(0, np.cumsum(self.sizes[ids]))
        return total[1:] - np.repeat(total[upto[:-1]], np.diff(upto))

    def decode(self, ids: np.ndarray, upto: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all texts, and where those of each begin and end: entries put at their tokens' offsets."""
        sizes = self.sizes[ids]
        last = np.append(ends, 0)[np.maximum(upto[1:] - 1, 0)]
        texts = np.append(0, np.cumsum(np.where(upto[1:] > upto[:-1], last, 0)))
        begin = ends - sizes + np.repeat(texts[:-1], np.diff(upto))  # in all texts' bytes
        if (begin[:1] != 0).any() or (begin[1:] != begin[:-1] + sizes[:-1]).any():
            raise ValueError("offsets do not fit the ids")
        place = np.repeat(self.starts[ids] - begin, sizes)
        place += np.arange(len(place))
        return self.flat[place], texts


@cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _shipped(docs: DataFrame, path: str) -> str:
    """The name under which executors find the file."""
    docs.sparkSession.sparkContext.addFile(path)
    return os.path.basename(path)


def _encode(batches: Iterator[pa.RecordBatch], name: str, offsets: bool) -> Iterator[pa.RecordBatch]:
    own = vocabulary(SparkFiles.get(name))
    for batch in by_bytes(batches, "text", 2 << 20):
        ids, upto = own.encode(pc.fill_null(batch.column("text"), "").to_pylist())
        columns, names = [batch.column("id"), pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.array(ids))], ["id", "ids"]
        if offsets:
            columns.append(pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.array(own.ends(ids, upto))))
            names.append("ends")
        yield pa.RecordBatch.from_arrays(columns, names=names)


def _decode(batches: Iterator[pa.RecordBatch], name: str, most: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    own = vocabulary(SparkFiles.get(name))
    for batch in batches:
        column = batch.column("ids")
        upto = np.asarray(column.offsets).astype(np.int64)
        ids = np.asarray(column.values)[upto[0] : upto[-1]]
        upto = upto - upto[0]
        kept = np.asarray(batch.column("ends").flatten()) if "ends" in batch.schema.names else own.ends(ids, upto)
        start = 0
        while start < batch.num_rows:  # about ``most`` tokens at once, one text at least
            stop = max(start + 1, int(np.searchsorted(upto, upto[start] + most, side="right")) - 1)
            a, b = upto[start], upto[stop]
            data, texts = own.decode(ids[a:b], upto[start : stop + 1] - a, kept[a:b])
            part = batch.slice(start, stop - start)
            decoded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), stop - start, [None, pa.py_buffer(texts.astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("ids"), decoded], names=["id", "ids", "decoded"])
            start = stop


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", offsets: bool = False) -> DataFrame:
    """(id, ids): the tokens of each text; with ``offsets`` also ``ends``, each token's end in bytes."""
    kind = type_of(docs, id_col)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = source.mapInArrow(partial(_encode, name=_shipped(docs, path), offsets=offsets), f"id {kind}, ids array<int>" + ", ends array<bigint>" * offsets)
    return out.withColumnRenamed("id", id_col)


def decoded(tokens: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """(id, ids, decoded): the bytes that ``ids`` stand for, put at the offsets ``ends`` where there are some."""
    kind = type_of(tokens, id_col)
    source = tokens.select(F.col(id_col).alias("id"), "ids", *[c for c in tokens.columns if c == "ends"])
    return source.mapInArrow(partial(_decode, name=_shipped(tokens, path)), f"id {kind}, ids array<int>, decoded binary").withColumnRenamed("id", id_col)


def _both(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[pa.RecordBatch]:
    yield from _decode(_encode(batches, name, True), name)


def encoded_and_decoded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``decoded(encoded(...))`` in one Python worker: (id, ids, decoded)."""
    kind = type_of(docs, id_col)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return source.mapInArrow(partial(_both, name=_shipped(docs, path)), f"id {kind}, ids array<int>, decoded binary").withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digests of both directions, one row a document."""
    both = encoded_and_decoded(docs, path, id_col, text_col)
    return both.select(id_col, F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
