"""Exact top-k search by inner product over an impact-ordered index.

A component x of a vector counts as floor(64 x). Rows get a number of their own and are dealt into shards of
about ``SHARD`` rows. A shard's index has a posting for each component that is
not zero, held in segments by quantised impact: segment l has the components
with 2**l <= |v| < 2**(l + 1). A segment holds only the rows and dimensions that have
a posting in it, so its product with a block of queries costs about its postings. Segments are
processed by descending impact. After each, the part of row v still to come is at
most |q| |rest of v| (Cauchy-Schwarz), which bounds every score from both sides.
Each query stops by itself, when its k best lower bounds exclude all but ``FEW``
rows: these possible members are rescored exactly from whole
vectors, all others are proven not to belong. Queries for which that never happens go on through all
segments, and their sums are exact themselves. Scores are sums of
integers, exact in the float type chosen by their bound (or else in Python's integers).

Queries meet the shards in blocks. A block and shard return k rows a query at
most, of which the k best are kept by a partial aggregate.

Defined cases: vectors that are null or hold a null or non-finite component, and
rows with a null id, take no part; candidates of a query are all rows but its own, so rows that repeat
an id, or id and vector, are rows of their own, each a query with a ranking of its own and a candidate of the others;
a vector with fewer components than others is filled with zeros; equal scores
are ordered by the smaller id; an empty table gives an empty table; further
columns never matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tarifa.llm.common import partitions
from tarifa.session import written

SHARD = 16_384
BLOCK = 1_024
FEW = 64
SCALE = 64.0


def usable(vectors: DataFrame, id_col: str, vector_col: str, scale: float = SCALE) -> DataFrame:
    """(id, v): the integer vectors that take part."""
    v = F.col(vector_col).cast("array<double>")
    whole = F.col(id_col).isNotNull() & v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(F.coalesce(whole, F.lit(False)))
    return rows.select("id", F.transform("v", lambda x: F.floor(x * scale)).alias("v"))


def _pack(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Blocks of one key's rows: (key, block, ids, numbers, vectors, width), arrays as bytes."""
    key, held, vectors, number = None, [], [], 0

    def block():
        width = max(map(len, vectors))
        matrix = np.zeros((len(vectors), width), np.int64)
        for i, v in enumerate(vectors):
            matrix[i, : len(v)] = v
        small = matrix.size == 0 or np.abs(matrix).max() < 1 << 15
        data = (b"\x02" + matrix.astype(np.int16).tobytes()) if small else (b"\x08" + matrix.tobytes())
        ids, numbers = np.array(held, np.int64).T
        return pa.RecordBatch.from_pydict({"key": pa.array([key], pa.int64()), "block": pa.array([number], pa.int64()), "ids": pa.array([ids.tobytes()], pa.binary()), "numbers": pa.array([numbers.tobytes()], pa.binary()), "vectors": pa.array([data], pa.binary()), "width": pa.array([width], pa.int64())})

    for batch in batches:
        for k, i, n, v in zip(*[batch.column(c).to_pylist() for c in ("key", "id", "n", "v")], strict=True):
            if held and (k != key or len(held) == rows):
                yield block()
                number = number + 1 if k == key else 0
                held, vectors = [], []
            key = k
            held.append((i, n))
            vectors.append(v)
    if held:
        yield block()


def _unpack(data: bytes, width: int) -> np.ndarray:
    kind = np.int16 if data[:1] == b"\x02" else np.int64
    return np.frombuffer(data, kind, offset=1).reshape(-1, width) if width else np.zeros((0, 0), np.int16)


class Shard:
    """Impact-ordered segments of a shard's rows, which are in order of id."""

    def __init__(self, ids: np.ndarray, numbers: np.ndarray, vectors: np.ndarray):
        order = np.lexsort((numbers, ids))
        self.ids, self.numbers, self.vectors = ids[order], numbers[order], vectors[order].astype(np.int64)
        self.by_number = np.argsort(self.numbers)
        impact = np.abs(self.vectors)
        self.largest = int(impact.max()) if impact.size else 0
        level = np.where(impact > 0, np.floor(np.log2(np.maximum(impact, 1))), -1).astype(np.int64)
        self.segments, self.rests = [], []  # (rows, dimensions, their postings); length of what is still to come
        kind = np.float32 if self.largest < 1 << 12 else np.float64
        for at in sorted(set(level[level >= 0].tolist()), reverse=True):
            here = level == at
            rows, dims = np.flatnonzero(here.any(axis=1)), np.flatnonzero(here.any(axis=0))
            cut = np.ix_(rows, dims)
            self.segments.append((rows, dims, np.where(here[cut], self.vectors[cut], 0).T.astype(kind)))
            self.rests.append(np.sqrt((np.where(level < at, self.vectors, 0).astype(np.float64) ** 2).sum(axis=1)))

    def own(self, numbers: np.ndarray) -> np.ndarray:
        """Where the queries' own rows are; -1: not in this shard."""
        sorted_ = self.numbers[self.by_number]
        at = np.minimum(np.searchsorted(sorted_, numbers), len(sorted_) - 1)
        return np.where(sorted_[at] == numbers, self.by_number[at], -1)

    def search(self, numbers: np.ndarray, queries: np.ndarray, k: int, few: int = FEW) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query's place, rows' places, scores): the k best of each query, its own row left out."""
        width = max(queries.shape[1], self.vectors.shape[1])
        bound = width * self.largest * (int(np.abs(queries).max()) if queries.size else 0)
        if bound >= 1 << 52:
            yield from self._exactly(numbers, queries, k)
            return
        kind = np.float32 if bound < 1 << 24 else np.float64
        shared = min(queries.shape[1], self.vectors.shape[1])
        q = queries[:, :shared].astype(kind)
        length = np.sqrt((queries[:, :shared].astype(np.float64) ** 2).sum(axis=1))
        n, own = len(self.ids), self.own(numbers)
        live, scores = np.arange(len(numbers)), np.zeros((len(numbers), n), kind)  # queries that have not stopped, and their sums
        for (rows, dims, postings), rest in zip(self.segments, self.rests, strict=True):
            dims_in = dims < shared
            part = q[live][:, dims[dims_in]] @ postings[dims_in].astype(kind, copy=False)
            if len(rows) == n:
                scores += part
            else:
                scores[:, rows] += part
            if n <= k or not rest.any():
                continue
            stopped = np.zeros(len(live), bool)
            for j, i in enumerate(live):
                reach = length[i] * rest
                low = scores[j] - reach
                if own[i] >= 0:
                    low[own[i]] = -np.inf
                possible = scores[j] + reach * 1.000001 >= np.partition(low, n - k)[n - k]
                if np.count_nonzero(possible) > few:
                    continue
                stopped[j] = True
                found = np.flatnonzero(possible)
                found = found[found != own[i]]
                exact = self.vectors[found][:, :shared] @ queries[i, :shared].astype(np.int64)
                best = np.lexsort((found, -exact))[:k]
                yield int(i), found[best], exact[best]
            if stopped.any():
                live, scores = live[~stopped], scores[~stopped]
            if not len(live):
                return
        for j, i in enumerate(live):
            line = scores[j]
            if own[i] >= 0:
                line[own[i]] = -np.inf
            if n > k:
                edge = np.partition(line, n - k)[n - k]
                rows = np.flatnonzero(line >= edge)
            else:
                rows = np.arange(n)
            rows = rows[np.isfinite(line[rows])]
            exact = line[rows].astype(np.int64)
            best = np.lexsort((rows, -exact))[:k]
            yield int(i), rows[best], exact[best]

    def _exactly(self, numbers: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        shared = min(queries.shape[1], self.vectors.shape[1])
        rows_of = [list(map(int, v[:shared])) for v in self.vectors]
        for i, q in enumerate(queries):
            q = list(map(int, q[:shared]))
            found = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), r) for r, v in enumerate(rows_of) if self.numbers[r] != numbers[i])[:k]
            yield i, np.array([r for _, r in found], np.int64), np.array([max(-(1 << 63), min((1 << 63) - 1, -s)) for s, _ in found], np.int64)


def _search(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    shard, at = None, None
    for batch in batches:
        for row in range(batch.num_rows):
            get = lambda c: batch.column(c)[row].as_py()  # noqa: B023, E731
            here = (get("key"), get("block"))
            if here != at:
                shard, at = Shard(np.frombuffer(get("ids"), np.int64), np.frombuffer(get("numbers"), np.int64), _unpack(get("vectors"), get("width"))), here
            ids, numbers = np.frombuffer(get("q_ids"), np.int64), np.frombuffer(get("q_numbers"), np.int64)
            q, m, v, s = [], [], [], []
            for i, rows, scores in shard.search(numbers, _unpack(get("q_vectors"), get("q_width")), k):
                q.append(np.full(len(rows), ids[i]))
                m.append(np.full(len(rows), numbers[i]))
                v.append(shard.ids[rows])
                s.append(scores)
            if q:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in (q, m, v, s)], names=["query_id", "query", "vec_id", "score"])


def top_k(vectors: DataFrame, every: int = 20, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", shard_rows: int = SHARD, block_rows: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score) for the queries, the rows whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    rows = written(usable(vectors, id_col, vector_col).withColumn("n", F.monotonically_increasing_id()), "topk-rows")
    number = rows.count()
    shards = max(1, -(-number // shard_rows))
    packed = "key bigint, block bigint, ids binary, numbers binary, vectors binary, width bigint"
    keyed = rows.withColumn("key", F.pmod(F.xxhash64("n"), F.lit(shards)))
    index = keyed.repartition(max(1, min(shards, partitions(spark))), "key").sortWithinPartitions("key").mapInArrow(partial(_pack, rows=shard_rows * 2), packed)
    asked = rows.where(F.col("id") % every == 0)
    blocks = max(1, -(-number // every // block_rows))
    asked = asked.withColumn("key", F.pmod(F.xxhash64("n"), F.lit(blocks))).repartition(max(1, min(blocks, partitions(spark))), "key").sortWithinPartitions("key", "n")
    asked = asked.mapInArrow(partial(_pack, rows=block_rows), packed).select(*[F.col(a).alias(b) for a, b in (("ids", "q_ids"), ("numbers", "q_numbers"), ("vectors", "q_vectors"), ("width", "q_width"))])
    asked = asked.withColumn("key", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))  # every block visits every shard
    pairs = index.join(asked, "key").repartition(partitions(spark), "key", F.xxhash64("q_numbers")).sortWithinPartitions("key", "block")
    found = pairs.mapInArrow(partial(_search, k=k), "query_id bigint, query bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
