"""Hard negatives by blocked dense matrix products.

A component x of a vector counts as floor(256 x), a row's score is its inner
product with the anchor. Anchors are the rows whose id is divisible by
``every``; they are dealt into waves of at most about ``wave_bytes``, of which one at a time is
broadcast as a dense block. Candidates never move: each task multiplies its
blocks of rows with the wave, twice.

1. A task keeps the best ``positives`` rows of the same label for each anchor
   and returns them; tasks' lists merge by rank.
2. With the positives known, each of them opens a window of scores, and a task keeps the best
   ``k`` rows of another label in each window; these merge in the same way.

Products are taken in float64, which is exact while no sum can reach 2**53. A wave and a
block for which one could are multiplied in Python's integers.

Rows are read in order of (id, number) inside a task, so that of equal scores the
one met first stays. A task holds a wave, ``k`` rows for each of its windows, and the scores of
``SLICE`` anchors with one block of candidates.

Defined cases: rows with a null label, a null vector, a null or non-finite
component, or a null id take no part; a vector with fewer components than others is filled with
zeros; rows that repeat an id are rows of their own, as anchors and as candidates, and of
equal scores and ids the one that was read first comes first; positives with equal scores have equal
windows and each gets its rows; a negative positive score has an empty window; scores beyond 64 bits are returned as the nearest
64-bit integer, and windows are those of that; an empty
table gives an empty table; further columns never matter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tarifa.session import written

SCALE = 256.0
EXACT = 1 << 53
BLOCK = 2_048
SLICE = 1_024
WAVE_BYTES = 32 << 20
FOUND = "anchor bigint, slot int, id bigint, n bigint, score bigint"


def usable(vectors: DataFrame, every: int, relabel: int, labels: int, id_col: str, vector_col: str, label_col: str, scale: float = SCALE) -> DataFrame:
    """(id, label, v, anchor): integer vectors that take part; ids divisible by ``relabel`` have the next of ``labels`` labels."""
    label = F.col(label_col).cast("long")
    moved = F.when(F.col(id_col) % relabel == 0, (label + 1) % labels).otherwise(label)
    with_label = vectors.where(label.isNotNull()).select(id_col, F.struct(moved.alias("label"), F.col(vector_col).alias("vector")).alias("both"))
    flat = with_label.select(F.col(id_col).cast("long").alias("id"), "both.label", F.col("both.vector").cast("array<double>").alias("v"))
    whole = F.col("id").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = flat.where(F.coalesce(whole, F.lit(False)))
    return rows.select("id", "label", F.transform("v", lambda x: F.floor(x * scale)).alias("v"), (F.col("id") % every == 0).alias("anchor"))


def matrix(vectors: pa.Array) -> np.ndarray:
    """Rows of integers, shorter ones filled with zeros."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    sizes, flat = np.diff(vectors.offsets.to_numpy()), vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    width = int(sizes.max()) if len(sizes) else 0
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a times b transposed, exact: in float64 if no sum can reach 2**53, else in Python's integers."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    top = lambda x: max(int(x.max()), -int(x.min())) if x.size else 0
    if width * top(a) * top(b) < EXACT:
        return a.astype(np.float64) @ b.astype(np.float64).T
    return a.astype(object) @ b.astype(object).T


class Best:
    """The k best rows of each slot: by score, then in the order in which they came."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.score = np.full((slots, k), -np.inf)
        self.id, self.n = np.zeros((slots, k), np.int64), np.zeros((slots, k), np.int64)

    def take(self, slots: np.ndarray, scores: np.ndarray, ids: np.ndarray, numbers: np.ndarray) -> None:
        """``scores``: a row for each of ``slots``, a column for each candidate; -inf where it doesn't count."""
        better = (scores > self.score[slots, -1][:, None]).any(axis=1)
        slots, scores = slots[better], scores[better]
        if not len(slots):
            return
        if scores.dtype == object and self.score.dtype != object:
            self.score = self.score.astype(object)
        k = self.k
        if scores.shape[1] > 4 * k and scores.dtype != object:  # of the rows that reach the k-th score the first k; few are left to sort
            edge = np.partition(scores, scores.shape[1] - k, axis=1)[:, -k][:, None]
            above, level = scores > edge, scores == edge
            spare = k - above.sum(axis=1)[:, None]
            at = np.nonzero(above | (level & (np.cumsum(level, axis=1) <= spare)))[1].reshape(-1, k)
        else:
            at = np.broadcast_to(np.arange(scores.shape[1]), scores.shape)
        merged = np.concatenate([self.score[slots], np.take_along_axis(scores, at, 1)], axis=1)
        order = np.argsort(-merged, axis=1, kind="stable")[:, :k]  # what was there first stays first
        self.score[slots] = np.take_along_axis(merged, order, 1)
        for own, new in ((self.id, ids), (self.n, numbers)):
            own[slots] = np.take_along_axis(np.concatenate([own[slots], new[at]], axis=1), order, 1)

    def rows(self, anchors: np.ndarray, slot: np.ndarray) -> pa.RecordBatch:
        there = self.score > -np.inf
        which = np.nonzero(there)[0]
        score = pa.array([max(-(1 << 63), min((1 << 63) - 1, int(s))) for s in self.score[there].tolist()], pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(anchors[which], pa.int64()), pa.array(slot[which].astype(np.int32)), pa.array(self.id[there]), pa.array(self.n[there]), score], names=["anchor", "slot", "id", "n", "score"])


def _blocks(batches: Iterator[pa.RecordBatch], rows: int = BLOCK) -> Iterator[tuple[np.ndarray, ...]]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            yield part.column("id").to_numpy(), part.column("n").to_numpy(), part.column("label").to_numpy(), matrix(part.column("v"))


def _positives(batches: Iterator[pa.RecordBatch], wave: Broadcast, k: int) -> Iterator[pa.RecordBatch]:
    number, label, vectors = wave.value[:3]
    best = Best(len(number), k)
    for ids, numbers, labels, block in _blocks(batches):
        for at in range(0, len(number), SLICE):
            own = slice(at, at + SLICE)
            scores = products(vectors[own], block)
            scores[(label[own][:, None] != labels[None, :]) | (number[own][:, None] == numbers[None, :])] = -np.inf
            best.take(np.arange(at, at + len(scores)), scores, ids, numbers)
    yield best.rows(number, np.zeros(len(number)))


def _negatives(batches: Iterator[pa.RecordBatch], wave: Broadcast, k: int, low: int, high: int) -> Iterator[pa.RecordBatch]:
    """A slot for each positive score of an anchor: the k best rows of other labels in its window."""
    number, label, vectors, owner, slot, positive = wave.value
    positive = positive.astype(object)
    floor, ceiling = -(-low * positive // 100), high * positive // 100  # Python's integers, so these bounds are exact
    best = Best(len(owner), k)
    for ids, numbers, labels, block in _blocks(batches):
        for at in range(0, len(number), SLICE):
            scores = products(vectors[at : at + SLICE], block)
            scores[label[at : at + SLICE][:, None] == labels[None, :]] = -np.inf
            first, last = np.searchsorted(owner, [at, at + len(scores)])  # slots are in order of their anchors
            place = owner[first:last] - at
            rank = np.arange(len(place)) - np.searchsorted(place, place)
            for r in range(int(rank.max()) + 1 if len(rank) else 0):  # the anchors' first windows, their second ones, and so on
                here = np.flatnonzero(rank == r) + first
                inside = scores[owner[here] - at]
                bound = lambda x: x[here][:, None].astype(inside.dtype)  # noqa: B023, E731
                inside = np.where((inside >= bound(floor)) & (inside <= bound(ceiling)), inside, -np.inf)
                best.take(here, inside, ids, numbers)
    yield best.rows(number[owner], slot)


def _merged(found: DataFrame, k: int) -> DataFrame:
    """Tasks' lists, each k rows at most, to one list of each slot."""
    order = Window.partitionBy("anchor", "slot").orderBy(F.col("score").desc(), "id", "n")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame, every: int = 100, positives: int = 5, k: int = 10, low: int = 30, high: int = 90, relabel: int = 7, labels: int = 10,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", wave_bytes: int = WAVE_BYTES,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Of each anchor's ``positives`` best rows of its own label, the first ``k`` rows of other
    labels with low * positive_score <= 100 * negative_score <= high * positive_score.
    """
    spark = vectors.sparkSession
    rows = written(usable(vectors, every, relabel, labels, id_col, vector_col, label_col).withColumn("n", F.monotonically_increasing_id()), "negatives-rows")
    asked = rows.where("anchor").agg(F.count("*"), F.max(F.size("v"))).first()
    waves = max(1, -(-asked[0] * 8 * (asked[1] or 1) // wave_bytes))
    scanned = rows.select("id", "n", "label", "v").sortWithinPartitions("id", "n")
    wave_of = F.pmod(F.xxhash64("n"), F.lit(waves))
    parts = []
    for w in range(waves):
        anchors = rows.where(F.col("anchor") & (wave_of == w)).select("n", "id", "label", "v").orderBy("n").toArrow()  # one wave: of bounded size
        number, label, block = anchors["n"].to_numpy(), anchors["label"].to_numpy(), matrix(anchors["v"])

        def over(step: Callable, sent: tuple, k: int) -> DataFrame:
            shared = spark.sparkContext.broadcast(sent)
            out = written(_merged(scanned.mapInArrow(partial(step, wave=shared, k=k), FOUND), k), "negatives-found")
            shared.unpersist()
            return out

        near = over(_positives, (number, label, block), positives)
        scores = near.groupBy("anchor", "score").agg(F.min("rank").alias("slot")).orderBy("anchor", "slot").toArrow()  # at most ``positives`` rows an anchor of the wave
        owner = np.searchsorted(number, scores["anchor"].to_numpy())
        windows = (number, label, block, owner, scores["slot"].to_numpy(), scores["score"].to_numpy())
        far = over(partial(_negatives, low=low, high=high), windows, k)
        parts.append((near, far))
    near, far = (reduce(DataFrame.union, x) for x in zip(*parts, strict=True))
    slots = near.withColumn("slot", F.min("rank").over(Window.partitionBy("anchor", "score"))).select("anchor", "slot", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    met = slots.join(far.select("anchor", "slot", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")), ["anchor", "slot"])
    ids = rows.where("anchor").select(F.col("id").alias("anchor_id"), F.col("n").alias("anchor"))
    return met.join(ids, "anchor").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")

