"""An inverted-file index of vectors for nearest neighbours by cosine.

Centres are learned from a bounded sample (the rows whose ids have the smallest hashes, so
that all rows are covered), every row is assigned to the list of its nearest centre, and lists
are kept as a table. A query visits

* the lists of its ``probes`` nearest centres (approximate), or
* all lists that can hold a row of a given score (exact): a row is within its list's widest angle of the
  centre, so its angle to the query is at least the centre's less that one.

``search(exact=True)`` takes the k-th score of the nearest lists for that limit, ``within`` a
fixed one. Neither drops a row: lists of any size are visited in parts of about ``PART_ROWS``.

Queries travel to the lists, and a list's part travels once, or once for each ``ASKED_ROWS`` queries that ask for it. Centres are
the only thing that is broadcast: ``CENTRE_BYTES`` at most, whatever the number of rows.

Rows whose vector is null, empty, holds a null or a non-finite number, or has another length than
most are left out of the index; such queries have no neighbours. A vector of zeros has the score 0 with all.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tarifa.session import written

PART_ROWS = 4_096
ASKED_ROWS = 8_192
CENTRE_BYTES = 32 << 20
SAMPLE_BYTES = 64 << 20
SAMPLE_ROWS = 64  # of each list
ROUNDS = 8
SLACK = 1e-9


def unit(vectors: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of length 1, or 0."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    matrix = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)
    return matrix / np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-12)


def usable(vector: Column) -> Column:
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))), F.lit(False))


def learned(sample: np.ndarray, lists: int, rounds: int = ROUNDS) -> np.ndarray:
    """Centres by spherical k-means; a centre without members takes the row that is farthest from its own."""
    centres = sample[np.linspace(0, len(sample) - 1, lists).astype(int)].copy()
    for _ in range(rounds):
        scores = sample @ centres.T
        nearest = scores.argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        lost = np.flatnonzero(np.bincount(nearest, minlength=lists) == 0)
        far = np.argsort(scores[np.arange(len(sample)), nearest], kind="stable")[: len(lost)]
        sums[lost[: len(far)]] = sample[far]
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centres


@dataclass(frozen=True)
class VectorIndex:
    """``items``: id, vector, place, brand, sites, list, part. ``lists``: list, centre, size, parts, edge (the least cosine of a member with its centre)."""

    items: DataFrame
    lists: DataFrame

    def centres(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(centres, edges, numbers) of the lists, of bounded size by ``build``."""
        rows = self.lists.orderBy("list").toArrow()
        return unit(rows["centre"]) if rows.num_rows else np.zeros((0, 0)), rows["edge"].to_numpy(), rows["list"].to_numpy()

    def write(self, root: str) -> None:
        self.items.write.mode("overwrite").partitionBy("list").parquet(f"{root}/items")
        self.lists.write.mode("overwrite").parquet(f"{root}/lists")

    @staticmethod
    def read(spark: SparkSession, root: str) -> VectorIndex:
        return VectorIndex(spark.read.parquet(f"{root}/items"), spark.read.parquet(f"{root}/lists"))


def _assigned(batches: Iterator[pa.RecordBatch], centres) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        scores = unit(batch.column("vector")) @ centres.value.T
        nearest = scores.argmax(axis=1)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nearest.astype(np.int32)), pa.array(scores[np.arange(len(nearest)), nearest])], names=[*batch.schema.names, "list", "near"])


def build(rows: DataFrame, lists: int | None = None, id_col: str = "id", vector_col: str = "vector", place: Column | None = None, brand: Column | None = None, sites: Column | None = None) -> VectorIndex:
    """An index of the rows. ``place`` orders equal scores (default: the id); ``brand`` and ``sites`` (an array) exclude
    rows from queries of another known brand and from queries of one of these sites."""
    spark = rows.sparkSession
    id_ = F.col(id_col).cast("string")
    kept = rows.where(usable(F.col(vector_col)) & id_.isNotNull()).select(id_.alias("id"), F.col(vector_col).alias("vector"), (F.struct(id_) if place is None else place).alias("place"), (F.lit("") if brand is None else brand).alias("brand"), (F.array().cast("array<string>") if sites is None else F.coalesce(sites, F.array().cast("array<string>"))).alias("sites"))
    kept = written(kept, "vectors")
    most = kept.groupBy(F.size("vector").alias("d")).count().orderBy(F.col("count").desc(), "d").first()
    if most is None:
        empty = spark.createDataFrame([], "list int, centre array<double>, size long, parts int, edge double")
        return VectorIndex(kept.select("*", F.lit(0).alias("list"), F.lit(0).alias("part")), empty)
    d, number = most
    kept = kept.where(F.size("vector") == d)
    lists = max(1, min(lists or int(number**0.5), number, CENTRE_BYTES // (8 * d)))
    some = min(number, SAMPLE_ROWS * lists, SAMPLE_BYTES // (8 * d))
    sample = kept.select(F.xxhash64("id").alias("h"), "id", "vector").orderBy("h", "id").limit(some).toArrow()
    centres = learned(unit(sample["vector"]), min(lists, some))
    shared = spark.sparkContext.broadcast(centres)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema) + ", list int, near double"
    assigned = written(kept.mapInArrow(partial(_assigned, centres=shared), schema), "vector-lists")
    shared.unpersist()
    of = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centres)], "list int, centre array<double>")
    sizes = assigned.groupBy("list").agg(F.count("*").alias("size"), F.min("near").alias("edge"))
    table = written(of.join(sizes, "list").select("list", "centre", "size", F.ceil(F.col("size") / PART_ROWS).cast("int").alias("parts"), "edge"), "vector-centres")
    items = assigned.drop("near").join(table.select("list", "parts"), "list")
    return VectorIndex(items.withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")).drop("parts"), table)


def _visits(batches: Iterator[pa.RecordBatch], shared, probes: int, outside: bool) -> Iterator[pa.RecordBatch]:
    """The queries with numbers of lists: the ``probes`` nearest, or all (``outside``: but the nearest) that can hold a row of the score ``least``."""
    centres, edges, numbers = shared.value
    wide = np.arccos(np.clip(edges, -1, 1))
    for batch in batches:
        q = unit(batch.column("vector"))
        scores = q @ centres.T
        probes = min(probes, scores.shape[1])
        first = np.argpartition(-scores, probes - 1, axis=1)[:, :probes] if probes else np.zeros((len(q), 0), int)
        near = np.zeros(scores.shape, bool)
        np.put_along_axis(near, first, True, axis=1)
        least = batch.column("least").to_numpy(zero_copy_only=False) if "least" in batch.schema.names else None
        if least is not None:
            reach = np.cos(np.maximum(0, np.arccos(np.clip(scores, -1, 1)) - wide[None, :] - 1e-7))
            zero = ~q.any(axis=1)
            reach[zero] = 0
            can = reach + SLACK >= least[:, None]
            near = can & ~near if outside else can
        row, list_ = np.nonzero(near)
        cuts = pa.array(np.searchsorted(row, np.arange(len(q) + 1)), pa.int32())
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(cuts, pa.array(numbers[list_].astype(np.int32)))], names=[*batch.schema.names, "lists"])


def _scored(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Parts of lists come first, then the queries that visit them."""
    key, block, rows = None, None, []
    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy() for c in ("list", "part", "block", "kind")])
        cuts = np.flatnonzero(np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(axis=0), [True]]))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            piece, at, kind = batch.slice(a, b - a), tuple(keys[:3, a]), keys[3, a]
            if at != key:
                key, block, rows = at, None, []
            if kind == 0:
                rows.append(piece)
                continue
            if not rows and block is None:
                continue
            if block is None:
                table = pa.Table.from_batches(rows)
                sites = table["sites"].combine_chunks()
                names, codes = np.unique(np.array(sites.flatten().to_pylist(), object).astype(str), return_inverse=True) if len(sites.flatten()) else (np.zeros(0, str), np.zeros(0, int))
                has = np.zeros((len(names), table.num_rows), bool)
                has[codes, np.repeat(np.arange(table.num_rows), np.diff(sites.offsets.to_numpy()))] = True
                block, rows = (unit(table["vector"]), np.array(table["id"].to_pylist(), object), np.array(table["brand"].to_pylist(), object), {n: i for i, n in enumerate(names.tolist())}, has), []
            vectors, ids, brands, place, has = block
            if piece.column("vector")[0].as_py() is None or len(piece.column("vector")[0]) != vectors.shape[1]:
                continue
            scores = np.round(unit(piece.column("vector")) @ vectors.T, 12)  # a product's last digits depend on its place in the block
            mine = np.array(piece.column("brand").to_pylist(), object)
            if (mine != "").any():
                scores[(mine[:, None] != "") & (brands[None, :] != "") & (mine[:, None] != brands[None, :])] = -np.inf
            for r, site in enumerate(piece.column("site").to_pylist()):
                if site in place:
                    scores[r, has[place[site]]] = -np.inf
            scores[scores < piece.column("least").to_numpy(zero_copy_only=False)[:, None]] = -np.inf
            if scores.shape[1] > k:  # of equal ones the first: rows are in order of their place
                edge = np.partition(scores, scores.shape[1] - k, axis=1)[:, -k][:, None]
                level = scores == edge
                take = (scores > edge) | (level & (np.cumsum(level, axis=1) <= k - (scores > edge).sum(axis=1)[:, None]))
            else:
                take = np.ones(scores.shape, bool)
            row, item = np.nonzero(take & np.isfinite(scores))
            yield pa.RecordBatch.from_arrays([piece.column("query").take(pa.array(row)), pa.array(ids[item].tolist(), pa.string()), pa.array(scores[row, item])], names=["query", "id", "score"])


def _visited(index: VectorIndex, asked: DataFrame, k: int, probes: int, outside: bool = False) -> DataFrame:
    """(query, id, score): the k best rows of each list's part that a query visits. asked: query, vector, brand, site, floor, and maybe least."""
    spark, share = asked.sparkSession, int(asked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shared = spark.sparkContext.broadcast(index.centres())
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in asked.schema) + ", lists array<int>"
    visits = written(asked.mapInArrow(partial(_visits, shared=shared, probes=probes, outside=outside), schema), "vector-visits")
    shared.unpersist()
    each = visits.select("query", "vector", "brand", "site", "floor", F.explode("lists").alias("list"))
    copies = each.groupBy("list").agg(F.ceil(F.count("*") / ASKED_ROWS).cast("int").alias("blocks"))
    plan = written(index.lists.select("list", "parts").join(copies, "list"), "vector-plan")  # a row for each list in use
    place = index.items.schema["place"].dataType
    none = lambda t: F.lit(None).cast(t)
    to = lambda c: F.explode(F.sequence(F.lit(0), c - 1))
    items = index.items.join(plan.select("list", "blocks"), "list").select("list", "part", to(F.col("blocks")).alias("block"), F.lit(0).alias("kind"), none("string").alias("query"), "id", "place", "vector", "brand", "sites", none("string").alias("site"), none("double").alias("least"))
    queries = each.join(plan, "list").withColumn("block", F.pmod(F.xxhash64("query"), F.col("blocks")).cast("int"))
    queries = queries.select("list", to(F.col("parts")).alias("part"), "block", F.lit(1).alias("kind"), "query", none("string").alias("id"), none(place).alias("place"), "vector", "brand", none("array<string>").alias("sites"), "site", F.col("floor").alias("least"))
    key = ["list", "part", "block"]
    both = items.unionByName(queries).repartition(share, *key).sortWithinPartitions(*key, "kind", "place")
    return both.drop("place").mapInArrow(partial(_scored, k=k), "query string, id string, score double")


def asked_of(queries: DataFrame, id_col: str = "id", vector_col: str = "vector", brand: Column | None = None, site: Column | None = None, floor: float = -2.0) -> DataFrame:
    """Queries with a vector that can be compared. ``floor``: the least score that counts."""
    id_ = F.col(id_col).cast("string")
    return queries.where(usable(F.col(vector_col)) & id_.isNotNull()).select(id_.alias("query"), F.col(vector_col).alias("vector"), (F.lit("") if brand is None else brand).alias("brand"), (F.lit(None).cast("string") if site is None else site).alias("site"), F.lit(float(floor)).alias("floor"))


def _fitting(index: VectorIndex, asked: DataFrame) -> DataFrame:
    """Without queries of another length than the index has."""
    d = index.lists.select(F.size("centre").alias("d")).first()
    return asked.where(F.size("vector") == (d[0] if d else -1))


def best(found: DataFrame, places: DataFrame, k: int) -> DataFrame:
    """(query, rank, id, score): the k best, equal scores by place."""
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "place")
    ranked = found.join(places.select("id", "place"), "id").withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= k).select("query", "rank", "id", "score")


def search(index: VectorIndex, asked: DataFrame, k: int = 10, probes: int = 8, exact: bool = False) -> DataFrame:
    """(query, rank, id, score) of the k nearest rows in the ``probes`` nearest lists or, ``exact``, in all."""
    asked = _fitting(index, asked)
    near = _visited(index, asked, k, probes)
    if not exact:
        return best(near, index.items, k)
    near = written(best(near, index.items, k).select("query", "id", "score"), "vector-near")
    known = near.groupBy("query").agg(F.min("score").alias("low"), F.count("*").alias("n"))
    limited = asked.join(known, "query", "left").withColumn("least", F.when(F.col("n") >= k, F.greatest("floor", "low")).otherwise(F.col("floor"))).drop("low", "n")
    return best(near.unionByName(_visited(index, limited, k, probes, outside=True)), index.items, k)


def within(index: VectorIndex, asked: DataFrame, k: int = 1) -> DataFrame:
    """(query, rank, id, score) of the k nearest rows that reach the query's ``floor``; exact."""
    return best(_visited(index, _fitting(index, asked).withColumn("least", F.col("floor")), k, 0), index.items, k)


def probes_for(index: VectorIndex, recall: float = 0.95, k: int = 10, sample: int = 256) -> int:
    """The least number of lists to probe at which ``sample`` of the index's own rows find that share of their k nearest."""
    rows = index.items.select(F.xxhash64("id", F.lit(7)).alias("h"), "id", "vector").orderBy("h", "id").limit(sample)
    rows = written(rows.select("id", "vector"), "vector-sample")
    exact = search(index, asked_of(rows), k, probes=4, exact=True)
    found = exact.join(index.items.select("id", F.col("list").alias("at")), "id").select("query", "at").toArrow()  # sample x k rows
    if not found.num_rows:
        return 1
    own = rows.toArrow()
    centres, _, numbers = index.centres()
    scores = unit(own["vector"]) @ centres.T
    column = np.searchsorted(numbers, found["at"].to_numpy())
    row = {q: i for i, q in enumerate(own["id"].to_pylist())}
    at = np.array([row[q] for q in found["query"].to_pylist()])
    rank = (scores[at] > scores[at, column][:, None]).sum(axis=1) + 1
    return int(np.sort(rank)[min(len(rank) - 1, int(np.ceil(recall * len(rank))) - 1)])
