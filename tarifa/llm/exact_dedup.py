"""Exact deduplication by an extendible-hash index on shared files.

Texts are equal when they are identical after every character of
``[\\x20\\x09-\\x0D]`` is deleted. The index is built in three steps:

1. *Entries.* One pass over the documents normalises each text, hashes it
   (XXH64) and writes the entries to the shared folder. Copies that meet in one
   Arrow batch become one entry that carries their number.
2. *Directory.* Bytes by hash prefix are counted by Spark, and stay in tables. Every bucket
   with more than its share of bytes, a quarter of what an owner is to get, is split by its next
   hash bit, and the directory doubles, until all buckets fit. Its size goes with the
   number of owners, not with that of the documents.
3. *Hot hashes.* A hash that alone has over an eighth of a bucket, as copies do that are spread over very many
   batches, goes to several tasks by a salt first, each of which compares bytes and hands on
   one entry for each distinct text.
4. *Owners.* Consecutive buckets are dealt to owner tasks, each a range of the
   hash space with about the same number of bytes. An owner reads its entries
   in hash order as a stream. Entries of equal hash form a chain; their texts
   are compared byte by byte, so a collision never joins two texts. A chain's
   distinct texts, its members' ids and one best row each are all it holds.

Defined cases: a null text counts as empty; all empty and all-space texts are
one group; a null id ranks behind every other id; rows that repeat an id are
rows of their own, of which one stays (the first read); an empty table gives
an empty table; further columns never matter, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarifa.llm.common import WS, as_bytes, by_bytes, partitions, running
from tarifa.session import written

LEAST = 1 << 20  # bytes of a bucket at least


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _better(a: tuple, b: tuple) -> bool:
    """(code points, id, row): more code points, then the smaller id (null last), then the row read first."""
    return (-a[0], a[1] is None, a[1] if a[1] is not None else 0, a[2]) < (-b[0], b[1] is None, b[1] if b[1] is not None else 0, b[2])


def _entries(schema: pa.Schema, whole: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in by_bytes(batches, "text", 16 << 20):
            texts = [t.translate(None, WS) for t in as_bytes(batch.column("text"))]
            points = pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_pylist()
            ids = batch.column("id").to_pylist()
            best: dict[bytes, int] = {}
            number: dict[bytes, int] = {}
            for i, t in enumerate(texts):
                j = best.get(t)
                number[t] = number.get(t, 0) + 1
                if j is None or _better((points[i], ids[i], i), (points[j], ids[j], j)):
                    best[t] = i
            heads = [best[t] for t in texts]
            first = [h == i for i, h in enumerate(heads)]
            columns = {
                "rid": pa.array(range(row, row + len(ids)), pa.int64()),
                "head": pa.array([row + h for h in heads], pa.int64()),
                "id": batch.column("id"),
                "sha": pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
                "hash": pa.array([_signed(xxhash.xxh64_intdigest(t)) for t in texts], pa.int64()),
                "n": pa.array([number[t] if f else 0 for t, f in zip(texts, first, strict=True)], pa.int64()),
                "points": pa.array(points, pa.int64()),
                "text": pa.array([(b"" if whole else t) if f else None for t, f in zip(texts, first, strict=True)], pa.binary()),  # a whole row has it already
            }
            if whole:
                columns["row"] = pc.if_else(pa.array(first), batch.column("row"), pa.scalar(None, batch.column("row").type))
            row += len(ids)
            yield pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) if f.name not in ("row", "id") else columns[f.name] for f in schema], names=schema.names)

    return run


def directory(hashes: DataFrame, total: int, capacity: int, share: int) -> DataFrame:
    """(slot, owner) and the number of hash bits of a slot, from (hash, bytes).

    Overfull buckets split by one more bit until none is left (one hash is never split); a slot is
    a prefix as long as the longest. Buckets are dealt to ``share`` owners in hash order, by bytes.
    """
    depth = max(0, int(total // max(1, capacity)).bit_length() - 1)
    prefix = lambda: F.shiftrightunsigned("hash", 64 - depth) if depth else F.lit(0).cast("long")
    open_, levels = hashes, []
    while True:
        buckets = written(open_.groupBy(prefix().alias("p")).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("k")).withColumn("d", F.lit(depth)), "exact-dedup-buckets")
        overfull = (F.col("bytes") > capacity) & (F.col("k") > 1)
        levels.append(buckets.where(~overfull))
        if buckets.where(overfull).isEmpty():
            break
        open_ = open_.join(buckets.where(overfull).select("p"), prefix() == F.col("p"), "left_semi")
        depth += 1
    leaves = levels[0]
    for level in levels[1:]:
        leaves = leaves.unionByName(level)
    wide = F.lit(depth) - F.col("d")
    leaves = leaves.select(F.expr(f"shiftleft(p, {depth} - d)").alias("first"), F.expr(f"shiftleft(p + 1, {depth} - d) - 1").alias("last"), "bytes").where(wide >= 0)
    leaves = running(leaves, [F.col("first")], {"before": F.col("bytes")})
    owner = F.least(F.lit(share - 1), F.floor(F.col("before") * share / max(1, total))).cast("int")
    return written(leaves.select(F.explode(F.sequence("first", "last")).alias("slot"), owner.alias("owner")), "exact-dedup-slots"), prefix()


def _owners(schema: pa.Schema, text_col: str | None = None, merge: bool = False):
    """Streams entries in hash order; a chain holds ids of its members and one best row a text.

    With ``text_col``, entries have whole rows, whose text it is, and the rows that stay are the result.
    With ``merge``, the result is one entry for each text, and for each member the entry (``into``) that now stands for it.
    """
    whole = text_col is not None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hash_now, salt, chain, members = None, None, [], []  # chain: [text, n, best, best's row]

        def close():
            for k, (text, n, best, held) in enumerate(chain):
                if merge:
                    source, i = held
                    row = source.column("row").slice(i, 1) if whole else None
                    merged.append(({"head": best[2], "into": None, "id": best[1], "hash": hash_now, "n": n, "points": best[0], "text": b"" if whole else text}, row))
                    merged.extend(({"head": head, "into": best[2], "id": None, "hash": None, "n": None, "points": None, "text": None}, None) for head, at in members if at == k)
                elif whole:
                    out_rows.append((best, held))
                else:
                    for head, at in members:
                        if at == k:
                            out.append((head, best[2], best[1], n))

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal out, out_rows, merged
            if merge and merged:
                columns = {f.name: pa.array([x[f.name] for x, _ in merged], f.type) for f in schema if f.name != "row"}
                if whole:
                    kind = batch.column("row").type
                    columns["row"] = pa.concat_arrays([pa.nulls(1, kind) if r is None else r for _, r in merged])
                yield pa.RecordBatch.from_arrays([columns[f.name] for f in schema], names=schema.names)
            elif whole and out_rows:
                own = sorted(i for _, (source, i) in out_rows if source is batch)
                parts = [batch.column("row").take(pa.array(own, pa.int64()))] if own else []
                parts += [source.column("row").slice(i, 1) for _, (source, i) in out_rows if source is not batch]
                yield pa.RecordBatch.from_arrays([pa.concat_arrays(parts)], names=["row"])
            elif out:
                cols = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], names=schema.names)
            out, out_rows, merged = [], [], []

        out, out_rows, merged, batch = [], [], [], None
        for batch in by_bytes(batches, "text", rows=256 if whole else 4096):
            hashes, heads = batch.column("hash").to_pylist(), batch.column("head").to_pylist()
            texts, ns = batch.column("text").to_pylist(), batch.column("n").to_pylist()
            if whole:
                texts = [t.translate(None, WS) for t in as_bytes(batch.column("row").field(text_col))]
            ids, points = batch.column("id").to_pylist(), batch.column("points").to_pylist()
            salts = batch.column("salt").to_pylist() if merge else [None] * len(hashes)
            for i, h in enumerate(hashes):
                if h != hash_now or (merge and salts[i] != salt):
                    close()
                    hash_now, chain, members = h, [], []
                    salt = salts[i]
                rank = (points[i], ids[i], heads[i])
                for k, link in enumerate(chain):
                    if link[0] == texts[i]:  # the bytes decide
                        link[1] += ns[i]
                        if _better(rank, link[2]):
                            link[2], link[3] = rank, (batch, i)
                        break
                else:
                    k = len(chain)
                    chain.append([texts[i], ns[i], rank, (batch, i)])
                if merge or not whole:
                    members.append((heads[i], k))
            yield from flush()
            for link in chain:  # what stays open keeps its own row, not the whole batch
                source, i = link[3]
                if source is batch:
                    link[3] = (batch.take(pa.array([i])), 0)
        close()
        if batch is not None:
            yield from flush()

    return run


def _indexed(docs: DataFrame, id_col: str, text_col: str, whole: bool, least: int):
    """The written entries, those that owners see, dealt and in order, and which entry stands for which (head, into)."""
    spark = docs.sparkSession
    share = partitions(spark)
    types = {"rid": T.LongType(), "head": T.LongType(), "id": docs.schema[id_col].dataType, "sha": T.BinaryType(), "hash": T.LongType(), "n": T.LongType(), "points": T.LongType(), "text": T.BinaryType()}
    source = [F.col(id_col).alias("id"), F.col(text_col).alias("text")]
    if whole:
        source.append(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
        types["row"] = docs.select(source[-1]).schema["row"].dataType
    schema = T.StructType([T.StructField(*f) for f in types.items()])
    entries = written(docs.select(*source).mapInArrow(_entries(_arrow(schema, docs, id_col), whole), schema), "exact-dedup")
    own = ["head", "id", "hash", "n", "points", "text", *(["row"] if whole else [])]
    heads = entries.where("text is not null").select(*own)

    hashes = written(heads.groupBy("hash").agg(F.sum(F.col("points") + 64).alias("bytes")), "exact-dedup-hashes")
    total = hashes.agg(F.sum("bytes")).first()[0] or 0
    capacity = max(least, total // (4 * share))
    part = max(1, capacity // 8)
    hot = written(hashes.where(F.col("bytes") > part).select("hash", F.ceil(F.col("bytes") / part).alias("salts")), "exact-dedup-hot")
    stands = None
    if not hot.isEmpty():
        flagged = heads.join(hot, "hash", "left")
        salted = flagged.where("salts is not null").withColumn("salt", F.pmod(F.xxhash64("head"), "salts"))
        merged_schema = T.StructType([T.StructField(c, types[c]) for c in own] + [T.StructField("into", T.LongType())])
        salted = salted.select(*own, "salt").repartition(share, "hash", "salt").sortWithinPartitions("hash", "salt", "head")
        merged = written(salted.mapInArrow(_owners(_arrow(merged_schema, docs, id_col), text_col if whole else None, True), merged_schema), "exact-dedup-merged")
        heads = flagged.where("salts is null").select(*own).unionByName(merged.where("into is null").select(*own))
        stands = merged.where("into is not null").select("head", "into")
    light = hashes.withColumn("bytes", F.when(F.col("bytes") > part, 1).otherwise(F.col("bytes")))  # merged, a hot hash weighs little
    slots, prefix = directory(light, total, capacity, share)
    owned = heads.withColumn("slot", prefix).join(slots, "slot").drop("slot")
    return entries, owned.repartitionById(share, F.col("owner")).sortWithinPartitions("hash", "head"), stands


def decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """One row a document, in columns ``id_col``, keep_id, group_size, kept, text_sha256."""
    entries, owned, stands = _indexed(docs, id_col, text_col, False, least)
    out = T.StructType([T.StructField("head", T.LongType()), T.StructField("keep_rid", T.LongType()), T.StructField("keep_id", docs.schema[id_col].dataType), T.StructField("group_size", T.LongType())])
    groups = owned.mapInArrow(_owners(_arrow(out, docs, id_col)), out)
    if stands is not None:  # what a merged entry stands for gets its result
        groups = written(groups, "exact-dedup-groups")
        through = stands.join(groups.withColumnRenamed("head", "into"), "into").select(*groups.columns)
        groups = groups.join(stands, "head", "left_anti").unionByName(through)
    return (
        entries.select("rid", "head", "id", "sha")
        .join(groups, "head")
        .select(F.col("id").alias(id_col), "keep_id", "group_size", (F.col("rid") == F.col("keep_rid")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))
    )


def kept_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """The documents that stay, with all their columns."""
    _, owned, _ = _indexed(docs, id_col, text_col, True, least)
    rows = T.StructType([owned.schema["row"]])
    return owned.mapInArrow(_owners(pa.schema([]), text_col), rows).select("row.*").select(*[F.col(f"`{c}`") for c in docs.columns])


def _arrow(schema: T.StructType, docs: DataFrame, id_col: str) -> pa.Schema:
    kinds = {T.LongType: pa.int64(), T.BinaryType: pa.binary()}
    return pa.schema([(f.name, _arrow_type(docs, id_col) if f.name in ("id", "keep_id") else kinds.get(type(f.dataType), pa.null())) for f in schema])


def _arrow_type(docs: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(docs.schema[column].dataType)
