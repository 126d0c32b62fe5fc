"""What several operators of this subpackage share."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tarifa.session import written

WS = b" \t\n\x0b\x0c\r"  # [\x20\x09-\x0D]


def partitions(spark: SparkSession) -> int:
    """The cluster's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; a null counts as empty."""
    return pc.fill_null(column.cast(pa.binary()), b"").to_pylist()


def trim() -> None:
    """Give freed memory back to the system: Spark keeps its Python workers, idle ones too."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):
        ctypes.CDLL(None).malloc_trim(0)


def by_bytes(batches: Iterator[pa.RecordBatch], column: str, most: int = 4 << 20, rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """The batches cut so that ``column`` has about ``most`` bytes in each, one row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = total = 0
        for i, n in enumerate(sizes):
            if i > start and (total + n > most or i - start >= rows):
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        if start < len(sizes):
            yield batch.slice(start)
        trim()


def numbered(data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """A number for each word, the same for equal ones, and the words by number; ``data`` has the words' bytes without a gap."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    found = pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
    return found.indices.to_numpy().astype(np.int64), found.dictionary


def type_of(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def running(rows: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """``rows`` with, for each name, the sum of its column over all rows before in ``order`` (a total order).

    Rows are dealt into ranges; only the ranges' totals, one row a range, meet in one task.
    """
    dealt = written(rows.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "ranges")
    ranges = dealt.groupBy(F.col("range").alias("r")).agg(*[F.sum(c).alias(f"_{n}") for n, c in sums.items()])
    before = lambda window: window.rowsBetween(Window.unboundedPreceding, -1)
    over_ranges, inside = before(Window.orderBy("r")), before(Window.partitionBy("range").orderBy(*order))
    starts = ranges.select("r", *[F.coalesce(F.sum(f"_{n}").over(over_ranges), F.lit(0)).alias(f"_{n}") for n in sums])
    joined = dealt.join(starts, F.col("range") == F.col("r"))
    out = joined.select(*[F.col(c) for c in dealt.columns], *[(F.col(f"_{n}") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(n) for n, c in sums.items()])
    return out.drop("range")
