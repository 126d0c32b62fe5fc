"""Daily price rollups, in batch and as a stream, and streaming upkeep of the logs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tarifa.functions.prices import two_places

LATE = "7 days"
KEYS = ("master_id", "site_id")


def _stats() -> list[Column]:
    return [F.min("price").alias("price_min"), F.max("price").alias("price_max"), two_places(F.avg("price")).alias("price_avg"), F.bool_or("in_stock").alias("any_in_stock")]


def daily(log: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """One row a day, product and site."""
    return log.groupBy(F.date_trunc("day", "logged_at").alias("day"), *keys).agg(*_stats())


def daily_stream(log: DataFrame, keys: tuple[str, ...] = KEYS, late: str = LATE) -> DataFrame:
    """The same over a stream; rows later than ``late`` are left out, and a day's state is dropped then."""
    windowed = log.withWatermark("logged_at", late).groupBy(F.window("logged_at", "1 day"), *keys).agg(*_stats())
    return windowed.select(F.col("window.start").alias("day"), *keys, "price_min", "price_max", "price_avg", "any_in_stock")


def settled(rollup: DataFrame, now: Column, lag: str = "1 hour") -> DataFrame:
    """Days that ended ``lag`` ago or earlier."""
    return rollup.where(F.col("day") + F.expr("interval 1 day") <= now - F.expr(f"interval {lag}"))


def deduplicated(stream: DataFrame, keys: list[str], time_col: str, late: str = LATE) -> DataFrame:
    """Each job once: a key that comes again within the watermark is dropped."""
    return stream.withWatermark(time_col, late).dropDuplicatesWithinWatermark(keys)


def start(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "update", every: str | None = None) -> StreamingQuery:
    """Run a batch function on each micro-batch; without ``every`` all there is now, then stop.

    The sink must be idempotent in its batch id: a batch that failed comes again.
    """
    writer = stream.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def into_snapshot(table, keys: list[str]) -> Callable[[DataFrame, int], None]:
    """A sink that upserts each batch into a SnapshotTable, last value of a key wins."""
    from tarifa.operators.upsert import upsert

    def sink(batch: DataFrame, _: int) -> None:
        table.change(lambda old: batch if old is None else upsert(old, batch, keys))

    return sink


def store_then_mark(write: Callable[[DataFrame, int], None], mark: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """Statuses change only after their records are stored; a crash between the two repeats both."""

    def sink(batch: DataFrame, n: int) -> None:
        batch.persist()
        try:
            write(batch, n)
            mark(batch, n)
        finally:
            batch.unpersist()

    return sink
