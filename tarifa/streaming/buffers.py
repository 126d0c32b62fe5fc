"""Records held back by host until there are enough for a file, or long enough."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

PER_FILE = 500
SECONDS = 60
NO_DATA = "spark.sql.streaming.noDataMicroBatches.enabled"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class HostBuffer(StatefulProcessor):
    """Rows (site, body, last) to rows (site, file, body).

    A host's records wait in its state, fewer than ``per_file``. The one that makes it ``per_file`` closes a file, as does a
    row with ``last`` (a worker that stops), or a timer, ``seconds`` after the first record that waits.
    """

    def __init__(self, per_file: int, seconds: float):
        self.per_file, self.seconds = per_file, seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", "body string")
        self.at = handle.getValueState("at", "file long, waiting int")

    def _closed(self, site: str, file: int, bodies: list[str]) -> Iterator[Row]:
        for body in bodies:
            yield Row(site=site, file=file, body=body)

    def _keep(self, file: int, bodies: list[str]) -> None:
        self.held.clear()
        if bodies:
            self.held.put([(b,) for b in bodies])
        self.at.update((file, len(bodies)))

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        file, waiting = self.at.get() if self.at.exists() else (0, 0)
        bodies, before = [r[0] for r in self.held.get()] if waiting else [], waiting
        for row in rows:
            if row.body is not None:
                bodies.append(row.body)
            if len(bodies) == self.per_file or (row.last and bodies):
                yield from self._closed(key[0], file, bodies)
                file, bodies, before = file + 1, [], 0
        self._keep(file, bodies)
        if not before:  # else the timer of the first that waits still runs
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            if bodies:
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + int(self.seconds * 1000))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        file, waiting = self.at.get()
        if waiting:
            yield from self._closed(key[0], file, [r[0] for r in self.held.get()])
            self._keep(file + 1, [])

    def close(self) -> None:
        pass


def buffered(stream: DataFrame, per_file: int = PER_FILE, seconds: float = SECONDS) -> DataFrame:
    """(site, file, body) of a stream of (site, body, last): the records of closed files, numbered by host."""
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    rows = stream.select("site", "body", F.coalesce("last", F.lit(False)).alias("last"))
    return rows.groupBy("site").transformWithState(statefulProcessor=HostBuffer(per_file, seconds), outputStructType="site string, file long, body string", outputMode="Append", timeMode="ProcessingTime")


def into_files(root: str) -> Callable[[DataFrame, int], None]:
    """A sink: JSON lines, gzip, a folder with one file for each (site, file). A batch that comes again writes the same folders anew."""

    def sink(batch: DataFrame, _: int) -> None:
        lines = batch.select("site", "file", F.col("body").alias("value"))
        lines.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "gzip").partitionBy("site", "file").text(root)

    return sink


def start(stream: DataFrame, root: str, checkpoint: str, per_file: int = PER_FILE, seconds: float = SECONDS, every: str | None = None) -> StreamingQuery:
    """Files of records under ``root``; without ``every`` what there is now, and what is not enough for a file waits for the next start."""
    writer = buffered(stream, per_file, seconds).writeStream.foreachBatch(into_files(root)).option("checkpointLocation", checkpoint)
    if every:
        return writer.trigger(processingTime=every).start()
    conf = stream.sparkSession.conf
    before = conf.get(NO_DATA, "true")
    conf.set(NO_DATA, "false")  # a timer to come would ask for one empty batch after the other, and the query would never end
    try:
        return writer.trigger(availableNow=True).start()
    finally:
        conf.set(NO_DATA, before)
