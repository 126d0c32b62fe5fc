"""Time series in chunks with a life cycle, and aggregates that follow them.

A log is a table of chunks, one for each period (a month, a week). Appended rows are a part of each
period that they touch; what is there never changes. Of a chunk that is old enough the parts are rewritten once, sorted by segment, and
take the parts' place in one commit; rows that come later make it partly compressed until it is rewritten again. Each part
carries its days, each with the number of the commit that last brought rows, which is the log of what must be
aggregated anew: a day of the aggregate is stale if a part has younger rows of it.

The aggregate is kept as partial states (sum, count, least, most, any) for each day, so coarser buckets
merge states and never read the log. A commit has an entry for each part and day: some thousands for years.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tarifa.functions.prices import two_places
from tarifa.operators.commits import Store

FOLDERS = 30
OPEN, PARTLY, COMPRESSED = "open", "partly compressed", "compressed"


class ChunkedLog:
    def __init__(self, spark: SparkSession, path: str, time_col: str, unit: str = "month", segment: tuple[str, ...] = ()):
        self.store, self.time_col, self.unit, self.segment = Store(spark, path), time_col, unit, list(segment)

    def _period(self) -> Column:
        return F.date_format(F.date_trunc(self.unit, F.col(self.time_col)), "yyyy-MM-dd")

    def _day(self) -> Column:
        return F.date_format(F.col(self.time_col), "yyyy-MM-dd")

    def parts(self, version: int | None = None) -> list[dict]:
        return self.store.manifest(version).get("parts", [])

    def append(self, rows: DataFrame, batch: int | None = None) -> int:
        """Further rows, in one commit. Rows without a time are an error.

        ``batch``: the number of a stream's batch. One that the log has already, as it comes again after a failure, adds nothing.
        """
        if not rows.where(F.col(self.time_col).isNull()).isEmpty():
            raise ValueError(f"rows without {self.time_col}")
        folder = self.store.write(rows.withColumn("_period", self._period()).repartition("_period", *[F.pmod(F.xxhash64(*self.segment), F.lit(8))] * bool(self.segment)), "_period")
        found = self.store.spark.read.schema(rows.schema).parquet(f"{self.store.path}/{folder}")
        counts = found.groupBy(self._period().alias("period"), self._day().alias("day")).agg(F.count("*").alias("rows")).collect()  # a row a day
        made: dict[str, dict] = {}
        for r in sorted(counts, key=lambda r: r.day):
            part = made.setdefault(r.period, {"period": r.period, "folder": f"{folder}/_period={r.period}", "rows": 0, "days": {}, "state": OPEN})
            part["rows"] += r.rows
            part["days"][r.day] = 0
        schema = rows.schema.json()

        def added(m: dict, n: int) -> dict:
            if batch is not None and m.get("batch", -1) >= batch:
                return m
            parts = [p | {"days": dict.fromkeys(p["days"], n)} for p in made.values()]
            return m | {"parts": m.get("parts", []) + parts, "schema": m.get("schema", schema), "batch": m.get("batch", -1) if batch is None else batch}

        return self.store.change(added)

    def read(self, days: list[str] | None = None, version: int | None = None) -> DataFrame:
        """All rows, or those of some days, of which only the parts with them are read."""
        manifest = self.store.manifest(version)
        if "schema" not in manifest:
            raise FileNotFoundError(self.store.path)
        parts = [p for p in manifest["parts"] if days is None or set(days) & set(p["days"])]
        schema = StructType.fromJson(json.loads(manifest["schema"]))
        if not parts:
            return self.store.spark.createDataFrame([], schema)
        rows = self.store.spark.read.schema(schema).parquet(*[f"{self.store.path}/{p['folder']}" for p in parts])
        return rows if days is None else rows.where(self._day().isin(days))

    def chunks(self) -> DataFrame:
        """(period, parts, rows, days, state) of each chunk."""
        out = {}
        for p in self.parts():
            out.setdefault(p["period"], []).append(p)
        state = lambda ps: COMPRESSED if all(p["state"] == COMPRESSED for p in ps) else PARTLY if any(p["state"] == COMPRESSED for p in ps) else OPEN
        rows = [(k, len(ps), sum(p["rows"] for p in ps), len({d for p in ps for d in p["days"]}), state(ps)) for k, ps in sorted(out.items())]
        return self.store.spark.createDataFrame(rows, "period string, parts int, rows long, days int, state string")

    def compress(self, now: dt.datetime, older: dt.timedelta) -> list[str]:
        """Rewrite the chunks that ended ``older`` ago and aren't compressed as a whole, sorted by segment and newest first. Returns their periods.

        They are swapped in one commit, each if its parts are still those that were read; rows appended meanwhile stay beside it.
        """
        ends = {"day": 1, "week": 7, "month": 31}[self.unit]
        old: dict[str, list[dict]] = {}
        for p in self.parts():
            if dt.datetime.fromisoformat(p["period"]) + dt.timedelta(ends) <= now - older:
                old.setdefault(p["period"], []).append(p)
        old = {k: ps for k, ps in old.items() if any(p["state"] != COMPRESSED for p in ps)}
        if not old:
            return []
        rows = self.store.spark.read.parquet(*[f"{self.store.path}/{p['folder']}" for ps in old.values() for p in ps]).withColumn("_period", self._period())
        folder = self.store.write(rows.repartition("_period", *self.segment).sortWithinPartitions("_period", *self.segment, F.desc(self.time_col)), "_period")
        done: list[str] = []

        def swapped(m: dict, _: int) -> dict:
            here, parts = {p["folder"] for p in m["parts"]}, m["parts"]
            done[:] = [k for k, ps in old.items() if {p["folder"] for p in ps} <= here]  # of the others another writer has rewritten parts
            for k in done:
                gone = {p["folder"] for p in old[k]}
                young = {d: max(p["days"].get(d, 0) for p in old[k]) for p in old[k] for d in p["days"]}  # the rows are the same, and as young as they were
                whole = {"period": k, "folder": f"{folder}/_period={k}", "rows": sum(p["rows"] for p in old[k]), "days": young, "state": COMPRESSED}
                parts = [p for p in parts if p["folder"] not in gone] + [whole]
            return m | {"parts": parts}

        self.store.change(swapped)
        return sorted(done)

    def drop(self, before: str) -> list[str]:
        """Leave out the chunks of earlier periods (retention); their files stay for readers of older commits."""
        gone = sorted({p["period"] for p in self.parts() if p["period"] < before})
        if gone:
            self.store.change(lambda m, _: m | {"parts": [p for p in m["parts"] if p["period"] >= before]})
        return gone


def states(rows: DataFrame, bucket: Column, keys: list[str]) -> DataFrame:
    """Partial states of prices; they merge (``merged``)."""
    price = F.col("price").cast("decimal(18,2)")
    return rows.groupBy(bucket.alias("day"), *keys).agg(F.sum(price).cast("decimal(28,2)").alias("total"), F.count(price).alias("n"), F.min(price).alias("low"), F.max(price).alias("high"), F.bool_or("in_stock").alias("any_in_stock"))


def merged(parts: DataFrame, bucket: Column, keys: list[str]) -> DataFrame:
    return parts.groupBy(bucket.alias("day"), *keys).agg(F.sum("total").cast("decimal(28,2)").alias("total"), F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.bool_or("any_in_stock").alias("any_in_stock"))


def finished(parts: DataFrame) -> DataFrame:
    """States as (…, price_min, price_max, price_avg, any_in_stock)."""
    keys = [c for c in parts.columns if c not in ("total", "n", "low", "high", "any_in_stock")]
    return parts.select(*keys, F.col("low").alias("price_min"), F.col("high").alias("price_max"), two_places((F.col("total") / F.col("n")).cast("decimal(18,6)")).alias("price_avg"), "any_in_stock")


class DailyAggregate:
    """Daily states of a log, of which a refresh makes stale days anew and no others."""

    def __init__(self, log: ChunkedLog, keys: tuple[str, ...] = ("master_id", "site_id")):
        self.log, self.keys = log, list(keys)

    def stale(self, now: dt.datetime, start: dt.timedelta | None, end: dt.timedelta, version: int | None = None) -> list[str]:
        """Days with rows younger than the day's states, that begin within ``start`` (None: ever) and ended ``end`` ago."""
        manifest = self.log.store.manifest(version)
        have = {d: x["commit"] for d, x in manifest.get("aggregate", {}).items()}
        touched: dict[str, int] = {}
        for p in manifest.get("parts", []):
            for d, commit in p["days"].items():
                touched[d] = max(touched.get(d, 0), commit)
        inside = lambda d: (start is None or dt.datetime.fromisoformat(d) >= now - start) and dt.datetime.fromisoformat(d) + dt.timedelta(1) <= now - end
        return sorted(d for d, c in touched.items() if have.get(d, 0) < c and inside(d))

    def refresh(self, now: dt.datetime, start: dt.timedelta | None = dt.timedelta(7), end: dt.timedelta = dt.timedelta(hours=1)) -> list[str]:
        """Aggregate the stale days of the window anew, and commit them together. Returns the days that were read again."""
        store = self.log.store
        seen = store.version()
        days = self.stale(now, start, end, seen)
        if not days:
            return []
        rows = states(self.log.read(days, seen), F.to_date(F.col(self.log.time_col)), self.keys)
        have = store.manifest(seen).get("aggregate", {})
        if len({x["folder"] for x in have.values()}) >= FOLDERS:  # now and then all states go to one folder
            rest = set(have) - set(days)
            rows, kept = rows.unionByName(self._of(have, rest)), {d: have[d]["commit"] for d in rest}
        else:
            kept = {}
        name = uuid.uuid4().hex
        folder = store.write(rows.withColumn("_part", F.lit(name)).sort("day"))
        fresh = {d: {"folder": folder, "part": name, "commit": c} for d, c in (dict.fromkeys(days, seen) | kept).items()}

        def put(m: dict, _: int) -> dict:
            have = m.get("aggregate", {})
            if any(have.get(d, {"commit": 0})["commit"] > fresh[d]["commit"] for d in fresh):
                raise RuntimeError("a later refresh has these days")
            return m | {"aggregate": have | fresh}

        store.change(put)
        return days

    def _of(self, found: dict, days: set[str]) -> DataFrame:
        """The states of some days, each from the folder that has it now."""
        spark, store = self.log.store.spark, self.log.store
        empty = states(self.log.read([]), F.to_date(F.col(self.log.time_col)), self.keys)
        own = [(found[d]["part"], dt.date.fromisoformat(d)) for d in sorted(days)]
        if not own:
            return empty
        rows = spark.read.parquet(*sorted({f"{store.path}/{found[d]['folder']}" for d in days}))
        return rows.join(spark.createDataFrame(own, "_part string, day date"), ["_part", "day"], "left_semi").select(*empty.columns)

    def read(self) -> DataFrame:
        """States by day."""
        found = self.log.store.manifest().get("aggregate", {})
        return self._of(found, set(found))

    def rolled(self, unit: str) -> DataFrame:
        """Weeks or months, merged from the days' states."""
        return merged(self.read(), F.to_date(F.date_trunc(unit, F.col("day"))), self.keys)


def kept_fresh(aggregate: DailyAggregate, now: Callable[[], dt.datetime], start: dt.timedelta | None = dt.timedelta(7), end: dt.timedelta = dt.timedelta(hours=1)) -> Callable[[DataFrame, int], None]:
    """A sink of a stream that appends each batch to the log and refreshes the aggregate's stale days.

    A batch that comes again after a failure is told by its number, so its rows are appended once.
    """

    def sink(batch: DataFrame, n: int) -> None:
        aggregate.log.append(batch, n)
        aggregate.refresh(now(), start, end)

    return sink
