"""A day's stages, each stored once: a run begins at the first that isn't done."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tarifa.operators.commits import Store


@dataclass(frozen=True)
class Stage:
    """``make`` gets the stored results of ``inputs`` by name, and the day."""

    name: str
    make: Callable[[dict[str, DataFrame], str], DataFrame]
    inputs: tuple[str, ...] = ()


class Ledger:
    """Results and states of stages by day, in numbered commits.

    A stage is done for a day if its result is stored and was made from the results that its inputs have now; so one that is
    made again makes those after it stale.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.store = Store(spark, path)

    def _entry(self, day: str, name: str) -> dict:
        return self.store.manifest().get("days", {}).get(day, {}).get(name, {})

    def _put(self, day: str, name: str, entry: dict) -> None:
        def put(m: dict, _: int) -> dict:
            days = m.get("days", {})
            return m | {"days": days | {day: days.get(day, {}) | {name: entry}}}

        self.store.change(put)

    def result(self, day: str, name: str) -> DataFrame:
        return self.store.spark.read.parquet(f"{self.store.path}/{self._entry(day, name)['folder']}")

    def run(self, stages: list[Stage], day: str) -> list[str]:
        """Make what isn't done, in the order given; a failure is noted, and raised. Returns the names of stages that were made."""
        names = [s.name for s in stages]
        for i, s in enumerate(stages):
            if not set(s.inputs) <= set(names[:i]):
                raise ValueError(f"{s.name} needs {sorted(set(s.inputs) - set(names[:i]))} before it")
        made = []
        for s in stages:
            entry = self._entry(day, s.name)
            of = {x: self._entry(day, x)["folder"] for x in s.inputs}
            if entry.get("state") == "done" and entry["of"] == of:
                continue
            tries = entry.get("tries", 0) + 1
            try:
                folder = self.store.write(s.make({x: self.result(day, x) for x in s.inputs}, day))
                rows = self.store.spark.read.parquet(f"{self.store.path}/{folder}").count()
            except Exception as e:
                self._put(day, s.name, {"state": "failed", "tries": tries, "error": str(e)[:500]})
                raise
            self._put(day, s.name, {"state": "done", "tries": tries, "folder": folder, "rows": rows, "of": of})
            made.append(s.name)
        return made

    def entries(self) -> DataFrame:
        """(day, stage, state, tries, rows, error)."""
        rows = [(d, n, e["state"], e["tries"], e.get("rows"), e.get("error")) for d, stages in self.store.manifest().get("days", {}).items() for n, e in stages.items()]
        return self.store.spark.createDataFrame(sorted(rows), "day string, stage string, state string, tries int, rows long, error string")
