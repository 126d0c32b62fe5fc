"""Keyed changes of stored tables: a new snapshot from the old one and the changes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarifa.operators.commits import Tables


def last_of(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row a key, the last in the order; a partial aggregate, not a sort. Rows stay dealt by the keys, so a join by these needs no other shuffle."""
    best = F.max_by(F.struct(*[c for c in rows.columns if c not in keys]), F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)]))
    return rows.groupBy(*keys).agg(best.alias("_r")).select(*[F.col(c) if c in keys else F.col("_r")[c].alias(c) for c in rows.columns])


def upsert(existing: DataFrame, changes: DataFrame, keys: list[str], only_if: Column | None = None, fill_only: tuple[str, ...] = ()) -> DataFrame:
    """Existing rows, changed or not, and new ones. ``changes`` has one row a key.

    A changed column's null keeps the old value. Columns in ``fill_only`` change only
    where the old value is null or empty. ``only_if`` is a condition over ``old`` and
    ``new``; where it is false the old row stays.
    """
    old, new = existing.alias("old"), changes.alias("new")
    on = [F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}")) for k in keys]
    joined = old.withColumn("_o", F.lit(True)).alias("old").join(new.withColumn("_n", F.lit(True)).alias("new"), on, "full_outer")
    known, told = F.col("old._o").isNotNull(), F.col("new._n").isNotNull()
    apply = told & (~known | (F.coalesce(only_if, F.lit(False)) if only_if is not None else F.lit(True)))
    columns = []
    for c in dict.fromkeys([*existing.columns, *changes.columns]):
        a = F.col(f"old.{c}") if c in existing.columns else F.lit(None)
        if c not in changes.columns:
            columns.append(a.alias(c))
            continue
        b = F.col(f"new.{c}")
        filled = F.coalesce(F.when(a.cast("string") != "", a), b) if c in fill_only else F.coalesce(b, a)
        columns.append(F.when(apply, filled).otherwise(a).alias(c))
    return joined.where(known | apply).select(*columns)


def insert_missing(existing: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` whose keys do not exist, each once: of several the last by their columns' JSON, so that reruns agree."""
    return last_of(rows, keys, [F.to_json(F.struct(*rows.columns))]).join(existing.select(*keys), keys, "left_anti").select(*rows.columns)


class SnapshotTable:
    """A Parquet table of which each write is a new folder, named by a numbered commit.

    Readers keep the snapshot they began with, and a job that fails leaves the table alone.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.tables = Tables(spark, path)

    def current(self) -> int | None:
        return self.tables.store.version() or None

    def read(self) -> DataFrame:
        if self.current() is None:
            raise FileNotFoundError(self.tables.store.path)
        return self.tables.read()["rows"]

    def write(self, rows: DataFrame) -> None:
        """New content, whatever was there."""
        self.tables.change(lambda _: {"rows": rows})

    def change(self, f: Callable[[DataFrame | None], DataFrame]) -> None:
        """New content made of the current one; made again if another writer comes between."""
        self.tables.change(lambda tables: {"rows": f(tables.get("rows"))})


class SnapshotSet(Tables):
    """Parquet tables that change together: readers see all of them before a run or all after it, also where a run fails between two."""

    def write(self, tables: dict[str, DataFrame]) -> None:
        """New content (of append-only tables: further rows), whatever was there."""
        self.change(lambda _: tables)
